"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests. Columns only.

A text is cut into paragraphs (lines; long ones into pieces, shorter ones at the begin of the
text, so that short texts have several) and each distinct paragraph gets a digest of 40 bits and
a check of 24. The sketch adds each digest to three of 24 cells (a count and an exclusive or). The
sketches of two versions are subtracted cell by cell, and peeling takes out cells with one digest
until none is left: the digests that differ. If cells are left, the digests are dealt out over
four times as many sketches with other cells, those that failed only, until all is recovered.

likeness = common digests / all digests of both; 1 for two texts without any.

Null text: empty. Null doc_id: last in the order of documents. Repeated rows: a result each; equal
ids follow in order of the text's hash. Other columns are not read. An empty table gives no rows;
the only document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

CELLS = 24
ROUNDS = 10            # of peeling before a sketch counts as failed
HEAD, SHORT, PIECE = 256, 64, 256
FIELD = "struct<k: bigint, m: int>"


def paragraphs(text: Column) -> Column:
    """Lines, cut into pieces of SHORT code points in the first HEAD, of PIECE beyond."""
    return F.concat(F.regexp_extract_all(F.substring(text, 1, HEAD), F.lit(r"([^\n]{1,%d})" % SHORT), F.lit(1)),
                    F.regexp_extract_all(F.substring(text, HEAD + 1, 2147483647), F.lit(r"([^\n]{1,%d})" % PIECE), F.lit(1)))


def digests(text: Column) -> Column:
    """Distinct digests: the upper 40 bits of the hash, and 24 of the hash of those as a check."""
    whole = F.transform(paragraphs(text), lambda x: F.shiftrightunsigned(F.xxhash64(x), 24))
    return F.array_distinct(F.transform(whole, lambda x: F.shiftleft(x, 24).bitwiseOR(check(x))))


def check(upper: Column) -> Column:
    return F.xxhash64(upper).bitwiseAND(F.lit(0xFFFFFF).cast("long"))


def _mask(k: str, level: str) -> str:
    """SQL for the bits of a digest's three cells, one in each third, at a level of retry."""
    return (f"transform(array(xxhash64({k}, {level})), r -> (1 << cast(r & 7 as int)) | (256 << cast(shiftright(r, 3) & 7 as int))"
            f" | (65536 << cast(shiftright(r, 6) & 7 as int)))[0]")


def placed(digest: str, level: str) -> str:
    return f"transform({digest}, d -> struct(d as k, {_mask('d', level)} as m))"


def counts(items: str) -> str:
    return f"transform(sequence(0, {CELLS - 1}), j -> aggregate({items}, 0, (s, x) -> s + (shiftright(x.m, j) & 1)))"


def keys(items: str) -> str:
    return f"transform(sequence(0, {CELLS - 1}), j -> aggregate({items}, 0L, (s, x) -> if((shiftright(x.m, j) & 1) = 1, s ^ x.k, s)))"


def sketch(items: str) -> str:
    """SQL for the sketch of placed digests: counts c and exclusive ors k by cell."""
    return f"struct({counts(items)} as c, {keys(items)} as k)"


def subtracted(a: str, b: str) -> str:
    return f"struct(zip_with({a}.c, {b}.c, (x, y) -> x - y) as c, zip_with({a}.k, {b}.k, (x, y) -> x ^ y) as k)"


def peeled(cells: str, level: str) -> str:
    """SQL for what peeling leaves: cells c and k, n recovered digests."""
    pure = (f"filter(sequence(0, {CELLS - 1}), j -> abs(st.c[j]) = 1 and "
            "(xxhash64(shiftrightunsigned(st.k[j], 24)) & 16777215L) = (st.k[j] & 16777215L))")
    found = f"array_distinct(transform({pure}, j -> struct(st.k[j] as k, st.c[j] as n, {_mask('st.k[j]', level)} as m)))"
    step = (f"if(st.live, transform(array({found}), f -> struct("
            "transform(st.c, (v, j) -> aggregate(f, v, (s, x) -> s - x.n * (shiftright(x.m, j) & 1))) as c, "
            "transform(st.k, (v, j) -> aggregate(f, v, (s, x) -> if((shiftright(x.m, j) & 1) = 1, s ^ x.k, s))) as k, "
            "st.n + size(f) as n, size(f) > 0 as live))[0], st)")
    return f"aggregate(sequence(1, {ROUNDS}), struct({cells}.c as c, {cells}.k as k, 0 as n, true as live), (st, i) -> {step})"


EMPTY = "forall(st.c, x -> x = 0) and forall(st.k, x -> x = 0L)"


def differences(pairs: DataFrame) -> DataFrame:
    """(row, n): how many digests differ, for each (row, level 0 cells, a, b): the subtracted
    sketch, and the digests of both to sketch anew where it can't be peeled."""
    level, done = 0, []
    todo = pairs.select("row", "cells", "a", "b")
    while True:
        got = C.staged(todo.withColumn("st", F.expr(peeled("cells", f"{level}L"))).withColumn("ok", F.expr(EMPTY))
                       .select("row", "ok", F.when(F.col("ok"), F.col("st.n")).alias("n"), *(F.when(~F.col("ok"), F.col(c)).alias(c) for c in ("a", "b"))), "iblt")
        done.append(got.filter("ok").select("row", "n"))
        failed = got.filter("not ok")
        if failed.isEmpty():
            break
        level += 1
        part = f"(shiftright(xxhash64(d, {level}L), 20) & 3) = q"
        todo = (failed.select("row", "a", "b", F.explode(F.expr("sequence(0, 3)")).alias("q"))
                .select("row", *(F.expr(f"filter({c}, d -> {part})").alias(c) for c in ("a", "b")))
                .filter("size(a) > 0 or size(b) > 0")
                .withColumn("pa", F.expr(placed("a", f"{level}L"))).withColumn("pb", F.expr(placed("b", f"{level}L")))
                .withColumn("sa", F.expr(sketch("pa"))).withColumn("sb", F.expr(sketch("pb")))
                .select("row", F.expr(subtracted("sa", "sb")).alias("cells"), "a", "b"))
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    return out.groupBy("row").agg(F.sum("n").alias("n"))


def likeness(n_a: Column, n_b: Column, n: Column) -> Column:
    common = (n_a + n_b - n) / 2
    return F.when(n_a + n_b == 0, F.lit(1.0)).otherwise(common / (common + n)).cast("double")


def text_of(cells: Column) -> Column:
    """A sketch as text: count and hexadecimal key of each cell."""
    return F.array_join(F.zip_with(cells["c"], cells["k"], lambda c, k: F.concat(c.cast("string"), F.lit(":"), F.lower(F.hex(k)))), ".")


def with_next(texts: DataFrame, buckets: int) -> DataFrame:
    """Adds next, the text of the document that follows by doc_id (of the last: the first).

    Documents are dealt out in ranges of doc_id between quantiles; a window looks ahead within a
    range, and the first document of each range, a row a range, follows the last of the one before.
    """
    texts = texts.withColumn("tie", F.xxhash64("text"))
    share = [i / buckets for i in range(1, buckets)]
    cuts = texts.agg(F.percentile_approx("doc_id", share or [0.5], 10000).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    low = F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id"))), F.lit(len(cuts) + 1)) if cuts else F.lit(0)
    texts = texts.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(low))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    heads = texts.groupBy("part").agg(F.min_by("text", F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("head"))
    every = Window.partitionBy().orderBy("part")      # a row a range
    heads = heads.select(F.col("part").alias("h_part"), F.coalesce(F.lead("head").over(every), F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("head"))
    inside = texts.withColumn("ahead", F.lead("text").over(Window.partitionBy("part").orderBy(*order)))
    return inside.join(heads, F.col("part") == F.col("h_part")).select("doc_id", "text", F.coalesce("ahead", "head").alias("next"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per text: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and the numbers of digests behind them."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = with_next(C.texts(docs), buckets)
    tail = F.floor(F.length("text") / 4).cast("int")
    made = (both.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), F.length("text") - tail), F.col("next").substr(F.lit(1), tail)))
            .select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    *(digests(F.col(c)).alias(c) for c in ("text", "edited", "next"))))
    made = made.withColumns({f"p_{c}": F.expr(placed(c, "0L")) for c in ("text", "edited", "next")})
    made = made.withColumns({f"s_{c}": F.expr(sketch(f"p_{c}")) for c in ("text", "edited", "next")})
    made = C.staged(made.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", "edited_sha256", "text", "edited", "next", "s_text", "s_edited",
                                F.expr(subtracted("s_text", "s_edited")).alias("d_edited"), F.expr(subtracted("s_text", "s_next")).alias("d_next")), "iblt")
    pairs = made.select("row", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("d_edited").alias("cells"), F.col("edited").alias("b")),
                                                 F.struct(F.lit(1).alias("kind"), F.col("d_next").alias("cells"), F.col("next").alias("b")))).alias("x"), F.col("text").alias("a"))
    n = differences(pairs.select((F.col("row") * 2 + F.col("x.kind")).alias("row"), "x.cells", "a", "x.b"))
    n = n.groupBy(F.floor(F.col("row") / 2).cast("long").alias("row")).agg(
        F.sum(F.when(F.col("row") % 2 == 0, F.col("n"))).alias("n_edited"), F.sum(F.when(F.col("row") % 2 == 1, F.col("n"))).alias("n_next"))
    return made.join(n, "row").select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("s_text")).alias("fingerprint"), text_of(F.col("s_edited")).alias("edited_fingerprint"),
        likeness(F.size("text"), F.size("edited"), F.col("n_edited")).alias("near_edited"), likeness(F.size("text"), F.size("next"), F.col("n_next")).alias("near_next"))
