"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / size of the source times. The expected copies
are summed up along the source, one offset is added, and a document is emitted once per integer
boundary that the sum crosses there. Documents stand in order of their size, so that the words
taken come within about one long document of the target.

The sum is distributed: rows are dealt out in ranges of (source, size, doc_id), each range counts
its rows, and the counts of the ranges before it are added; no source is ever in one task.

Null source: a source of its own, last. Null text: size 0. Null doc_id: kept, first of its size.
Repeated rows: sampled one by one. Extra columns are carried only where asked. Without any words
all targets are 0 and nothing is taken; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def offset(source: Column, seed: str) -> Column:
    """In [0, 1), fixed by source and seed."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 4294967296.0


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, ceiling: int = 2) -> DataFrame:
    """Adds target to a table of (source, source_size), a row for each source: the shares by
    weight, no more than ``ceiling`` times the size, the excess shared again by weight until none
    is above. In order of size / weight the full sources come first, so the level is the first
    that fits; the table has a row per source, which one window can order."""
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % n
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place + 1).cast("int"))
    t = sources.withColumn("weight", weight).withColumn("most", ceiling * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    t = t.withColumn("nth", F.row_number().over(order)).withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("nth", "level"))
    t = t.withColumn("water", F.min(fits).over(every)["level"])
    return t.select("source", "source_size", "n", F.least(F.col("most").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("most").cast("double"))).alias("target"))


def sample(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, ceiling: int = 2, seed: str = "mix",
           carry: list[str] | None = None) -> DataFrame:
    """Per document: doc_id, source, th (hash of the text), size, source_size, target, copies, taken, and ``carry``, a struct of
    input columns."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                      C.text_hash().alias("th"), F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
                      F.struct(*([C.named(c) for c in carry] if carry else [F.lit(0).alias("none")])).alias("carry"))
    # rows that are equal in all of it are told apart by the last key: they may go to several ranges
    dealt = (src.withColumn("tie", F.monotonically_increasing_id())
             .repartitionByRange(F.col("source").asc_nulls_last(), "size", "doc_id", "th", "tie")
             .withColumn("part", F.spark_partition_id()))
    dealt = C.staged(dealt, "mix")
    per_part = dealt.groupBy("source", "part").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    level = targets(per_part.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("n").alias("n")), weights, share, ceiling)
    along = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("source", "part", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    level = level.select(F.col("source").alias("l_source"), "source_size", "target")
    before = before.join(level, before["source"].eqNullSafe(level["l_source"])).select(
        F.col("source").alias("b_source"), F.col("part").alias("b_part"), "before", "source_size", "target")
    inside = Window.partitionBy("part", "source").orderBy("size", "doc_id", "th", "tie")
    ranked = dealt.withColumn("nth", F.row_number().over(inside).cast("long"))
    ranked = ranked.join(before, (ranked["part"] == before["b_part"]) & ranked["source"].eqNullSafe(before["b_source"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = lambda k: F.floor(offset(F.col("source"), seed) + rate * (F.col("before") + k))
    copies = (upto(F.col("nth")) - upto(F.col("nth") - 1)).cast("long")
    return ranked.select("doc_id", "source", "th", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "carry")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document, all its columns, as many times as it is taken. Rows that
    are equal in doc_id, source and text share their copies as evenly as these allow."""
    taken = sample(docs, **how).groupBy("doc_id", "source", "th").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).filter("copies > 0")
    got = C.matched(docs, taken, {"source": "source"})
    own = F.expr("cast(copies div rows + if(nth <= copies % rows, 1, 0) as int)")
    return got.select("carry", F.explode(F.array_repeat(F.lit(0), own))).select(*[C.named(c, "carry").alias(c) for c in docs.columns])
