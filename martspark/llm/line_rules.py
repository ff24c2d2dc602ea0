"""Quality rules with cross-document line frequency.

Base rules count words, symbols, repeated lines and repeated 5-word windows of a text. Then lines
are normalised and hashed, the distinct documents of each line are counted per host, lines above
the limits are removed, and documents that the removal depletes are rejected.

Documents of a host with equal whole texts are copies and count once for a line: a group of copies
is no reason to call its lines boilerplate. Any difference in the text makes another document.

Null text: no words, fails the base rules. Null host: a host of its own. Null doc_id: kept.
Repeated rows: a result each. Other columns of the input are not read, but ``clean`` carries them
along. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WORD = r"[^\x20\x09-\x0D]+"
IS_SYMBOL = C.table_of(b"#*$%&|<>")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5


def base_counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each UTF-8 text."""
    n = len(offs) - 1
    space = C.IS_SPACE[data]
    per_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offs])
    s, e, first = C.spans(~space, offs)
    out = {"n_words": np.diff(first), "word_chars": per_text(((data & 0xC0) != 0x80) & ~space), "n_symbols": per_text(IS_SYMBOL[data])}

    ls, le, lfirst = C.spans(data != 10, offs)
    worded = np.searchsorted(s, le) > np.searchsorted(s, ls)
    doc = np.repeat(np.arange(n), np.diff(lfirst))[worded]
    h, g = C.span_hashes(data, ls[worded], le[worded])
    rep, _ = C.distinct(h + C.mix(doc.astype(np.uint64)), g)
    out["n_dup_lines"] = np.bincount(doc, minlength=n) - np.bincount(doc[rep], minlength=n)

    doc = np.repeat(np.arange(n), np.diff(first))
    at = np.flatnonzero(doc[WINDOW - 1:] == doc[:len(doc) - WINDOW + 1]) if len(doc) >= WINDOW else np.zeros(0, np.int64)
    h, g = C.span_hashes(data, s, e)
    wh, wg = C.mix(doc[at].astype(np.uint64)), np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        wh, wg = C.mix(wh ^ h[at + k]), C.mix(wg + g[at + k])
    _, inverse = C.distinct(wh, wg)
    twice = at[np.bincount(inverse)[inverse] > 1] if len(at) else at
    edge = np.bincount(twice, minlength=len(doc) + 1) - np.bincount(twice + WINDOW, minlength=len(doc) + 1)
    hit = np.cumsum(edge)[:len(doc)] > 0
    out["n_repeat_words"] = np.bincount(doc[hit], minlength=n)
    return out


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def line_array(text: Column) -> Column:
    """(h, w) of each line with a word: hash of the normalised line, its words."""
    return F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
                       lambda x: F.struct(F.xxhash64(normal(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).cast("long").alias("w")))


def judged(docs: DataFrame, host_col: str = "source", doc_limit: int = 20, min_share: float = 0.0, min_left: float = 0.3) -> DataFrame:
    """Per text: doc_id, host, th (hash of the text), the base counts, base_failed, kept,
    words_left, and removed (hashes of its lines above the limits).

    A line of a host is above the limits if over ``doc_limit`` distinct documents have it and, with
    ``min_share``, they are such a share or more of all its documents there. A document is depleted if less
    than ``min_left`` of its words is left.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                      C.named(host_col).cast("string").alias("host"), C.text_hash().alias("th"))
    src = src.select("doc_id", "host", "th", F.col("text").cast("binary").alias("text"), line_array(F.col("text")).alias("lines"))
    schema = src.drop("text").withColumn("row", F.lit(0).cast("long")).withColumns({c: F.lit(0).cast("long") for c in STATS}).schema

    def count(batches):
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            parts = [base_counts(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in C.chunks(offs)]
            cols = {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in STATS}
            cols["row"] = np.arange(row, row + len(b))
            row += len(b)
            yield pa.RecordBatch.from_arrays([b.column(f.name) if f.name in ("doc_id", "host", "th", "lines") else pa.array(cols[f.name], pa.int64()) for f in schema], names=schema.names)

    counted = C.staged(src.mapInArrow(count, schema), "line_rules")
    lines = counted.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.h", "line.w")
    once = counted.select("host", "th", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))     # a document counts once
    per_text = once.groupBy("host", "h", "th").agg(F.count("*").alias("c"))
    above = (per_text.groupBy("host", "h").agg(F.count("*").alias("distinct_docs"), F.sum("c").alias("c"))
             .filter((F.col("distinct_docs") > doc_limit) & (F.col("distinct_docs") >= min_share * F.col("c")))
             .select(F.col("host").alias("a_host"), F.col("h").alias("a_h")))
    gone = (lines.join(above, lines["host"].eqNullSafe(above["a_host"]) & (lines["h"] == above["a_h"]))
            .groupBy("row").agg(F.sum("w").alias("w"), F.collect_set("h").alias("removed")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce(F.col("w"), F.lit(0))
    return (counted.join(gone, "row", "left")
            .select("doc_id", "host", "th", *STATS, failed.alias("base_failed"), (~failed & (left >= min_left * F.col("n_words"))).alias("kept"),
                    left.alias("words_left"), F.coalesce("removed", F.array().cast("array<long>")).alias("removed")))


def without(text: Column, removed: Column) -> Column:
    """``text`` without the lines whose normalised hash is in ``removed``."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~(x.rlike(WORD) & F.array_contains(removed, F.xxhash64(normal(x)))))
    return F.when(F.size(removed) > 0, F.array_join(lines, "\n")).otherwise(text)


def clean(docs: DataFrame, host_col: str = "source", **limits) -> DataFrame:
    """The kept documents, all their columns, without the lines above the limits; n_chars, where
    there is one, counts what is left. A null text stays null (and is rejected: no words)."""
    kept = judged(docs, host_col, **limits).filter("kept").groupBy("doc_id", "host", "th").agg(F.first("removed").alias("removed"))
    got = C.matched(docs, kept, {"host": host_col})
    text = without(F.col("carry.text"), F.col("removed"))
    cols = [text.alias(c) if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else C.named(c, "carry").alias(c) for c in docs.columns]
    return got.select(*cols)
