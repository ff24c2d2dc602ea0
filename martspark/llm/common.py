"""Helpers shared by the training-data operators: input frames, Arrow buffers, vectorised words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martspark.session import scratch_path

SPACES = b" \t\n\x0b\x0c\r"          # \x20 and \x09-\x0D
CHUNK_BYTES = 4 << 20                 # bytes of text looked at together; a longer text stands alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): the two columns an operator reads; a null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def byte_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``texts``, with the text as its UTF-8 bytes (no decoding in the workers)."""
    return texts(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))


def remainder(id_col: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo n; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % n


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def named(name: str, of: str | None = None) -> Column:
    """The column, or the field of the struct ``of``, with exactly this name."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def matched(docs: DataFrame, keys: DataFrame, others: dict[str, str] | None = None) -> DataFrame:
    """Rows of ``docs`` as a struct ``carry``, joined with the rows of ``keys`` (doc_id, th and the
    columns that ``others`` maps from columns of docs) that have the same doc_id and text hash, and
    ``nth``, a number among rows that are equal in these. Texts cross the network once, and no
    copy of them is staged. ``keys`` has a row at most for each key."""
    others = others or {}
    left = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("carry"), F.col("doc_id").cast("long").alias("k_doc_id"), text_hash().alias("k_th"),
                       *[named(c).cast("string").alias(f"k_{k}") for k, c in others.items()])
    names = ["doc_id", "th", *others]
    on = F.lit(True)
    for k in names:
        on = on & (left[f"k_{k}"].eqNullSafe(keys[k]))
    same = Window.partitionBy(*[f"k_{k}" for k in names]).orderBy("k_th")
    return left.join(keys, on).withColumn("nth", F.row_number().over(same)).drop(*names, *[f"k_{k}" for k in names])


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and bytes of a string or binary array; a null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)
    _, offs, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return o - o[0], d


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges (i, j) of texts that together have at most ``limit`` bytes, one text at least."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def table_of(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


IS_SPACE = table_of(SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that cross no text border: starts, ends, and the index of each
    text's first run (n + 1 entries)."""
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    s = np.flatnonzero(begins)
    return s, np.flatnonzero(ends) + 1, np.searchsorted(s, offs)


_M = [np.uint64((1 << (8 * i)) - 1) for i in range(8)] + [np.uint64(0xFFFFFFFFFFFFFFFF)]
_MASK = np.array(_M, np.uint64)
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; bijective."""
    x = x ^ (x >> np.uint64(32))
    x = x * _C[3]
    x = x ^ (x >> np.uint64(29))
    x = x * _C[0]
    return x ^ (x >> np.uint64(32))


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each byte span; equal bytes give equal pairs."""
    size = e - s
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    lanes = np.ndarray(len(data) + 8, "<u8", padded, strides=(1,))
    h = mix(size.astype(np.uint64) + _C[1])
    g = mix(size.astype(np.uint64) ^ _C[2])
    todo, at = np.arange(len(s)), 0
    while len(todo):
        k = lanes[s[todo] + at] & _MASK[np.minimum(size[todo] - at, 8)]
        h[todo] = mix(h[todo] ^ (k * _C[1]))
        g[todo] = mix((g[todo] + k) * _C[2])
        at += 8
        todo = todo[size[todo] > at]
    return h, g


def distinct(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of a first member of each distinct pair, and each row's number among them."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(h, kind="stable")
    hs, gs = h[order], g[order]
    new = np.ones(len(h), bool)
    new[1:] = hs[1:] != hs[:-1]
    if (~new[1:] & (gs[1:] != gs[:-1])).any():       # 64 bits met by chance: sort by all 128
        order = np.lexsort((g, h))
        hs, gs = h[order], g[order]
        new[1:] = (hs[1:] != hs[:-1]) | (gs[1:] != gs[:-1])
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all elements of the spans, one span after another."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def binary_array(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary array of values of the given sizes that lie one after another in ``flat``."""
    offs = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offs[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(flat.tobytes())])


def arrow_batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if not isinstance(cols[f.name], pa.Array) else cols[f.name].cast(f.type)
                                       for f in schema], schema=schema)
