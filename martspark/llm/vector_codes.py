"""Vector codes: each part of a vector as its nearest entry of that part's codebook.

Codebooks are refined in rounds of assignment and means over whole numbers. Assignment keeps what
it learnt: each part of a vector has its b closest entries with lower bounds of their distances in
rising order, and one outer bound for all other entries. When entries have moved, bounds shrink by
the ways moved; a part whose distance to its present entry is below the next bound stays there
unseen, else just the entries before the first higher bound are compared, and all only past the
outer bound. Comparisons are of exact squared distances in whole numbers; bounds are rounded
downwards, so they never decide a tie. b starts at a quarter of the entries and follows the
longest list that a round needed, an eighth at least.

Vectors travel in blocks of ``BLOCK`` rows, packed, so state between rounds is a staged table in
the shared folder. What reaches the driver are codebooks: entries x dimension numbers.

Nulls: rows whose vector is null or holds null or non-finite components are dropped; null ids come
after all others and stay; null labels are one label. Ties: of equal distances the lower index;
rows with one id are ordered by their components; repeated rows are rows of their own. Empty
vectors, and vectors whose length differs from that of the smallest kept id with a positive
multiple of ``parts``, have no such parts: they are dropped too. Vectors of any length work. Fewer
rows than entries give so many entries. Components of any size are exact (beyond 2**29 slower); an
error above 64 bits is null, with its label's. An empty table gives an empty result. Columns besides
the three named ones are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .blocks import pack, unpack

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 2048                     # vectors packed together
SMALL = 1 << 29                  # squares of differences of four such numbers fit 64 bits
UP, DOWN = 1 + 1e-12, 1 - 1e-12  # past the rounding of a square root
MOST = 10 ** 308                 # as far as floating-point bounds go
STATE = "keys binary, kind string, vectors binary, near binary, bounds binary, used int, part int, entry int, members long, total string"
CODES = "vec_id long, label long, code string, error long"


def kept(vectors: DataFrame, parts: int) -> DataFrame:
    """vec_id, label and vector of the rows that have one."""
    v = F.col("embedding").cast("array<double>")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("vector"))
            .where(F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0)
                   & F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): 64-bit numbers where their arithmetic can't overflow, else Python's."""
    y = np.floor(x.astype(np.float64) * SCALE)
    if not np.isfinite(y).all():                                  # doubles near their limit
        return np.array([[int(v) * SCALE for v in row] for row in x.tolist()], object)
    if y.size == 0 or np.abs(y).max() <= SMALL:
        return y.astype(np.int64)
    return np.array([[int(v) for v in row] for row in y.tolist()], object)


def _pack_vectors(x: np.ndarray) -> tuple[str, bytes]:
    if x.dtype == object:
        return "text", ",".join(map(str, x.ravel().tolist())).encode()
    kind = "<i2" if np.abs(x).max(initial=0) < 1 << 15 else "<i4"
    return kind, pack(x.ravel(), kind)


def _unpack_vectors(kind: str, body: bytes, dim: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(v) for v in body.decode().split(",")], object).reshape(-1, dim)
    return unpack(body, kind).astype(np.int64).reshape(-1, dim)


def _down(x: np.ndarray) -> np.ndarray:
    """As half-precision numbers, rounded downwards; 0 at least."""
    x = np.minimum(np.maximum(x, 0), np.where(np.isinf(x), np.inf, 65504.0))
    h = x.astype(np.float16)
    return np.where(h.astype(np.float64) > x, np.nextafter(h, np.float16(-np.inf)), h)


def _below(d: np.ndarray) -> np.ndarray:
    """Distances of squared distances, not above the true ones."""
    if d.dtype == object:
        return np.array([float(min(math.isqrt(v), MOST)) for v in d.ravel().tolist()]).reshape(d.shape) * DOWN
    return np.sqrt(d.astype(np.float64)) * DOWN


def _less(low: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Bounds after a move; nothing is known of what moved without limit."""
    return np.where(np.isinf(moved), 0, low - np.where(np.isinf(moved), 0, moved) * UP)


def _above(d: np.ndarray) -> np.ndarray:
    """Distances of squared distances, not below the true ones."""
    if d.dtype == object:
        return np.array([float(r) if (r := math.isqrt(v) + 1) <= MOST else np.inf for v in d.ravel().tolist()]).reshape(d.shape) * UP
    return np.sqrt(d.astype(np.float64)) * UP


class Book:
    """Codebooks, (parts, entries, width) whole numbers, and how far each entry has moved."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None):
        self.entries = entries
        self.parts, self.k, self.width = entries.shape
        self.moved = np.zeros((self.parts, self.k)) if moved is None else moved

    def update(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Book:
        new = [[[s // sums[p, e][0] for s in sums[p, e][1]] if (p, e) in sums else list(self.entries[p, e]) for e in range(self.k)] for p in range(self.parts)]
        new = [[[int(v) for v in e] for e in p] for p in new]
        small = max(abs(v) for p in new for e in p for v in e) <= SMALL
        new = np.array(new, np.int64 if small else object).reshape(self.entries.shape)
        step = new.astype(object) - self.entries.astype(object)
        return Book(new, _above((step * step).sum(-1)))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _exact(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Sums of squared differences along the last axis."""
    d = x - entries if x.dtype == entries.dtype else x.astype(object) - entries.astype(object)
    if d.dtype == object:
        return (d * d).sum(-1)
    return np.einsum("...w,...w->...", d, d)


def _all(x: np.ndarray, part: np.ndarray, book: Book, b: int):
    """Every entry of the parts ``x`` (m, width): the nearest's distance, the b closest, their bounds
    and the outer one."""
    m = len(x)
    best = np.empty(m, object if x.dtype == object or book.entries.dtype == object else np.int64)
    near, bounds = np.empty((m, b), np.uint8), np.empty((m, b + 1), np.float64)
    for i in range(0, m, 4096):
        d = _exact(x[i:i + 4096, None], book.entries[part[i:i + 4096]])
        order = np.argsort(d, axis=1, kind="stable")
        d = np.take_along_axis(d, order, 1)
        best[i:i + 4096], near[i:i + 4096] = d[:, 0], order[:, :b]
        low = _below(d[:, :b + 1])
        bounds[i:i + 4096, :low.shape[1]] = low
        bounds[i:i + 4096, low.shape[1]:] = np.inf
    return best, near, bounds


def assign(x: np.ndarray, book: Book, b: int, near: np.ndarray | None = None, bounds: np.ndarray | None = None):
    """Nearest entries of the parts of ``x`` (n, parts, width), with the lists of an earlier
    assignment where there are some: squared distance, list (nearest first) and bounds of each part,
    the number of entries that the longest comparison within a list had, and how many parts were
    compared with every entry."""
    n = len(x)
    x, part = x.reshape(n * book.parts, book.width), np.tile(np.arange(book.parts), n)
    if near is None:
        return *_all(x, part, book, b), 1, len(x)
    if b < near.shape[1]:
        bounds = np.concatenate([bounds[:, :b], bounds[:, b:].min(1, keepdims=True)], 1)
        near = near[:, :b]
    near = near.copy()
    best = _exact(x, book.entries[part, near[:, 0]])
    upper = _above(best)
    low = bounds.astype(np.float64) * DOWN
    low[:, :b] = _less(low[:, :b], book.moved[part[:, None], near])
    low[:, b] = _less(low[:, b], book.moved.max(1)[part])
    low = np.minimum.accumulate(np.maximum(low, 0)[:, ::-1], axis=1)[:, ::-1].copy()
    need = 1 + (low[:, 1:] <= upper[:, None]).sum(1)
    low[:, 0] = np.minimum(_below(best), low[:, 1])

    some = np.flatnonzero((need > 1) & (need <= b))
    if len(some):
        d = _exact(x[some, None], book.entries[part[some, None], near[some]])
        out = np.arange(b) >= need[some, None]              # these stay where they are, after the others
        rank = d.astype(object) * 256 + near[some] if d.dtype == object or d.max() >= 1 << 54 else d * 256 + near[some]
        order = np.argsort(np.where(out, rank.max() + 1 + np.arange(b), rank), axis=1, kind="stable")
        near[some] = np.take_along_axis(near[some], order, 1)
        best[some] = np.take_along_axis(d, order, 1)[:, 0]
        exact = np.where(out, np.inf, _below(np.take_along_axis(d, order, 1)))
        low[some, :b] = np.where(out, low[some, :b], np.minimum(exact, np.take_along_axis(low[some], need[some, None], 1)))
    full = np.flatnonzero(need > b)
    if len(full):
        d, near[full], low[full] = _all(x[full], part[full], book, b)
        best = best.astype(d.dtype) if d.dtype == object else best
        best[full] = d
    return best, near, low, int(need[need <= b].max(initial=1)), len(full)


class _Sums:
    """Members and sums of each entry, of one task."""

    def __init__(self, book: Book):
        self.book, self.n = book, np.zeros(book.parts * book.k, np.int64)
        self.total = np.zeros((book.parts * book.k, book.width), object)

    def add(self, x: np.ndarray, near: np.ndarray) -> None:
        k, w = self.book.k, self.book.width
        x = x.reshape(-1, w)
        at = np.tile(np.arange(self.book.parts) * k, len(x) // self.book.parts) + near[:, 0]
        self.n += np.bincount(at, minlength=len(self.n))
        if x.dtype == object:
            np.add.at(self.total, at, x)
        else:                      # below 2**53: a block's sums are exact
            for c in range(w):
                self.total[:, c] += np.bincount(at, x[:, c], len(self.n)).astype(np.int64).astype(object)

    def rows(self) -> Iterator[dict]:
        for i in np.flatnonzero(self.n).tolist():
            yield dict(part=i // self.book.k, entry=i % self.book.k, members=int(self.n[i]), total=",".join(map(str, self.total[i].tolist())))


_SCHEMA = pa.schema([("keys", pa.binary()), ("kind", pa.string()), ("vectors", pa.binary()), ("near", pa.binary()), ("bounds", pa.binary()),
                     ("used", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("members", pa.int64()), ("total", pa.string())])


def _frame(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _SCHEMA], schema=_SCHEMA)


def _fresh(batches, dim: int) -> Iterator[tuple]:
    """Blocks of new vectors: keys and whole numbers."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            b = batch.slice(i, BLOCK)
            keys = b.select(["vec_id", "label"])
            with pa.BufferOutputStream() as out, pa.ipc.new_stream(out, keys.schema) as w:
                w.write_batch(keys)
            flat = b.column("vector").flatten().to_numpy(zero_copy_only=False)
            yield out.getvalue().to_pybytes(), whole(flat.reshape(-1, dim)), None, None


def _stored(batches, dim: int, parts: int, b: int) -> Iterator[tuple]:
    """Blocks of an earlier round, with their lists."""
    for batch in batches:
        for r in batch.to_pylist():
            x = _unpack_vectors(r["kind"], r["vectors"], dim)
            m = len(x) * parts
            yield r["keys"], x, unpack(r["near"], "u1").reshape(m, b), unpack(r["bounds"], "<f2").astype(np.float64).reshape(m, b + 1)


def _round(source: DataFrame, book: Book, b: int, was: int | None) -> DataFrame:
    """One assignment of all blocks to ``book``, staged with the sums of the entries' members."""
    dim = book.parts * book.width

    def run(batches):
        sums = _Sums(book)
        for keys, x, near, bounds in _fresh(batches, dim) if was is None else _stored(batches, dim, book.parts, was):
            x = x.reshape(-1, book.parts, book.width)
            _, near, bounds, used, _ = assign(x, book, b, near, bounds)
            sums.add(x, near)
            kind, body = _pack_vectors(x.reshape(-1, dim))
            yield _frame([dict(keys=keys, kind=kind, vectors=body, near=pack(near.ravel(), "u1"), bounds=pack(_down(bounds).ravel(), "<f2"), used=used)])
        if rows := list(sums.rows()):
            yield _frame(rows)

    return C.staged(source.mapInArrow(run, STATE), "vector_codes")


def _sums(state: DataFrame) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Members and sums of all entries: at most entries x parts rows."""
    def add(g: pd.DataFrame) -> pd.DataFrame:
        total = [sum(map(int, c)) for c in zip(*(t.split(",") for t in g["total"]))]
        return pd.DataFrame({"part": g["part"].iloc[:1], "entry": g["entry"].iloc[:1], "members": [int(g["members"].sum())], "total": [",".join(map(str, total))]})

    rows = state.where("part IS NOT NULL").select("part", "entry", "members", "total").groupBy("part", "entry").applyInPandas(add, "part int, entry int, members long, total string")
    return {(r["part"], r["entry"]): (r["members"], [int(v) for v in r["total"].split(",")]) for r in rows.collect()}


def first_book(rows: DataFrame, parts: int, entries: int) -> Book | None:
    """The parts of the ``entries`` rows with the smallest ids; None where there is no row."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    first = rows.orderBy(*order).limit(entries).select("vector").collect()
    if not first:
        return None
    dim = len(first[0]["vector"])
    if any(len(r["vector"]) != dim for r in first):
        first = rows.where(F.size("vector") == dim).orderBy(*order).limit(entries).select("vector").collect()
    x = whole(np.array([r["vector"] for r in first], np.float64))
    return Book(x.reshape(len(first), parts, dim // parts).transpose(1, 0, 2).copy())


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Book | None]:
    """(vec_id, label, code, error) of every kept vector, and the final codebooks. ``code`` has two
    hex digits a part, so there are 256 entries at most."""
    if not 0 < entries <= 256:
        raise ValueError("1 to 256 entries")
    rows = kept(vectors, parts)
    book = first_book(rows, parts, entries)
    if book is None:
        return vectors.sparkSession.createDataFrame([], CODES), None
    state, was = rows.where(F.size("vector") == parts * book.width), None
    b, least = min(book.k, max(1, -(-book.k // 4))), min(book.k, max(1, -(-book.k // 8)))
    for i in range(rounds):
        state = _round(state, book, b, was)
        book, was = book.update(_sums(state)), b
        state = state.where("keys IS NOT NULL").drop("part", "entry", "members", "total")
        if i:
            b = min(b, max(least, state.agg(F.max("used")).first()[0] or 1))

    dim = parts * book.width

    def last(batches):
        for keys, x, near, bounds in _fresh(batches, dim) if was is None else _stored(batches, dim, parts, was):
            d, near, *_ = assign(x.reshape(-1, parts, book.width), book, b, near, bounds)
            error = d.reshape(-1, parts).astype(object).sum(1)
            kept_keys = pa.ipc.open_stream(keys).read_next_batch()
            code = np.frombuffer(near[:, 0].tobytes().hex().encode(), f"S{2 * parts}").astype(str)
            yield C.arrow_batch(pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64())]),
                                vec_id=kept_keys.column(0), label=kept_keys.column(1), code=code.tolist(), error=[e if e < 1 << 63 else None for e in error.tolist()])

    return state.mapInArrow(last, CODES), book


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Each row with the sum of its label's errors, summed before they meet the rows."""
    per = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"), F.count("error").alias("n"), F.count("*").alias("m"))
    per = per.select(F.col("label").alias("l"), F.when(F.col("n") == F.col("m"), F.col("s")).try_cast("long").alias("label_error"))
    return codes.join(per, codes["label"].eqNullSafe(per["l"]), "left").drop("l")


def compressed(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and the codebooks' hash of every kept vector."""
    codes, book = encode(vectors)
    codes = C.staged(codes, "vector_codes")
    return (with_label_errors(codes).withColumn("codebooks_sha256", F.lit(book.sha256() if book else hashlib.sha256(b"").hexdigest()))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))
