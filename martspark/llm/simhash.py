"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in at most ``BITS`` bits agree on one of ``BITS + 1`` parts of their
bits, so each distinct fingerprint goes to a bucket for each part; a bucket over ``leaf`` is
divided again on the parts of its remaining bits, until none is. In a bucket, fingerprints are
sorted by Gray rank; upper nodes hold the bits that all below share, lower nodes only what is
left, and a search adds up differences on the way down and drops whole groups beyond the limit.
A task sends on a spanning forest of the links that it finds, never the pairs.

Null or wordless text: fingerprint zero, linked like any other. Null doc_id: takes part, never
names a component (one of such rows alone has a null component_id). Repeated rows: a result each;
``survivors`` keeps one. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

BITS = 3
SEED = 42
LEAF = 4096
FANOUT = 8
ROWS = 1 << 16          # rows indexed together
FRONTIER = 1 << 18      # (query, node) pairs looked at together


def fingerprint(text: bytes, width: int = 3) -> int:
    """Majority bits of the XXH64 of all word shingles."""
    from xxhash import xxh64_intdigest as digest
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    stops = (ends - 1)[width - 1:].tolist()
    starts = [0, *ends[:-width].tolist()]
    total, n = np.zeros(64, np.int64), len(stops)
    for k in range(0, n, 1 << 16):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k:k + (1 << 16)], stops[k:k + (1 << 16)])], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """Staged (doc_id, th, fp long) of every text; th is the hash of the text as it is."""
    src = C.byte_texts(docs).withColumn("th", F.xxhash64("text"))

    def run(batches):
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            raw = data.tobytes()
            fps = np.array([fingerprint(raw[i:j], width) for i, j in zip(offs[:-1].tolist(), offs[1:].tolist())], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fps)], names=["doc_id", "th", "fp"])

    return C.staged(src.mapInArrow(run, "doc_id long, th long, fp long"), "simhash")


def parts_of(free: np.ndarray, n: int) -> list[np.ndarray]:
    """The set bits of each mask, dealt out over n masks."""
    out = [np.zeros(len(free), np.uint64) for _ in range(n)]
    nth = np.zeros(len(free), np.int64)
    size = np.bitwise_count(free).astype(np.int64)
    for bit in range(64):
        one = np.uint64(1 << bit)
        has = (free & one) != 0
        part = nth * n // np.maximum(size, 1)
        for k in range(n):
            out[k] |= np.where(has & (part == k), one, np.uint64(0))
        nth += has
    return out


def divided(rows: DataFrame, bits: int) -> DataFrame:
    """(fp, mask, value) in a bucket for each part of the bits that ``mask`` leaves free."""
    def run(batches):
        for b in batches:
            fp, mask = (np.asarray(b.column(c)).view(np.uint64) for c in ("fp", "mask"))
            kinds, inverse = np.unique(mask, return_inverse=True)
            for part in parts_of(~kinds, bits + 1):
                m = (kinds | part)[inverse]
                fresh = part[inverse] != 0
                yield pa.RecordBatch.from_arrays([pa.array(x[fresh].view(np.int64)) for x in (fp, m, fp & m)], names=["fp", "mask", "value"])

    return rows.select("fp", "mask").mapInArrow(run, "fp long, mask long, value long")


def bucketed(distinct: DataFrame, bits: int, leaf: int) -> list[DataFrame]:
    """Tables of (fp, mask, value) whose buckets (mask, value) have at most ``leaf`` rows."""
    done, rows = [], C.staged(divided(distinct.select("fp", F.lit(0).cast("long").alias("mask")), bits), "simhash")
    while True:
        hot = C.staged(rows.groupBy("mask", "value").count().filter(F.col("count") > leaf).select("mask", "value"), "simhash")
        if hot.isEmpty():
            return [*done, rows]
        done.append(rows.join(hot, ["mask", "value"], "left_anti").select("fp", "mask", "value"))
        rows = C.staged(divided(rows.join(hot, ["mask", "value"], "left_semi"), bits).distinct(), "simhash")


def gray_rank(x: np.ndarray) -> np.ndarray:
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(k))
    return x


class GrayIndex:
    """The index of some buckets: fp sorted by (bucket, Gray rank), levels of nodes above."""

    def __init__(self, fp: np.ndarray, bucket: np.ndarray, fanout: int = FANOUT):
        order = np.lexsort((gray_rank(fp), bucket))
        self.fp, self.bucket = fp[order], bucket[order]
        n = len(fp)
        size = np.bincount(self.bucket)
        first = np.cumsum(size) - size
        place = np.arange(n) - first[self.bucket]
        # a level: first member of each node; the nodes of a bucket follow one another
        starts, width = [np.arange(n)], 1
        while width < size.max(initial=1):
            width *= fanout
            starts.append(np.flatnonzero(place % width == 0))
        self.starts = starts
        self.shared = []      # per level: mask of the shared bits, their pattern
        for s in starts:
            both, any_ = np.bitwise_and.reduceat(self.fp, s), np.bitwise_or.reduceat(self.fp, s)
            self.shared.append((both | ~any_, both))
        # what a node has beyond the node above
        self.own = []
        for level, (mask, pattern) in enumerate(self.shared):
            if level + 1 < len(starts):
                above = np.searchsorted(starts[level + 1], starts[level], "right") - 1
                mask = mask & ~self.shared[level + 1][0][above]
            self.own.append((mask, pattern & mask))
        self.last = [np.append(s[1:], n) - 1 for s in starts]

    def links(self, bits: int):
        """Arrays of (query, member), query before member, at most ``bits`` apart; bit by bit."""
        top = len(self.starts) - 1
        q = np.arange(len(self.fp))
        root = np.searchsorted(self.starts[top], q, "right") - 1
        stack = [(top, q[k:k + FRONTIER], root[k:k + FRONTIER], np.zeros(len(q[k:k + FRONTIER]), np.uint8)) for k in range(0, len(q), FRONTIER)]
        # the root's own bits are shared with each of its queries: no difference there
        while stack:
            level, q, node, acc = stack.pop()
            if level == 0:
                if len(q):
                    yield q, node
                continue
            below = self.starts[level - 1]
            lo = np.searchsorted(below, self.starts[level][node])
            hi = np.searchsorted(below, self.last[level][node], "right")
            n = hi - lo
            kid = C.ragged(lo, n)
            kq, ka = np.repeat(q, n), np.repeat(acc, n)
            later = self.last[level - 1][kid] > kq
            kid, kq, ka = kid[later], kq[later], ka[later]
            mask, pattern = self.own[level - 1]
            ka = ka + np.bitwise_count((self.fp[kq] & mask[kid]) ^ pattern[kid])
            near = ka <= bits
            kid, kq, ka = kid[near], kq[near], ka[near]
            step = FRONTIER // FANOUT
            for k in range(0, len(kq), step):
                stack.append((level - 1, kq[k:k + step], kid[k:k + step], ka[k:k + step]))


def forest(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the trees of ``a`` and ``b``; parent points at a root after it."""
    while len(a):
        a, b = parent[a], parent[b]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        open_ = lo != hi
        a, b = lo[open_], hi[open_]
        np.minimum.at(parent, b, a)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent


def links_within(rows: DataFrame, bits: int) -> DataFrame:
    """(a, b): a spanning forest of the links of each bucket."""
    def index(fp, mask, value):
        new = np.ones(len(fp), bool)
        new[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
        bucket = np.cumsum(new) - 1
        alone = np.bincount(bucket)[bucket] == 1
        fp, bucket = fp[~alone], bucket[~alone]
        if not len(fp):
            return
        got = GrayIndex(fp, np.unique(bucket, return_inverse=True)[1])
        parent = np.arange(len(got.fp))
        for q, member in got.links(bits):
            parent = forest(parent, q, member)
        child = np.flatnonzero(parent != np.arange(len(parent)))
        if len(child):
            yield pa.RecordBatch.from_arrays([pa.array(got.fp[child].view(np.int64)), pa.array(got.fp[parent[child]].view(np.int64))], names=["a", "b"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(np.stack([np.asarray(b.column(c)).view(np.uint64) for c in ("fp", "mask", "value")]))
            size += len(b)
            if size >= ROWS:
                fp, mask, value = np.concatenate(held, axis=1)
                open_ = (mask == mask[-1]) & (value == value[-1])      # the last bucket may go on
                cut = len(fp) if not open_.any() else int(np.argmax(open_))
                yield from index(fp[:cut], mask[:cut], value[:cut])
                held, size = [np.stack([fp[cut:], mask[cut:], value[cut:]])], len(fp) - cut
        if held:
            fp, mask, value = np.concatenate(held, axis=1)
            yield from index(fp, mask, value)

    return rows.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(run, "a long, b long")


def grouped(prints: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint in ``prints`` (doc_id, fp)."""
    one = C.staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash")
    found = [links_within(t, bits) for t in bucketed(one, bits, leaf)]
    links = found[0]
    for x in found[1:]:
        links = links.union(x)
    roots = components(links)
    of = one.join(roots, one["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    low = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return C.staged(of.join(low, "root").select("fp", "component_id", "root"), "simhash")


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = BITS) -> DataFrame:
    """Per text: doc_id, fingerprint (16 hex digits), component_id."""
    prints = fingerprints(docs, width)
    of = grouped(prints, bits).select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, width: int = 3, bits: int = BITS) -> DataFrame:
    """One document of each group, with the smallest doc_id (a null one last), all its columns."""
    prints = fingerprints(docs, width)
    of = grouped(prints, bits).select("fp", "root")
    first = prints.join(of, "fp").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first"))
    # two groups may not name one key: a doc_id and text have one fingerprint
    got = C.matched(docs, first.select("first.doc_id", "first.th")).filter("nth = 1")
    return got.select(*[C.named(c, "carry").alias(c) for c in docs.columns])
