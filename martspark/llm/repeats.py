"""Repeated passages: maximal repeats from the interval tree of enhanced suffix arrays.

A string of ``LENGTH`` bytes is found through its anchor, its K-gram of smallest hash (the leftmost
such): equal strings have equal anchors at equal places, so everything that can repeat meets in
the group of its anchor's hash. An anchor stands for the run of strings that have it; the bytes of
that run are its context. Of equal contexts only the first goes on, in a task and then over all;
the others are removed whole. Groups with several contexts get a suffix array: suffixes are sorted,
common prefixes of neighbours computed, and a stack scan yields the intervals, those with different
bytes to the left (or a context's begin) being maximal repeats with all occurrences. All but the
first occurrence, by doc_id and place, are removed.

A group of over ``leaf`` contexts is not put into one suffix array: the strings of each of its
contexts are compared by 128-bit hash instead, combined in each task before they are dealt out,
which finds the same bytes. Nothing is dropped at any size.

Rows are (doc_id, text): repeated rows with one doc_id and text are one document and get the same
result; other texts with the same doc_id follow in a fixed order. A null doc_id comes last. Null
text: empty. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .blocks import pack, unpack

LENGTH, K = 100, 32
CHUNK = 1 << 20            # window starts looked at together
BLOCK = 32 << 20           # bytes of text combined before the shuffle
LEAF = 2000                # most contexts in one group's suffix array
SUFFIXES = 60_000          # suffixes sorted together (whole groups)
FIELDS = (("a", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("null", "u1"), ("tie", "<u8"), ("lo", "<u4"), ("len", "<u2"))
PACKET = "bucket int, " + ", ".join(f"`{n}` binary" for n, _ in FIELDS)
SPANS = "doc long, tie long, lo binary, hi binary"

_B1, _B2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, i up to n at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, CHUNK + 4 * LENGTH)
        have = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))]) for b in (base, pow(base, -1, 1 << 64)))
        _powers[base] = have
    return have


class Rolling:
    """Polynomial hashes of any ranges of some bytes."""

    def __init__(self, data: np.ndarray, base: int):
        up, self.down = powers(base, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def of(self, lo, hi) -> np.ndarray:
        return C.mix((self.sums[hi] - self.sums[lo]) * self.down[lo])

    def grams(self, k: int) -> np.ndarray:
        n = max(0, len(self.sums) - k)
        return C.mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def smallest(h: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost smallest of each w neighbours."""
    at = np.arange(len(h), dtype=np.int32)
    size = 1
    while size < w:
        step = min(size, w - size)
        left, right = h[:-step], h[step:]
        later = right < left
        h = np.where(later, right, left)
        at = np.where(later, at[step:], at[:-step])
        size += step
    return at


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each anchor: hash, context hash, text, first window start (in the text), context size."""
    out, pieces = [], []
    # texts together up to CHUNK bytes; a longer one in ranges of window starts
    for i, j in C.chunks(offs, CHUNK):
        if j == i + 1 and offs[j] - offs[i] > CHUNK:
            for lo in range(int(offs[i]), int(offs[j]) - LENGTH + 1, CHUNK):
                pieces.append((i, np.array([lo, min(lo + CHUNK + LENGTH - 1, int(offs[j]))])))
        else:
            pieces.append((i, offs[i:j + 1]))
    for first, bounds in pieces:
        part = data[bounds[0]:bounds[-1]]
        if len(part) < LENGTH:
            continue
        roll = Rolling(part, _B1)
        at = smallest(roll.grams(K), LENGTH - K + 1)
        ends = np.repeat(bounds[1:] - bounds[0], np.diff(bounds))
        start = np.flatnonzero(ends[:len(at)] - np.arange(len(at)) >= LENGTH)
        if not len(start):
            continue
        anchor, end = at[start], ends[start]
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (end[1:] != end[:-1])
        head = np.flatnonzero(new)
        lo, hi = start[head], start[np.append(head[1:], len(start)) - 1] + LENGTH
        place = anchor[head].astype(np.int64)
        a = roll.of(place, place + K)
        c = C.mix(roll.of(lo, hi) + (hi - lo).astype(np.uint64) * C._C[1] + (place - lo).astype(np.uint64))
        text = first + np.searchsorted(bounds, lo + bounds[0], "right") - 1
        out.append((a, c, text, lo + bounds[0] - offs[text], hi - lo))
    if not out:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z, z
    return tuple(np.concatenate(x) for x in zip(*out))


def first_of_each(keys: tuple[np.ndarray, ...], t: dict) -> np.ndarray:
    """Sorted by the keys, then by document and place: the order, and where each key begins."""
    order = np.lexsort((t["lo"], t["tie"], t["doc"], t["null"], *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, new


def repeated(t: dict, order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Rows that are not the first of their key; the same place of a document twice is one."""
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
    same = np.all([t[k][order] == t[k][lead] for k in ("doc", "null", "tie", "lo")], axis=0) if len(order) else np.zeros(0, bool)
    return order[~new & ~same]


def packets(t: dict, by: np.ndarray, buckets: int, fields=FIELDS):
    at = (by % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((t["lo"], t["tie"], t["doc"], at))
    for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
        if len(part):
            yield {"bucket": int(at[part[0]])} | {n: pack(t[n][part], k) for n, k in fields}


def span_rows(t: dict, rows: np.ndarray, size: np.ndarray | None = None) -> list[dict]:
    """One row a document with its spans, merged where they touch."""
    if not len(rows):
        return []
    rows = rows[np.lexsort((t["lo"][rows], t["tie"][rows], t["doc"][rows], t["null"][rows]))]
    doc, null, tie, lo = (t[k][rows].astype(np.int64) for k in ("doc", "null", "tie", "lo"))
    hi = lo + (t["len"] if size is None else size)[rows].astype(np.int64)
    new = np.ones(len(rows), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (null[1:] != null[:-1])
    out = []
    for p, q in zip(np.flatnonzero(new).tolist(), np.append(np.flatnonzero(new)[1:], len(rows)).tolist()):
        a, b = merged(lo[p:q], hi[p:q])
        out.append(dict(doc=None if null[p] else int(doc[p]), tie=int(tie[p]), lo=pack(a), hi=pack(b)))
    return out


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order of lo, joined where they touch."""
    order = np.argsort(lo, kind="stable")
    lo, far = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > far[:-1]
    return lo[new], far[np.append(np.flatnonzero(new)[1:], len(lo)) - 1]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, tie, text): tie, the text's hash, tells different texts with one doc_id apart."""
    return C.byte_texts(docs).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("tie"), "text")


_PACKET_TYPE = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n, _ in FIELDS), ("doc_", pa.int64()), ("tie_", pa.int64()), ("lo_", pa.binary()), ("hi_", pa.binary())])
_BOTH = PACKET + ", doc_ long, tie_ long, lo_ binary, hi_ binary"


def _rows(packed, spans) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([*packed, *({f"{k}_": v for k, v in s.items()} for s in spans)], _PACKET_TYPE)


def _taken_apart(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (both.filter("bucket is not null").select("bucket", *[n for n, _ in FIELDS]),
            both.filter("bucket is null").select(*[F.col(f"{n}_").alias(n) for n in ("doc", "tie", "lo", "hi")]))


def context_packets(texts: DataFrame, buckets: int) -> DataFrame:
    """Of each task's texts: packets of its first of equal contexts, and spans of the others."""
    def run(batches):
        held, size = [], 0

        def flush():
            t = {n: np.concatenate([h[n] for h in held]) for n, _ in FIELDS}
            order, new = first_of_each((t["a"], t["c"]), t)
            keep = order[new]
            return _rows(packets({n: t[n][keep] for n in t}, t["a"][keep], buckets), span_rows(t, repeated(t, order, new)))

        for b in batches:
            offs, data = C.buffers(b.column("text"))
            doc, null = np.asarray(b.column("doc").fill_null(0)), np.asarray(b.column("doc").is_null()).astype(np.uint8)
            tie = np.asarray(b.column("tie")).astype(np.uint64)
            for i, j in C.chunks(offs):
                a, c, text, lo, n = anchors(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                text = text + i
                held.append(dict(a=a, c=c, doc=doc[text], null=null[text], tie=tie[text], lo=lo, len=n))
                size += int(offs[j] - offs[i])
                if size >= BLOCK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(run, _BOTH)


def opened(g: pd.DataFrame) -> dict:
    return {n: np.concatenate([unpack(b, k) for b in g[n]]).astype(np.uint64 if k == "<u8" else np.int64) for n, k in FIELDS}


def compared(packed: DataFrame, buckets: int, leaf: int) -> DataFrame:
    """In each bucket: spans of all but the first of equal contexts; of groups with several
    contexts, the contexts to fetch (a, lo, hi), per document."""
    schema = SPANS + ", a binary, hot boolean"

    def run(g: pd.DataFrame) -> pd.DataFrame:
        t = opened(g)
        order, new = first_of_each((t["a"], t["c"]), t)
        out = [dict(r, a=None, hot=False) for r in span_rows(t, repeated(t, order, new))]
        keep = order[new]
        t = {n: t[n][keep] for n in t}
        _, inverse, count = np.unique(t["a"], return_inverse=True, return_counts=True)
        group = count[inverse]
        for hot in (False, True):
            rows = np.flatnonzero((group > 1) & ((group > leaf) == hot))
            rows = rows[np.lexsort((t["lo"][rows], t["tie"][rows], t["doc"][rows], t["null"][rows]))]
            key = np.stack([t[k][rows].astype(np.int64) for k in ("doc", "null", "tie")]) if len(rows) else np.zeros((3, 0), np.int64)
            for part in np.split(rows, np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1):
                if len(part):
                    p = part[0]
                    out.append(dict(doc=None if t["null"][p] else int(t["doc"][p]), tie=int(t["tie"][p].astype(np.int64)), lo=pack(t["lo"][part]),
                                    hi=pack(t["lo"][part] + t["len"][part]), a=pack(t["a"][part], "<u8"), hot=hot))
        out = pd.DataFrame(out, columns=["doc", "tie", "lo", "hi", "a", "hot"])
        return out.astype({"doc": "Int64"})

    return packed.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(run, schema)


def fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(a, hot, doc, tie, lo, body) of each wanted context, from the texts: a task reads one of
    equal rows only."""
    wanted = wanted.groupBy(F.col("doc").alias("w_doc"), F.col("tie").alias("w_tie")).agg(F.collect_list(F.struct("lo", "hi", "a", "hot")).alias("want"))
    both = texts.join(wanted, texts["doc"].eqNullSafe(wanted["w_doc"]) & (texts["tie"] == wanted["w_tie"])).select("doc", "tie", "text", "want")

    def run(batches):
        done = set()
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            raw, cols = data.tobytes(), {k: [] for k in ("a", "hot", "doc", "tie", "lo", "body")}
            for i, (doc, tie, want) in enumerate(zip(b.column("doc").to_pylist(), b.column("tie").to_pylist(), b.column("want").to_pylist())):
                if (doc, tie) in done:
                    continue
                done.add((doc, tie))
                for w in want:
                    a, lo, hi = unpack(w["a"], "<u8").view(np.int64).tolist(), unpack(w["lo"]).tolist(), unpack(w["hi"]).tolist()
                    cols["a"] += a
                    cols["lo"] += lo
                    cols["body"] += [raw[offs[i] + p:offs[i] + q] for p, q in zip(lo, hi)]
                    for k, v in (("hot", w["hot"]), ("doc", doc), ("tie", tie)):
                        cols[k] += [v] * len(a)
            yield pa.RecordBatch.from_arrays([pa.array(cols["a"], pa.int64()), pa.array(cols["hot"], pa.bool_()), pa.array(cols["doc"], pa.int64()), pa.array(cols["tie"], pa.int64()),
                                              pa.array(cols["lo"], pa.int64()), pa.array(cols["body"], pa.binary())], names=list(cols))

    return both.mapInArrow(run, "a long, hot boolean, doc long, tie long, lo long, body binary")


def suffix_array(group: np.ndarray, offs: np.ndarray, data: np.ndarray):
    """Of contexts in groups: their suffixes of LENGTH bytes or more, sorted within the group, as
    (context, start), and the common prefix of each with the one before it (0 below LENGTH)."""
    size = np.diff(offs)
    n = size - LENGTH + 1
    ctx = np.repeat(np.arange(len(size)), n)
    start = np.arange(len(ctx)) - np.repeat(np.cumsum(n) - n, n)
    width = int(size.max())
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.as_strided(padded, (len(data), width), (1, 1))[offs[ctx] + start]
    left = size[ctx] - start
    rows[np.arange(width) >= left[:, None]] = 0
    keys = np.concatenate([group[ctx].astype(">u4")[:, None].view(np.uint8).reshape(-1, 4), rows], axis=1)
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{width + 4}").ravel(), kind="stable")
    ctx, start, rows, left = ctx[order], start[order], rows[order], left[order]
    differ = rows[1:] != rows[:-1]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    same = np.minimum(same, np.minimum(left[1:], left[:-1]))
    same[(group[ctx[1:]] != group[ctx[:-1]]) | (same < LENGTH)] = 0
    return ctx, start, np.concatenate([[0], same])


def maximal_repeats(lcp: np.ndarray, before: np.ndarray):
    """(size, first, last) of the intervals of suffixes whose common prefix can't be extended to
    the left: a stack scan; ``before`` is the byte before each suffix, -1 at a context's begin."""
    inside = np.flatnonzero(lcp)
    for run in np.split(inside, np.flatnonzero(np.diff(inside) > 1) + 1):
        if not len(run):
            continue
        stack: list[list[int]] = []       # common prefix, first suffix, the one byte before or -1
        for i in [*run.tolist(), int(run[-1]) + 1]:
            depth = int(lcp[i]) if i <= run[-1] else 0
            first, byte = i - 1, int(before[i - 1])
            while stack and stack[-1][0] > depth:
                top = stack.pop()
                if top[2] != byte:
                    top[2] = -1
                if top[2] == -1:
                    yield top[0], top[1], i - 1
                first, byte = top[1], top[2]
            if depth:
                if stack and stack[-1][0] == depth:
                    if stack[-1][2] != byte:
                        stack[-1][2] = -1
                else:
                    stack.append([depth, first, byte])


def repeat_spans(t: dict, group: np.ndarray, offs: np.ndarray, data: np.ndarray) -> list[dict]:
    """Spans of all occurrences but the first of each maximal repeat of the contexts."""
    ctx, start, lcp = suffix_array(group, offs, data)
    before = np.where(start > 0, data[np.maximum(offs[ctx] + start - 1, 0)].astype(np.int64), -1)
    place = t["lo"][ctx] + start
    rank = np.empty(len(ctx), np.int64)
    rank[np.lexsort((place, t["tie"][ctx], t["doc"][ctx], t["null"][ctx]))] = np.arange(len(ctx))
    rows, sizes = [], []
    for size, first, last in maximal_repeats(lcp, before):
        occ = np.arange(first, last + 1)
        lead = occ[rank[occ].argmin()]
        c = ctx[occ]
        other = (occ != lead) & ~((place[occ] == place[lead]) & (t["doc"][c] == t["doc"][ctx[lead]]) & (t["null"][c] == t["null"][ctx[lead]]) & (t["tie"][c] == t["tie"][ctx[lead]]))
        rows.append(occ[other])
        sizes.append(np.full(int(other.sum()), size))
    if not rows:
        return []
    at = np.concatenate(rows)
    u = {k: t[k][ctx[at]] for k in ("doc", "null", "tie")} | {"lo": place[at], "len": np.concatenate(sizes)}
    return span_rows(u, np.arange(len(at)))


def _columns(b) -> dict:
    return dict(doc=np.asarray(b.column("doc").fill_null(0)), null=np.asarray(b.column("doc").is_null()).astype(np.int64),
                tie=np.asarray(b.column("tie")).astype(np.uint64), lo=np.asarray(b.column("lo")))


def unlike_last(b: pa.Table, last: tuple | None) -> tuple[pa.Table, tuple | None]:
    """Rows of sorted contexts that are not the same place as the one before, and the last place."""
    if not len(b):
        return b, last
    place = [np.asarray(x) for k in ("a", "doc", "tie", "lo") for x in (b.column(k).is_null(), b.column(k).fill_null(0))]
    new = np.ones(len(b), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in place], axis=0)
    new[0] = tuple(x[0] for x in place) != last
    return b.filter(pa.array(new)), tuple(x[-1] for x in place)


def by_suffix_array(contexts: DataFrame, buckets: int) -> DataFrame:
    """Spans from groups of at most ``leaf`` contexts, whole groups at a time. Contexts that equal
    rows brought from several tasks are one before they join a group."""
    schema = pa.schema([("doc", pa.int64()), ("tie", pa.int64()), ("lo", pa.binary()), ("hi", pa.binary())])

    def run(batches):
        held: pa.Table | None = None
        last = None

        def work(part: pa.Table):
            t = _columns(part)
            a = np.asarray(part.column("a"))
            offs, data = C.buffers(part.column("body"))
            group = np.unique(a, return_inverse=True)[1]
            # whole groups up to SUFFIXES suffixes
            heads = np.append(np.flatnonzero(np.append(True, np.diff(group) != 0)), len(a))
            upto = np.concatenate([[0], np.cumsum(np.diff(offs) - LENGTH + 1)])
            p = 0
            while p < len(heads) - 1:
                q = max(p + 1, int(np.searchsorted(upto[heads], upto[heads[p]] + SUFFIXES, "right")) - 1)
                i, j = heads[p], heads[q]
                if j - i > 1:
                    rows = repeat_spans({k: v[i:j] for k, v in t.items()}, group[i:j], offs[i:j + 1] - offs[i], data[offs[i]:offs[j]])
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                p = q

        for b in batches:
            b, last = unlike_last(pa.Table.from_batches([b]), last)
            held = b if held is None else pa.concat_tables([held, b]).combine_chunks()
            if len(held) >= 4096:
                a = np.asarray(held.column("a"))
                cut = int(np.searchsorted(a, a[-1]))
                if cut:
                    yield from work(held.slice(0, cut).combine_chunks())
                    held = held.slice(cut)
        if held is not None and len(held):
            yield from work(held.combine_chunks())

    return contexts.repartition(buckets, "a").sortWithinPartitions("a", "doc", "tie", "lo").mapInArrow(run, SPANS)


def by_window(contexts: DataFrame, buckets: int) -> DataFrame:
    """Packets and spans, as ``context_packets`` gives, of every string of the contexts."""
    def run(batches):
        for b in batches:
            t, (offs, data) = _columns(b), C.buffers(b.column("body"))
            for i, j in C.chunks(offs):
                part, o = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                n = np.diff(o) - LENGTH + 1
                ctx = np.repeat(np.arange(j - i), n)
                start = np.arange(len(ctx)) - np.repeat(np.cumsum(n) - n, n)
                lo = o[ctx] + start
                u = {k: t[k][i:j][ctx] for k in ("doc", "null", "tie")} | {"lo": t["lo"][i:j][ctx] + start, "len": np.full(len(ctx), LENGTH)}
                u["a"], u["c"] = (Rolling(part, base).of(lo, lo + LENGTH) for base in (_B1, _B2))
                order, new = first_of_each((u["a"], u["c"]), u)
                keep = order[new]
                yield _rows(packets({k: u[k][keep] for k in u}, u["a"][keep], buckets), span_rows(u, repeated(u, order, new)))

    return contexts.mapInArrow(run, _BOTH)


def repeats(docs: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Spans (doc, tie, lo, hi) of repeated bytes, in several rows a document."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed(docs)
    packed, spans = _taken_apart(C.staged(context_packets(texts, buckets), "repeats"))
    more = C.staged(compared(packed, buckets, leaf), "repeats")
    spans = spans.union(more.filter("a is null").select("doc", "tie", "lo", "hi"))
    contexts = C.staged(fetched(texts, more.filter("a is not null")), "repeats")
    spans = spans.union(by_suffix_array(contexts.filter("not hot").drop("hot"), buckets))
    packed, local = _taken_apart(C.staged(by_window(contexts.filter("hot").drop("hot"), buckets), "repeats"))
    # the window's first is kept: leaf beyond any count, so that nothing is fetched again
    windows = compared(packed, buckets, 1 << 62).filter("a is null").select("doc", "tie", "lo", "hi")
    return spans.union(local).union(windows)


def remove_repeats(docs: DataFrame, leaf: int = LEAF, keep: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``keep`` also the remaining
    bytes and the spans."""
    spans = repeats(docs, leaf).groupBy(F.col("doc").alias("s_doc"), F.col("tie").alias("s_tie")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    texts = keyed(docs)
    both = texts.join(spans, texts["doc"].eqNullSafe(spans["s_doc"]) & (texts["tie"] == spans["s_tie"]), "left").select("doc", "text", "spans")
    more = [("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int64())))] if keep else []
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *more])

    def run(batches):
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            raw, out = data.tobytes(), []
            for i, (doc, found) in enumerate(zip(b.column("doc").to_pylist(), b.column("spans").to_pylist())):
                text, lo, hi = raw[offs[i]:offs[i + 1]], np.zeros(0, np.int64), np.zeros(0, np.int64)
                if found:
                    lo, hi = merged(*(np.concatenate([unpack(x[k]) for x in found]).astype(np.int64) for k in ("lo", "hi")))
                left = b"".join(text[p:q] for p, q in zip([0, *hi.tolist()], [*lo.tolist(), len(text)]))
                out.append(dict(doc_id=doc, n_bytes=len(text), n_removed=int((hi - lo).sum()), n_spans=len(lo), kept_sha256=hashlib.sha256(left).hexdigest())
                           | (dict(kept=left, spans=np.stack([lo, hi], 1).tolist()) if keep else {}))
            yield pa.RecordBatch.from_pylist(out, schema)

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary, spans array<array<long>>" if keep else ""))
