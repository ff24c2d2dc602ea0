"""Phrase collocations by vertically partitioned word-suffix trees (after ERA).

The symbols are words, each language has a tree of its own, and suffixes are cut off after three
words, or at the end of their piece. Vertical partitioning deals the tree out: a prefix is a word;
prefixes are packed into groups whose suffixes fit the memory budget. A word with more suffixes than
that is extended until its subtrees fit; at the depth of the tree a subtree is one leaf, so its
leaves are dealt out, over as many groups as the budget asks for. Each group then builds its subtree
alone, from the sorted suffixes of its prefixes: equal ones are a leaf, whose total is its count, and
an inner node's is the sum of its leaves'. An extended word's two-word nodes are summed over its
groups. No frequent phrase holds a rare word, so rare words end suffixes.

Texts are read in blocks of words, numbered by the block's own dictionary; dictionaries meet by hash
of (language, word), where words get their totals, numbers and groups. Each block sends its distinct
suffixes with counts, so a phrase of any frequency has one entry a block. Joins of the frequent
phrases with their parts, by Spark, give the scores.

Nulls: a null text is empty, a null lang is ``und``. Ties are ordered as the ranking says; repeated
rows count each. A text of any length is read in slices that end where a piece ends; a piece is held
whole. Empty texts have no word. An empty table gives an empty result. Columns besides lang and text
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .blocks import blob_words, pack, pack_rising, unpack, unpack_rising, words_blob

LEAST, SHARE, TOP = 10, 50, 2000          # occurrences of a candidate; per cent of it in a longer one; rows a language
BLOCK_WORDS = 1 << 20                     # of a block, about
BUDGET = 1 << 20                          # suffixes of a group
BUCKET_BYTES = 64 << 20                   # of text a dictionary bucket
BITS = 21                                 # numbers below 2**21: three fit a 64-bit code

ENDS_PIECE = C.table_of(b".,;:!?\n\x0b\x0c\r")
ENDS_WORD = ENDS_PIECE | C.table_of(b" \t")

STAGED = "block long, bucket int, body binary, linked binary, words binary, numbers binary, counts binary"
WORDS = "block long, numbers binary, ids binary, home binary, split binary, lang string, word string, id long, n long"
SUFFIXES = "home long, first binary, second binary, third binary, counts binary"
NODES = "w1 long, w2 long, w3 long, a long"


def slices(offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with long texts cut after pieces, and the text of each slice (of an empty one, any)."""
    long = np.flatnonzero(np.diff(offs) > C.CHUNK_BYTES)
    if not len(long):
        return offs, np.arange(len(offs) - 1)
    cuts = [offs]
    for i in long.tolist():
        ends = np.flatnonzero(ENDS_PIECE[data[offs[i]:offs[i + 1]]]) + offs[i] + 1
        at = np.searchsorted(ends, np.arange(offs[i] + C.CHUNK_BYTES, offs[i + 1], C.CHUNK_BYTES))
        cuts.append(ends[np.unique(at[at < len(ends)])])
    new = np.sort(np.concatenate(cuts))         # equal offsets stay: these are empty texts
    new = new[np.concatenate([[True], (np.diff(new) > 0) | np.isin(new[1:], offs)])]
    return new, np.minimum(np.searchsorted(offs, new[:-1], "right") - 1, len(offs) - 2)


class _Block:
    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.body, self.linked, self.words = [], [], 0

    def add(self, data: np.ndarray, offs: np.ndarray, lang: np.ndarray, langs: list[bytes]) -> None:
        s, e, first = C.spans(~ENDS_WORD[data], offs)
        if not len(s):
            return
        code = np.repeat(lang, np.diff(first))
        ends = np.zeros(len(data) + 1, np.int32)
        np.cumsum(ENDS_PIECE[data], out=ends[1:])
        linked = np.zeros(len(s), bool)
        linked[:-1] = ends[e[:-1]] == ends[s[1:]]
        linked[first[1:][first[1:] > 0] - 1] = False
        h, g = C.span_hashes(data, s, e)
        salt = C.mix(code.astype(np.uint64) + np.uint64(1))
        rep, inverse = C.distinct(h ^ salt, g + salt)
        raw, put = data.tobytes(), self.number.setdefault
        own = np.fromiter((put(langs[c] + b" " + raw[a:b], len(self.number)) for c, a, b in zip(code[rep].tolist(), s[rep].tolist(), e[rep].tolist())), np.int64, len(rep))
        self.body.append(own[inverse].astype(np.uint32))
        self.linked.append(linked)
        self.words += len(s)

    def rows(self, block: int, buckets: int) -> Iterator[dict]:
        body = np.concatenate(self.body)
        count = np.bincount(body, minlength=len(self.number))
        order = np.argsort(-count, kind="stable")       # small numbers pack best
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.number)
        words, count = [words[i] for i in order.tolist()], count[order]
        yield dict(block=block, bucket=None, body=pack(rank[body]), linked=pack(np.packbits(np.concatenate(self.linked)), "u1"))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = (C.span_hashes(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], ends[:-1]]), ends)[0] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
            yield dict(block=block, bucket=int(at[part[0]]), words=words_blob([words[i] for i in part.tolist()]), numbers=pack_rising(part), counts=pack(count[part], "<u8"))


def _blocks(docs: DataFrame, buckets: int) -> DataFrame:
    src = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *((n, pa.binary()) for n in ("body", "linked", "words", "numbers", "counts"))])

    def build(batches):
        from pyspark import TaskContext
        part, made, cur = TaskContext.get().partitionId(), 0, _Block()

        def out():
            return pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in cur.rows(part << 32 | made, buckets)], schema)

        for b in batches:
            offs, data = C.buffers(b.column("text"))
            coded = b.column("lang").dictionary_encode()
            langs, lang = [x.encode() for x in coded.dictionary.to_pylist()], coded.indices.to_numpy()
            offs, text = slices(offs, data)
            for i, j in C.chunks(offs):
                cur.add(C.LOWER[data[offs[i]:offs[j]]], offs[i:j + 1] - offs[i], lang[text[i:j]], langs)
                if cur.words >= BLOCK_WORDS:
                    yield out()
                    made, cur = made + 1, _Block()
        if cur.words:
            yield out()

    return C.staged(src.mapInArrow(build, STAGED), "collocations")


def packed_groups(n: np.ndarray, budget: int) -> np.ndarray:
    """Groups for prefixes with ``n`` suffixes each, falling, none above the budget: each group is
    filled in turn and none exceeds the budget."""
    group, used, out = 0, 0, np.empty(len(n), np.int64)
    for i, x in enumerate(n.tolist()):
        if used + x > budget:
            group, used = group + 1, 0
        out[i], used = group, used + x
    return out


def _words(parts: DataFrame, buckets: int, least: int, budget: int) -> DataFrame:
    """Staged: for each packet its words' numbers (0: rare), groups and number of groups if more
    than one; the frequent words with number and total; each language's total, as a word's of
    number 0, a row a bucket."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        packets, counts, bucket = [], [], int(g["bucket"].iloc[0])
        for words, n in zip(g["words"], g["counts"]):
            packets.append(np.fromiter((number.setdefault(w, len(number)) for w in blob_words(words)), np.int64))
            counts.append(unpack(n, "<u8").astype(np.int64))
        total = np.zeros(len(number), np.int64)
        for own, n in zip(packets, counts):
            total[own] += n
        order = np.argsort(-total, kind="stable")
        order = order[total[order] >= least]
        ids, home, split = (np.zeros(len(number), np.int64) for _ in range(3))
        ids[order] = np.arange(len(order)) * buckets + bucket + 1
        split[order] = -(-total[order] // budget)
        light = order[split[order] == 1]
        home[light] = packed_groups(total[light], budget) * buckets + bucket
        words = [w.rpartition(b" ") for w in number]
        sums: dict[bytes, int] = {}
        for (lang, _, _), n in zip(words, total.tolist()):
            sums[lang] = sums.get(lang, 0) + n
        found = [(words[i][0].decode(), words[i][2].decode(), int(ids[i]), int(total[i])) for i in order.tolist()]
        found += [(lang.decode(), None, 0, n) for lang, n in sums.items()]
        back = pd.DataFrame({"block": g["block"].to_numpy(), "numbers": g["numbers"].to_numpy(), "ids": [pack(ids[p], "<u8") for p in packets],
                             "home": [pack(home[p], "<u8") for p in packets], "split": [pack(split[p], "<u8") for p in packets]})
        named = pd.DataFrame(found, columns=["lang", "word", "id", "n"])
        return pd.concat([back.astype({"block": "Int64"}), named.astype({"id": "Int64", "n": "Int64"})], ignore_index=True)[[f.split()[0] for f in WORDS.split(", ")]]

    packets = parts.where("bucket IS NOT NULL").select("block", "bucket", "words", "numbers", "counts")
    return C.staged(packets.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(run, WORDS), "collocations")


def leaves(first: np.ndarray, second: np.ndarray, third: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct suffixes in order, with their totals."""
    if not len(first):
        return first, second, third, np.zeros(0, np.int64)
    if max(first.max(), second.max(), third.max()) < 1 << BITS:
        code = first << 2 * BITS | second << BITS | third
        if counts is None:
            code.sort()
        else:
            order = np.argsort(code, kind="stable")     # runs in order, one a block
            code, counts = code[order], counts[order]
        at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        code, mask = code[at], (1 << BITS) - 1
        out = code >> 2 * BITS, code >> BITS & mask, code & mask
    else:
        order = np.lexsort((third, second, first))
        first, second, third = first[order], second[order], third[order]
        counts = None if counts is None else counts[order]
        at = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (third[1:] != third[:-1])]))
        out = first[at], second[at], third[at]
    return *out, np.diff(at, append=len(order) if counts is not None else len(first)) if counts is None else np.add.reduceat(counts, at)


def _suffixes(parts: DataFrame, words: DataFrame) -> DataFrame:
    """Each block's distinct suffixes of two words at least, a packet for each of their groups."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        body = unpack(left["body"].iloc[0]).astype(np.int64)
        linked = np.unpackbits(unpack(left["linked"].iloc[0], "u1"), count=len(body)).astype(bool)
        numbers = np.concatenate([unpack_rising(x) for x in right["numbers"]])
        ids, home, split = (np.zeros(len(numbers), np.int64) for _ in range(3))
        for name, to in (("ids", ids), ("home", home), ("split", split)):
            to[numbers] = np.concatenate([unpack(x, "<u8") for x in right[name]]).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        order = order[np.count_nonzero(ids == 0):]
        rank = np.zeros(len(ids), np.int64)              # numbers of the block's frequent words, in order of their ids
        rank[order] = np.arange(1, len(order) + 1)
        ids, home, split = (np.concatenate([[0], x[order]]) for x in (ids, home, split))
        w1 = rank[body]
        w2 = np.zeros_like(w1)
        w2[:-1] = np.where(linked[:-1], w1[1:], 0)
        w3 = np.zeros_like(w1)
        w3[:-1] = np.where(w2[:-1] > 0, w2[1:], 0)
        at = np.flatnonzero((w1 > 0) & (w2 > 0))
        w1, w2, w3, n = leaves(w1[at], w2[at], w3[at])
        to, many = home[w1] * 2, split[w1]
        wide = np.flatnonzero(many > 1)
        sub = C.mix(ids[w2[wide]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids[w3[wide]].astype(np.uint64)) % many[wide].astype(np.uint64)
        to[wide] = (ids[w1[wide]] << 24 | sub.astype(np.int64)) * 2 + 1
        homes, group = np.unique(to, return_inverse=True)
        order = np.argsort(group.astype(np.uint16) if len(homes) < 1 << 16 else group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(len(homes) + 1))
        rows = []
        for h, i, j in zip(homes.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            k = order[i:j]
            rows.append((h, pack(np.diff(ids[w1[k]], prepend=0), "<u8"), pack(ids[w2[k]], "<u8"), pack(ids[w3[k]], "<u8"), pack(n[k])))
        return pd.DataFrame(rows, columns=["home", "first", "second", "third", "counts"])

    body = parts.where("body IS NOT NULL").select("block", "body", "linked")
    back = words.where("block IS NOT NULL").select("block", "numbers", "ids", "home", "split")
    return body.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(run, SUFFIXES)


def _nodes(suffixes: DataFrame, least: int) -> DataFrame:
    """Nodes of two words (w3 is 0) and of three with their totals, from each group's subtree: the
    frequent ones, and all two-word nodes of a word that has several groups, a row each."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        wide = bool(g["home"].iloc[0] & 1)
        cols = [np.concatenate([unpack(x, "<u8") for x in g[name]]).astype(np.int64) for name in ("second", "third")]
        first = np.concatenate([np.cumsum(unpack(x, "<u8").astype(np.int64)) for x in g["first"]])
        w1, w2, w3, n = leaves(first, *cols, np.concatenate([unpack(x) for x in g["counts"]]).astype(np.int64))
        at = np.flatnonzero(np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])]))
        inner = np.add.reduceat(n, at)
        two = np.flatnonzero(inner >= (1 if wide else least))
        three = np.flatnonzero((w3 > 0) & (n >= least))
        return pd.DataFrame({"w1": np.concatenate([w1[at[two]], w1[three]]), "w2": np.concatenate([w2[at[two]], w2[three]]),
                             "w3": np.concatenate([np.zeros(len(two), np.int64), w3[three]]), "a": np.concatenate([inner[two], n[three]])})

    return C.staged(suffixes.groupBy("home").applyInPandas(run, NODES), "collocations")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), in whole numbers of 38 digits."""
    wide = lambda c, p=18: c.cast(f"decimal({p},0)")
    return F.call_function("div", wide(wide(a) * wide(a), 38) * F.lit(1000000).cast("decimal(7,0)"), wide(wide(left) * wide(right), 38))


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """The ``top`` phrases of two and three words of each language: lang, rank, phrase, a, l, r, n, score."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    parts = _blocks(docs, buckets)
    words = _words(parts, buckets, least, budget)
    nodes = _nodes(_suffixes(parts, words), least)

    word = words.where("id > 0").select("id", "lang", "word", "n")
    total = words.where("id = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    named = lambda k: word.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("n").alias(f"f{k}"), *([F.col("lang")] if k == 1 else []))
    pair = nodes.where("w3 = 0").groupBy("w1", "w2").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    three = nodes.where("w3 > 0")

    inside = (three.select("a", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
              .groupBy("p.w1", "p.w2").agg(F.max("a").alias("longer")))
    two = (pair.join(inside, ["w1", "w2"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
           .join(named(1), "w1").join(named(2), "w2")
           .select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score")))
    three = (three.join(pair.select("w1", "w2", F.col("a").alias("f12")), ["w1", "w2"])
             .join(pair.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23")), ["w2", "w3"])
             .join(named(1), "w1").join(named(2).drop("f2"), "w2").join(named(3), "w3")
             .select("*", _score(F.col("a"), F.col("f1"), F.col("f23")).alias("s1"), _score(F.col("a"), F.col("f12"), F.col("f3")).alias("s2")))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
