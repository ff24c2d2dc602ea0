"""Blocks of texts with a dictionary each, so that a word crosses the network once per block.

A block is some texts of one task, ``BLOCK_BYTES`` together. Its tokens are exploded with their
positions; a combine before the shuffle leaves the block's distinct words, numbered, and each
position as such a number. Words bound for the same bucket (by hash of their bytes) travel in one
packet. ``per_word`` meets all packets of a bucket, so it sees each distinct word of the corpus
once, and its answers return to the blocks. Buckets get hash-spread distinct words and a frequent
word has one entry per block, so none is hot; more buckets make them smaller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BLOCK_BYTES = 32 << 20
LEVEL = 9              # of zstd
STAGED = "block long, bucket int, doc_ids binary, sizes binary, body binary, words binary, numbers binary, counts binary"
ANSWER = "block long, numbers binary, answer binary, total long, known long, extra binary"


def pack(x: np.ndarray, kind: str = "<u4", level: int = LEVEL) -> bytes:
    """Whole numbers as zstd of their bytes, lowest bytes first together."""
    planes = np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(len(x), np.dtype(kind).itemsize).T
    return zstandard.ZstdCompressor(level).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_rising(x: np.ndarray, level: int = LEVEL) -> bytes:
    """Rising numbers, by their steps."""
    return pack(np.diff(x, prepend=0), level=level)


def unpack_rising(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.int64)


def words_blob(words: list[bytes], level: int = LEVEL) -> bytes:
    sizes = pack(np.fromiter(map(len, words), np.uint32, len(words)), level=level)
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.ZstdCompressor(level).compress(b"".join(words))


def blob_words(blob: bytes) -> list[bytes]:
    n = int.from_bytes(blob[:4], "little")
    ends = np.cumsum(unpack(blob[4:4 + n])).tolist()
    raw = zstandard.ZstdDecompressor().decompress(blob[4 + n:]) if ends and ends[-1] else b""
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


class _Block:
    """The texts gathered so far: ids, tokens per text, each token's number, the words."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.ids, self.valid, self.sizes, self.body, self.counts, self.bytes = [], [], [], [], [], 0

    def add(self, ids, valid, data, offs, trained, tokens) -> None:
        s, e, first = tokens(data, offs)
        rep, inverse = C.distinct(*C.span_hashes(data, s, e))
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(s[rep].tolist(), e[rep].tolist())]
        put = self.number.setdefault
        own = np.fromiter((put(w, len(self.number)) for w in words), np.int64, len(words))
        sizes = np.diff(first)
        self.ids.append(ids)
        self.valid.append(valid)
        self.sizes.append(sizes)
        self.body.append(own[inverse].astype(np.uint32))
        learn = np.bincount(inverse[np.repeat(trained, sizes)], minlength=len(words))
        self.counts.append((own, learn))
        self.bytes += len(data)

    def rows(self, block: int, buckets: int, counted: bool, level: int = LEVEL) -> Iterator[dict]:
        body = np.concatenate(self.body)
        order = np.argsort(-np.bincount(body, minlength=len(self.number)), kind="stable")   # small numbers pack best
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.number)
        words = [words[i] for i in order.tolist()]
        count = np.zeros(len(words), np.int64)
        for own, learn in self.counts:
            count[rank[own]] += learn
        ids = np.concatenate(self.ids).astype("<i8").tobytes() + np.concatenate(self.valid).tobytes()
        yield dict(block=block, bucket=None, doc_ids=ids, sizes=pack(np.concatenate(self.sizes), level=level),
                   body=pack(rank[body], level=level), words=None, numbers=None, counts=None)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
        at = (C.span_hashes(data, starts, ends)[0] % np.uint64(buckets)).astype(np.int64) if words else np.zeros(0, np.int64)
        order = np.argsort(at, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
            if len(part):
                yield dict(block=block, bucket=int(at[part[0]]), doc_ids=None, sizes=None, body=None,
                           words=words_blob([words[i] for i in part.tolist()], level), numbers=pack_rising(part, level), counts=pack(count[part], "<u8", level) if counted else None)


def blocks(docs: DataFrame, tokens: Callable, buckets: int, trained=None, fold: np.ndarray | None = None, name: str = "blocks", block_bytes: int = BLOCK_BYTES,
           level: int = LEVEL) -> DataFrame:
    """Staged rows: one with the bodies per block, and one packet per block and bucket.

    ``tokens(data, offs)`` gives starts, ends and each text's first token; ``trained`` is a
    boolean column, the texts whose words are counted (default: no counts); ``fold`` replaces bytes;
    ``level`` of zstd: a lower one costs less time and more disk.
    """
    counted = trained is not None
    src = C.byte_texts(docs).withColumn("trained", trained if counted else F.lit(False))

    def build(batches):
        from pyspark import TaskContext
        part, made, cur = TaskContext.get().partitionId(), 0, _Block()
        schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *((n, pa.binary()) for n in
                            ("doc_ids", "sizes", "body", "words", "numbers", "counts"))])
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            data = data if fold is None else fold[data]
            col = b.column("doc_id")
            ids = np.asarray(col.fill_null(0))
            valid = np.asarray(col.is_valid()).astype(np.uint8)
            learn = np.asarray(b.column("trained").cast(pa.int8())).astype(bool)
            for i, j in C.chunks(offs):
                cur.add(ids[i:j], valid[i:j], data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], learn[i:j], tokens)
                if cur.bytes >= block_bytes:
                    yield pa.RecordBatch.from_pylist(list(cur.rows(part << 32 | made, buckets, counted, level)), schema)
                    made, cur = made + 1, _Block()
        if cur.ids:
            yield pa.RecordBatch.from_pylist(list(cur.rows(part << 32 | made, buckets, counted, level)), schema)

    return C.staged(src.mapInArrow(build, STAGED), name)


def per_word(parts: DataFrame, buckets: int, answer: Callable) -> DataFrame:
    """(block, numbers, answer, total, known) of ``answer(words, counts)``, called once per bucket
    with its distinct words and their counts over the corpus; it returns a function of word
    indices that gives a packet's answer, and bytes of its own. total and known are the bucket's
    sum of counts and number of counted words; with those bytes, extra, they are on one of its rows."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        packets, counts = [], []
        for words, n in zip(g["words"], g["counts"]):
            own = np.fromiter((number.setdefault(w, len(number)) for w in blob_words(words)), np.int64)
            packets.append(own)
            counts.append(unpack(n, "<u8").astype(np.int64) if n is not None else 0)
        total = np.zeros(len(number), np.int64)
        for own, n in zip(packets, counts):
            total[own] += n
        reply, extra = answer(list(number), total)
        out = pd.DataFrame({"block": g["block"].to_numpy(), "numbers": g["numbers"], "answer": [reply(p) for p in packets]})
        out["total"] = out["known"] = 0
        out["extra"] = [extra] + [None] * (len(out) - 1)
        out.loc[0, "total"], out.loc[0, "known"] = int(total.sum()), int((total > 0).sum())
        return out

    packets = parts.filter(F.col("bucket").isNotNull()).select("block", "bucket", "words", "numbers", "counts")
    return packets.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(lambda g: run(g.reset_index(drop=True)), ANSWER)


def bodies(row: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's doc ids, which of them are not null, tokens per text, all tokens' numbers."""
    sizes = unpack(row["sizes"]).astype(np.int64)
    n = len(sizes)
    return np.frombuffer(row["doc_ids"], "<i8", n), np.frombuffer(row["doc_ids"], np.uint8, n, 8 * n).astype(bool), sizes, unpack(row["body"]).astype(np.int64)


def reassemble(parts: DataFrame, answers: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(body row, answers frame)`` for each block, which gives a frame of its texts."""
    body = parts.filter(F.col("body").isNotNull()).select("block", "doc_ids", "sizes", "body")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return work(left.iloc[0], right)

    return (body.groupBy("block").cogroup(answers.select("block", "numbers", "answer").groupBy("block"))
            .applyInPandas(run, schema))
