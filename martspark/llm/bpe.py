"""Byte-level BPE encoding and decoding of whole texts.

Global distinct-word shuffle: pre-tokens are exploded with their positions (packed per block,
``blocks``), each distinct word of the corpus is encoded once, its ids are joined back and the
texts reassembled by position. Decoding joins the ids with the token-byte table.

Null text: empty, no ids. Null doc_id: kept. Repeated rows: a result each. Other columns of the
input are not read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import blocks as B
from . import common as C

LETTER, NUMBER, OTHER, WHITE = 0, 1, 2, 3
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file; some 50,000 entries, the bound of what is sent to the tasks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(1)
def classes() -> np.ndarray:
    """Class of each code point as the splitting pattern sees it."""
    import regex
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\p{White_Space}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return out


def pretokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the matches of public_tokenizers.PATTERN in UTF-8 texts, vectorised.

    Runs of a class are tokens; a space before a run of another class than white joins it; other
    white space before it stands alone when it is the last of its run; a lone apostrophe takes
    the contraction letters that follow it.
    """
    n_bytes = len(data)
    if not n_bytes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    lead = np.flatnonzero((data & 0xC0) != 0x80) if n < n_bytes else None
    kind = classes()[points]
    cut = np.zeros(n + 1, bool)
    cut[np.searchsorted(lead, offs) if lead is not None else offs] = True
    start = np.ones(n, bool)
    start[1:] = (kind[1:] != kind[:-1]) | cut[1:n]
    white = kind == WHITE
    # the last of a run of white space, if something of its text follows
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & ~white[1:] & ~cut[1:n]
    start |= last
    joined = np.flatnonzero(last & (points == 32)) + 1     # the run after a space begins with the space
    start[joined] = False
    # contractions
    quote = np.flatnonzero((points == 39) & start)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~cut[quote + 1]]
    if len(quote):
        follow = np.concatenate([points, np.zeros(2, np.uint32)])
        one, two = follow[quote + 1], np.where(cut[np.minimum(quote + 2, n)], 0, follow[quote + 2])
        for c in CONTRACTIONS:
            if len(c) == 1:
                hit = quote[one == c[0]]
            else:
                hit = quote[(one == c[0]) & (two == c[1])]
            start[hit + 1] = False
            stop = hit + 1 + len(c)
            stop = stop[stop < n]
            start[stop[kind[stop] == LETTER]] = True
    s = np.flatnonzero(start)
    s = lead[s] if lead is not None else s
    e = np.append(s[1:], n_bytes)
    return s, e, np.searchsorted(s, offs)


def encode(docs: DataFrame, ranks: dict[bytes, int], buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The staged blocks of ``docs`` and their words' ids; ``decode`` makes rows of them."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = B.blocks(docs, pretokens, buckets, name="bpe")
    sent = spark.sparkContext.broadcast(ranks)

    def answer(words, _counts):
        core = encoder(sent.value)
        ids = [core.encode_single_piece(w) for w in words]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
        first = np.cumsum(size) - size

        def reply(own):
            n = size[own]
            return B.pack(np.concatenate([[len(own)], n, flat[C.ragged(first[own], n)]]))
        return reply, None

    return parts, B.per_word(parts, buckets, answer)


_CORE: dict = {}


def encoder(ranks: dict[bytes, int]):
    """The merges of one piece by rank; made once in a worker."""
    if id(ranks) not in _CORE:
        import tiktoken
        _CORE.clear()
        _CORE[id(ranks)] = (ranks, tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe)
    return _CORE[id(ranks)][1]


def word_ids(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, number and ids of a block's words, in the order of their numbers."""
    numbers, sizes, flats = [], [], []
    for n, a in zip(answers["numbers"], answers["answer"]):
        got = B.unpack(a).astype(np.int64)
        k = got[0]
        numbers.append(B.unpack_rising(n))
        sizes.append(got[1:1 + k])
        flats.append(got[1 + k:])
    if not numbers:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    number, size, flat = map(np.concatenate, (numbers, sizes, flats))
    first, count = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
    first[number], count[number] = np.cumsum(size) - size, size
    return first, count, flat.astype(np.uint32)


def token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table by id: first place, size, bytes."""
    size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    for w, i in ranks.items():
        size[i] = len(w)
    by_id = sorted((i, w) for w, i in ranks.items())
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(w for _, w in by_id), np.uint8)


def decode_ids(ids: np.ndarray, tokens: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the ids and the size of each, by a join with the token-byte table."""
    first, size, flat = tokens
    n = size[ids]
    return flat[C.ragged(first[ids], n)], n


def decode(encoded: tuple[DataFrame, DataFrame], ranks: dict[bytes, int], keep: bool = False) -> DataFrame:
    """Per text: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep`` also ids and decoded."""
    parts, answers = encoded
    sent = parts.sparkSession.sparkContext.broadcast(token_bytes(ranks))

    def work(row, right):
        ids_of, valid, sizes, body = B.bodies(row)
        first, count, flat = word_ids(right)
        out, done = [], 0
        ends = np.cumsum(sizes)
        for i, j in C.chunks(np.concatenate([[0], ends]), 1 << 19):
            lo, hi = (0 if i == 0 else ends[i - 1]), ends[j - 1]
            w = body[lo:hi]
            n = count[w]
            ids = flat[C.ragged(first[w], n)]
            raw, per = decode_ids(ids, sent.value)
            upto = np.concatenate([[0], np.cumsum(n)])
            tok = upto[np.concatenate([[0], ends[i:j] - lo])]
            byte = np.concatenate([[0], np.cumsum(per)])[tok]
            raw, ids = raw.tobytes(), ids.astype("<u4")
            for k in range(j - i):
                mine, text = ids[tok[k]:tok[k + 1]], raw[byte[k]:byte[k + 1]]
                r = [int(ids_of[i + k]) if valid[i + k] else None, len(mine), hashlib.sha256(mine.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()]
                out.append(r + ([mine.tolist(), text] if keep else []))
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if keep else [])
        out = pd.DataFrame(out, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded binary" if keep else "")
    return B.reassemble(parts, answers, work, schema)


def encode_decode(docs: DataFrame, path: str, keep: bool = False) -> DataFrame:
    """Encode whole texts by the ranks in ``path``, decode the ids; one row per input row."""
    ranks = load_ranks(path)
    return decode(encode(docs, ranks), ranks, keep)
