"""License scans: an exact set-similarity join of text blocks with license templates.

A text is cut into blocks that overlap by half, of twice 64 words or twice the longest template's,
so a template lies whole in one. Tokens are ordered by the number of blocks of the
corpus that have them, rarest first. A block that holds the threshold's share of a template's
tokens must hold one of the template's first ones (prefix filter), must have so many tokens
(length filter), and must still be able to reach the share from the place of its first match
(positional filter); what is left is verified: the share, and that the template's anchor, the words
that tell its license from others, stands together in the block. Phrases of the base are found as
they stand. A text of any length is cut so; of templates with one label the larger share counts.

The corpus sends one row per template token and task; templates are a parameter, bounded by
``MAX_TEMPLATES``, and are all that is broadcast.

Null text: empty. Null doc_id: kept. Repeated rows: a result each. Extra columns are not read. An
empty table gives no rows. The score is the largest contained share of a template that meets the
threshold, 1 where a phrase of the base stands, else 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

STRIDE = 64
THRESHOLD = 0.8
MAX_TEMPLATES = 1000
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
TEMPLATES = (          # label, text, and the anchor: words of it that must stand together
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "use this file"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "free software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("mpl", "licensed under the mozilla public license version 2 0", "mozilla"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "by nc"),
)

_WORD = C.table_of(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


def word_spans(data: np.ndarray, offs: np.ndarray):
    """Lower-cased bytes, and the spans of words of [0-9A-Za-z] and all beyond ASCII."""
    return C.LOWER[data], *C.spans(_WORD[data], offs)


def hashes_of(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw]).astype(np.int64)
    return C.span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)[0]


class Templates:
    """Templates as sets of numbered tokens, and the phrases of the base."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"at most {MAX_TEMPLATES} templates")
        self.stride = max([STRIDE, *(len(t.split()) for _, t, _ in templates)])
        self.labels = [k for k, _, _ in templates]
        sets = [sorted(set(t.split())) for _, t, _ in templates]
        self.tokens = sorted({w for s in sets for w in s} | {w for p, _ in phrases for w in p.split()} | {w for _, _, a in templates for w in a.split()})
        number = {w: i for i, w in enumerate(self.tokens)}
        self.sets = [np.array([number[w] for w in s]) for s in sets]
        self.need = np.array([int(np.ceil(threshold * len(s) - 1e-9)) for s in sets])
        self.phrases = [([number[w] for w in p.split()], k) for p, k in phrases]
        self.anchors = [[number[w] for w in a.split()] for _, _, a in templates]
        h = hashes_of(self.tokens)
        self.order = np.argsort(h)
        self.hashes = h[self.order]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The token number of each word's hash; -1 for words of no template."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at], -1)

    def ordered(self, blocks_with: dict[int, int]) -> Templates:
        """Fixes the global order: tokens in fewer blocks first."""
        freq = np.array([blocks_with.get(i, 0) for i in range(len(self.tokens))])
        by = np.lexsort((np.arange(len(freq)), freq))
        self.rank = np.empty(len(by), np.int64)
        self.rank[by] = np.arange(len(by))
        self.ranked = [np.sort(self.rank[s]) for s in self.sets]
        self.has = np.zeros((len(self.tokens), len(self.sets)), np.int32)
        first: dict[int, list] = {}
        for t, s in enumerate(self.ranked):
            self.has[s, t] = 1
            for place in range(len(s) - self.need[t] + 1):
                first.setdefault(int(s[place]), []).append((t, place))
        # prefix index: by rank, (template, place)
        self.index_n = np.array([len(first.get(r, ())) for r in range(len(by))])
        self.index_at = np.cumsum(self.index_n) - self.index_n
        flat = [x for r in range(len(by)) for x in first.get(r, ())]
        self.index = np.array(flat, np.int64).reshape(-1, 2)
        return self


def block_tokens(t: Templates, number: np.ndarray, first: np.ndarray):
    """Distinct (block, token number) of all blocks; a block is the text's place of its first word
    over the stride. Also each text's first block, and words per block."""
    sizes = np.diff(first)
    n_blocks = np.maximum(1, -(-sizes // t.stride) - 1)
    start = np.cumsum(n_blocks) - n_blocks
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero(number >= 0)
    d = doc[at]
    part = (at - first[d]) // t.stride
    # a word lies in the block that starts with its part, and in the one before
    low, high = np.maximum(part - 1, 0), np.minimum(part, n_blocks[d] - 1)
    pair = np.concatenate([start[d] + low, (start[d] + high)[high > low]]) * len(t.tokens) + np.concatenate([number[at], number[at][high > low]])
    pair = np.unique(pair)
    return pair // len(t.tokens), pair % len(t.tokens), start, n_blocks


def matches(t: Templates, block: np.ndarray, number: np.ndarray):
    """(block, template, share) of every block that holds the threshold's share of a template."""
    none = np.zeros(0, np.int64)
    if not len(block):
        return none, none, np.zeros(0)
    rank = t.rank[number]
    order = np.lexsort((rank, block))
    block, rank = block[order], rank[order]
    new = np.ones(len(block), bool)
    new[1:] = block[1:] != block[:-1]
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(block)))
    mine = np.cumsum(new) - 1
    place = np.arange(len(block)) - head[mine]
    n = t.index_n[rank]
    at = C.ragged(t.index_at[rank], n)
    own, where = np.repeat(mine, n), np.repeat(place, n)
    temp, spot = t.index[at, 0], t.index[at, 1]
    pair = own * len(t.sets) + temp
    _, lead = np.unique(pair, return_index=True)        # the first match of the pair, as ranks rise
    own, temp, spot, where = own[lead], temp[lead], spot[lead], where[lead]
    sizes = np.array([len(s) for s in t.sets])
    most = 1 + np.minimum(sizes[temp] - spot - 1, size[own] - where - 1)
    able = (size[own] >= t.need[temp]) & (most >= t.need[temp])
    own, temp = own[able], temp[able]
    if not len(own):
        return none, none, np.zeros(0)
    some, inverse = np.unique(own, return_inverse=True)
    here = np.zeros((len(some), len(t.tokens)), np.int32)
    spot = np.searchsorted(some, mine)
    spot = np.minimum(spot, len(some) - 1)
    hit = some[spot] == mine
    here[spot[hit], rank[hit]] = 1
    both = (here @ t.has)[inverse, temp]
    good = both >= t.need[temp]
    return block[head[own[good]]], temp[good], both[good] / sizes[temp[good]]


def standing(phrase: list[int], number: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places where the words of a phrase, by number, stand together in one text."""
    k = len(phrase)
    at = np.flatnonzero(number[:max(0, len(number) - k + 1)] == phrase[0])
    for step in range(1, k):
        at = at[number[at + step] == phrase[step]]
    return at[doc[at] == doc[at + k - 1]]


def token_frequencies(docs: DataFrame, t: Templates) -> dict[int, int]:
    """Number of blocks of the corpus with each template token; one row per token and task."""
    def run(batches):
        total = np.zeros(len(t.tokens), np.int64)
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            for i, j in C.chunks(offs):
                low, s, e, first = word_spans(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                _, number, _, _ = block_tokens(t, t.numbers(C.span_hashes(low, s, e)[0]), first)
                total += np.bincount(number, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["token", "n"])

    counted = C.byte_texts(docs).select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in counted.collect()}       # a row per template token


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """Per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and
    found, an array of (label, first word and words of the block, share)."""
    t = Templates(templates, phrases, threshold)
    t = t.ordered(token_frequencies(docs, t))
    sent = docs.sparkSession.sparkContext.broadcast(t)

    def rows(data, offs):
        t = sent.value
        low, s, e, first = word_spans(data, offs)
        number = t.numbers(C.span_hashes(low, s, e)[0])
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        out = [dict(n_words=int(k), n_base=0, first_word=None, last_word=None, base=set(), more=set(), score=0.0, found=[]) for k in np.diff(first)]
        for phrase, label in t.phrases:
            at = standing(phrase, number, doc)
            for p, d in zip((at - first[doc[at]]).tolist(), doc[at].tolist()):
                r = out[d]
                r["n_base"] += 1
                r["first_word"] = p if r["first_word"] is None else min(p, r["first_word"])
                r["last_word"] = p if r["last_word"] is None else max(p, r["last_word"])
                r["base"].add(label)
                r["score"] = 1.0
        block, token, start, n_blocks = block_tokens(t, number, first)
        places: dict[int, np.ndarray] = {}
        for b, temp, share in zip(*(x.tolist() for x in matches(t, block, token))):
            d = int(np.searchsorted(start, b, "right")) - 1
            r, at = out[d], (b - int(start[d])) * t.stride
            if t.anchors[temp]:
                if temp not in places:
                    places[temp] = standing(t.anchors[temp], number, doc)
                lo = int(first[d]) + at
                end = min(lo + 2 * t.stride, int(first[d + 1])) - len(t.anchors[temp])
                if np.searchsorted(places[temp], lo) == np.searchsorted(places[temp], end, "right"):
                    continue
            r["more"].add(t.labels[temp])
            r["score"] = max(r["score"], share)
            r["found"].append(dict(label=t.labels[temp], word=at, words=min(2 * t.stride, r["n_words"] - at), share=share))
        return out

    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
              "found array<struct<label: string, word: long, words: long, share: double>>")
    found_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int64()), ("share", pa.float64())]))

    def run(batches):
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            got = []
            for i, j in C.chunks(offs):
                got += rows(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            cols = [b.column("doc_id"), *(pa.array([r[k] for r in got], pa.int64()) for k in ("n_words", "n_base", "first_word", "last_word")),
                    pa.array([",".join(sorted(r["base"])) for r in got], pa.string()), pa.array([",".join(sorted(r["base"] | r["more"])) for r in got], pa.string()),
                    pa.array([r["score"] for r in got], pa.float64()), pa.array([r["found"] for r in got], found_type)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"])

    return C.byte_texts(docs).mapInArrow(run, schema)
