"""Language-model scores: a causal self-attention model on subword ids, trained in numpy.

Words are counted over all training texts (``blocks``), each distinct word is encoded once into
subword ids, and the ids' counts are summed. Ids are numbered by count; each has an embedding, made
of the classes that are its neighbours in the corpus and of its own class, from which trained maps
give its query, key and value. The next id is given by its class (ids of about equal shares of the
corpus) and its place in the class: the class by self-attention over the ids before it, on top of
the counts of classes after the last id; the id in its class by the counts of ids after the last id
where both are frequent, else after the last id's class. All windows of all
training texts are trained on, each text in one of the rounds, so training grows with the input;
partitions train on their own windows from common weights, which are averaged after each round. A
text is scored in windows that overlap by half: each id once, with the ids of the window before it
masked so that none sees a later one. A very long text is windows like any other's. The tables
are bounded by the vocabulary: numbers x classes, and FREQUENT x FREQUENT.

Null text: empty, one token, the end. Null doc_id: as the empty text for the remainder. Repeated
rows: a result each, and counted each. Ids of one count are numbered by id. Other columns are not
read. Without any training text the counts are 0 and all ids alike. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from . import bpe
from . import common as C

STRIDE = 16                # ids scored in a window, after as many that are only seen
CLASSES = 32               # classes of ids, the last for ids that training has not seen
FREQUENT = 2048            # ids whose pairs are counted each
SMOOTH = 4.0               # counts that the coarser table is worth
EMBED, WIDTH = 32, 16      # of an id: half from its neighbours, half its class's; of a query, key, value
ROUNDS, RATE, BATCH = 4, 0.02, 128     # a text is trained on in one of the rounds
RUN = 8                    # windows that follow one another and are scored together
BLOCK = 16 << 20           # bytes of text in a block
LEVEL = 3                  # of zstd, of blocks and answers
PIECES = 64                # of a summed vector, at most
SLICE = 1 << 18            # ids, or words, of a block looked at together


def word_spans(data: np.ndarray, offs: np.ndarray):
    return C.spans(~C.IS_SPACE[data], offs)


class Numbers:
    """Ids by falling count: ``of`` an id its number, all unseen ids the last; ``group`` of a number
    its class; ``unseen`` ids share the last number. The end is the last id."""

    def __init__(self, counts: np.ndarray):
        order = np.lexsort((np.arange(len(counts)), -counts))
        self.seen = int((counts > 0).sum())
        self.of = np.empty(len(counts), np.int64)
        self.of[order] = np.minimum(np.arange(len(counts)), self.seen)
        self.unseen = len(counts) - self.seen
        self.count = np.append(counts[order[:self.seen]], 0)
        self.size = self.seen + 1
        self.pad = self.size
        upto = np.cumsum(self.count) - self.count / 2
        self.group = np.minimum(upto / max(1, self.count.sum()) * (CLASSES - 1), CLASSES - 2).astype(np.int64)
        self.group[-1] = CLASSES - 1
        # classes whose ids are all frequent come first, as classes follow the count
        self.exact = int(self.group[FREQUENT]) if self.size > FREQUENT else CLASSES - 1
        self.kind = np.uint16 if self.size < 1 << 16 else np.uint32


class Pairs:
    """Counts of neighbours: class after number, number after class, number after number where both
    are frequent; one flat vector, so that it can be summed."""

    def __init__(self, known: Numbers):
        self.known, self.edge = known, min(FREQUENT, known.size)
        self.ends = np.cumsum([known.size * CLASSES, CLASSES * known.size, self.edge * self.edge])
        self.flat = np.zeros(int(self.ends[-1]), np.int64)

    def add(self, last: np.ndarray, then: np.ndarray) -> None:
        a, b, c = np.split(self.flat, self.ends[:2])
        group = self.known.group
        np.add.at(a, last * CLASSES + group[then], 1)        # the counts are far more than a slice's ids
        np.add.at(b, group[last] * self.known.size + then, 1)
        both = (last < self.edge) & (then < self.edge)
        np.add.at(c, (last * self.edge + then)[both], 1)


class Prior:
    """Logs of the chance of a class after a number, and of a number in its class after a number."""

    def __init__(self, pairs: Pairs):
        known = self.known = pairs.known
        after, coarse, fine = (x.astype(np.float64) for x in np.split(pairs.flat, pairs.ends[:2]))
        after, coarse, fine = after.reshape(-1, CLASSES), coarse.reshape(CLASSES, -1), fine.reshape(pairs.edge, -1)
        group, weight = known.group, known.count + 1.0
        total = np.bincount(group, weight, CLASSES)
        share = total / total.sum()
        self.after = np.log((after + SMOOTH * share + 1e-6) / (after.sum(1, keepdims=True) + SMOOTH + 1e-6 * CLASSES)).astype(np.float32)
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        per = np.zeros((CLASSES, CLASSES))
        per[:, group[starts]] = np.add.reduceat(coarse, starts, axis=1)
        self.embed = self.embeddings(coarse.T, share)
        within = (coarse + SMOOTH * (weight / total[group])) / (per[:, group] + SMOOTH)
        self.coarse = np.log(within).astype(np.float32)
        self.coarse[:, -1] -= np.log(max(1, known.unseen))
        n = len(fine)
        self.fine = np.zeros((n, n), np.float32)
        for i in range(n):
            self.fine[i] = np.log((fine[i] + SMOOTH * within[group[i], :n]) / (after[i, group[:n]] + SMOOTH))

    def inside(self, last: np.ndarray, then: np.ndarray) -> np.ndarray:
        group = self.known.group
        out = self.coarse[group[last], then].astype(np.float64)
        both = np.flatnonzero((last < len(self.fine)) & (group[then] < self.known.exact))
        out[both] = self.fine[last[both], then[both]]
        return out

    def embeddings(self, before: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Of each number: principal parts of its neighbours' classes, and a random vector of its
        class, by which ids that have the same neighbours differ."""
        known, half = self.known, EMBED // 2
        shape = lambda n: np.log((n + SMOOTH * share + 1e-6) / (n.sum(1, keepdims=True) + SMOOTH) / (share + 1e-6))
        x = np.concatenate([self.after - np.log(share + 1e-6), shape(before)], axis=1)
        weight = np.sqrt(known.count + 1.0)[:, None]
        x -= (x * weight).sum(0) / weight.sum()
        value, vector = np.linalg.eigh((x * weight).T @ x / weight.sum())
        vector *= np.where(vector[np.abs(vector).argmax(0), np.arange(len(value))] < 0, -1, 1)
        parts = x @ vector[:, -half:] / np.sqrt(np.maximum(value[-half:], 1e-2))
        own = np.random.default_rng(1).standard_normal((CLASSES, half))
        return np.concatenate([np.clip(parts, -4, 4), own[known.group]], axis=1).astype(np.float32)


class Attention:
    """Parameters: maps from embeddings to queries, and to keys and values; distance weights; the
    output. ``after``, the log chance of classes after a number, and the embeddings are fixed."""

    NAMES = ("query", "both", "near", "out", "bias")
    GAP = STRIDE + np.arange(STRIDE)[:, None] - np.arange(2 * STRIDE)
    BACK = np.where(GAP >= 0, GAP, 2 * STRIDE)       # distances; the last: not seen

    def __init__(self, prior: Prior, seed: int = 0):
        rng = np.random.default_rng(seed)
        rand = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.after, self.embed = prior.after, prior.embed
        self.pad, self.tables = len(self.after), None
        self.w = {"query": rand(EMBED, WIDTH), "both": rand(EMBED, 2 * WIDTH), "near": np.zeros(2 * STRIDE, np.float32),
                  "out": rand(WIDTH, CLASSES), "bias": np.zeros(CLASSES, np.float32)}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> Attention:
        at = 0
        for k in self.NAMES:
            n = self.w[k].size
            self.w[k] = flat[at:at + n].reshape(self.w[k].shape).astype(np.float32)
            at += n
        return self

    def scaled(self) -> np.ndarray:
        return self.w["query"] * np.float32(1 / np.sqrt(WIDTH))

    def ready(self) -> Attention:
        """Queries, and keys and values, of all numbers, and ``after`` with the bias: for scoring only."""
        self.tables = self.embed @ self.scaled(), self.embed @ self.w["both"], self.after + self.w["bias"]
        return self

    def maps(self) -> tuple[np.ndarray, np.ndarray]:
        """Products of the maps to queries and keys, and of those to values and the output."""
        return self.scaled() @ self.w["both"][:, :WIDTH].T, self.w["both"][:, WIDTH:] @ self.w["out"]

    def seen(self, win: tuple[np.ndarray, np.ndarray], q: np.ndarray, keys: np.ndarray):
        """Attention in runs of windows before it is divided by its sums, and their inverses."""
        a = q @ keys.swapaxes(2, 3)
        a.clip(-30, 30, out=a)
        np.exp(a, out=a)
        a *= np.append(np.exp(self.w["near"].clip(-30, 30)), np.float32(0)).take(self.BACK)
        a[win[1], :, :STRIDE] = 0
        return a, 1 / (a.reshape(-1, 2 * STRIDE) @ np.ones(2 * STRIDE, np.float32))

    def windowed(self, rows: np.ndarray) -> np.ndarray:
        """A view of runs (n, RUN + 1, STRIDE, k): the windows (n, RUN, 2 * STRIDE, k)."""
        n, many, _, k = rows.shape
        row = rows.itemsize * k
        return np.ndarray((n, many - 1, 2 * STRIDE, k), rows.dtype, rows, 0, (many * STRIDE * row, STRIDE * row, row, rows.itemsize))

    def attended(self, win: tuple[np.ndarray, np.ndarray]):
        """For training: embeddings of the scored ids and of what their windows show, attention,
        attended embeddings, the map from these to classes, exponents of the classes. A window has
        twice as many keys as queries, so the embeddings themselves are attended, and the products
        of the maps are applied to queries and attended embeddings."""
        ids, first = win
        to_key, to_class = self.maps()
        x = self.embed.take(ids, axis=0, mode="clip")
        own, keys = x[:, 1:].reshape(-1, EMBED), self.windowed(x)
        a, share = self.seen(win, (own @ to_key).reshape(*first.shape, STRIDE, EMBED), keys)
        a *= share.reshape(*a.shape[:3], 1)
        y = (a @ keys).reshape(-1, EMBED)
        z = y @ to_class
        z += self.after.take(ids[:, 1:], axis=0, mode="clip").reshape(-1, CLASSES)
        z += self.w["bias"]
        return own, keys, a, y, to_class, z.clip(-60, 60, out=z)

    def exponents(self, win: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Exponents of the classes of each scored id."""
        if self.tables is None:
            return self.attended(win)[-1]
        q, both, after = self.tables
        both = self.windowed(both.take(win[0], axis=0, mode="clip"))
        a, share = self.seen(win, q.take(win[0][:, 1:], axis=0, mode="clip"), both[..., :WIDTH])
        z = ((a @ both[..., WIDTH:]).reshape(-1, WIDTH) * share[:, None]) @ self.w["out"]
        z += after.take(win[0][:, 1:], axis=0, mode="clip").reshape(-1, CLASSES)
        return z.clip(-60, 60, out=z)

    def log_chances(self, win: tuple[np.ndarray, np.ndarray], target: np.ndarray) -> np.ndarray:
        """Log of the chance of each target class (CLASSES: 0)."""
        z, t = self.exponents(win), target.ravel()
        mine = z.ravel().take(np.arange(0, z.size, CLASSES) + np.minimum(t, CLASSES - 1))
        mine -= np.log(np.exp(z, out=z) @ np.ones(CLASSES, np.float32))
        return np.where(t == CLASSES, 0.0, mine).reshape(target.shape)

    def log_sums(self, windows: Windows) -> np.ndarray:
        """Log of the chance of the target classes of each text."""
        logs, runs = np.zeros((windows.runs, RUN)), BATCH // RUN
        for p in range(0, windows.runs, runs):
            logs[p:p + runs] = self.log_chances(*windows.of(slice(p, p + runs))).sum(axis=2)
        return np.bincount(np.repeat(np.arange(len(windows.many)), windows.many), logs.ravel()[:len(windows)], len(windows.many))

    def gradient(self, win: tuple[np.ndarray, np.ndarray], target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss of a target."""
        own, keys, a, y, to_class, z = self.attended(win)
        p, t = np.exp(z, out=z), target.ravel()
        share = np.float32(1) / (p @ np.ones(CLASSES, np.float32))
        real = t != CLASSES
        many = np.count_nonzero(real)
        weight = np.float32(1 / max(1, many))
        share *= weight
        at = np.arange(0, p.size, CLASSES) + t
        if many < len(t):
            share *= real
            at = at[real]
        p *= share[:, None]
        p.reshape(-1)[at] -= weight
        dy = p @ to_class.T
        ds = dy.reshape(*a.shape[:3], EMBED) @ keys.swapaxes(2, 3)
        ds -= np.einsum("ij,ij->i", dy, y).reshape(*a.shape[:3], 1)
        ds *= a                                      # 0 where an id is not seen
        near = np.bincount(self.BACK.ravel(), np.ones(win[1].size, np.float32) @ ds.reshape(-1, self.BACK.size), 2 * STRIDE + 1)[:-1]
        to_key, to_class = own.T @ (ds @ keys).reshape(-1, EMBED), y.T @ p        # of the products of the maps
        return {"query": to_key @ self.w["both"][:, :WIDTH] * np.float32(1 / np.sqrt(WIDTH)),
                "both": np.concatenate([to_key.T @ self.scaled(), to_class @ self.w["out"].T], axis=1),
                "near": near.astype(np.float32), "out": self.w["both"][:, WIDTH:].T @ to_class, "bias": np.ones(len(p), np.float32) @ p}

    def train(self, windows: Windows, rate: float, seed: int, state: dict | None = None) -> Attention:
        """One pass of Adam over the windows; ``state`` keeps its means from call to call."""
        state = {} if state is None else state
        order, w = np.random.default_rng(seed).permutation(len(windows)), self.flat()
        m, v = state.setdefault("means", (np.zeros_like(w), np.zeros_like(w)))
        for lo in range(0, len(windows), BATCH):
            t = state["steps"] = state.get("steps", 0) + 1
            g = self.gradient(*windows.of(order[lo:lo + BATCH], 1))
            g = np.concatenate([g[k].ravel() for k in self.NAMES])
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            w -= rate / (1 - 0.9 ** t) * m / (np.sqrt(v / (1 - 0.98 ** t)) + 1e-6)
            self.load(w)
        return self


class Windows:
    """Windows of some texts, one after another. A text's inputs are the end and its numbers, its
    targets the classes of the numbers and of the end; both are filled up to whole windows, and the
    last run to ``RUN`` of them. ``many`` counts the windows of each text."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, end: int, known: Numbers):
        self.many = -(-(sizes + 1) // STRIDE)
        upto = np.cumsum(self.many)
        start = STRIDE * (upto - self.many)
        self.count = int(upto[-1]) if len(upto) else 0
        self.runs = -(-self.count // RUN)
        ids, goal = np.full(STRIDE * (self.runs * RUN + 1), known.pad, np.int32), np.full(STRIDE * self.runs * RUN, CLASSES, np.int32)
        ids[start + STRIDE] = end
        before = np.cumsum(sizes) - sizes
        for i in range(0, len(numbers), SLICE):
            x = numbers[i:i + SLICE]
            at = np.arange(i, i + len(x))
            at += (start - before)[np.searchsorted(before + sizes, at, "right")]
            ids[at + STRIDE + 1] = x
            goal[at] = known.group[x]
        goal[start + sizes] = known.group[end]
        self.ids, self.goal = ids.reshape(-1, STRIDE), goal.reshape(-1, RUN, STRIDE)
        self.first = np.zeros((self.runs, RUN), bool)
        self.first.reshape(-1)[start // STRIDE] = True

    def __len__(self) -> int:
        return self.count

    def of(self, rows, run: int = RUN) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Of some runs of ``run`` windows: inputs (n, run + 1, STRIDE), with the ids before the run,
        and which windows are a text's first, that see none before them; and targets (n, run, STRIDE)."""
        at = np.arange(0, self.runs * RUN, run)[rows]
        return ((self.ids.take(at[:, None] + np.arange(run + 1), axis=0), self.first.reshape(-1, run)[rows]),
                self.goal.reshape(-1, run, STRIDE)[rows])


def neighbours(numbers: np.ndarray, sizes: np.ndarray, end: int):
    """Slices of: the number before a target, the target, and its text; targets are each text's
    numbers and the end, which also stands before the first."""
    stop = np.cumsum(sizes + 1) - 1
    then = np.empty(len(numbers) + len(sizes), numbers.dtype)
    at = np.ones(len(then), bool)
    at[stop] = False
    then[at], then[stop] = numbers, end
    before = end
    for i in range(0, len(then), SLICE):
        x = then[i:i + SLICE].astype(np.int64)
        yield np.concatenate([[before], x[:-1]]), x, np.searchsorted(stop, np.arange(i, i + len(x)))
        before = x[-1]


def counted(docs: DataFrame, ranks: dict[bytes, int], buckets: int):
    """Staged blocks, and staged answers: count and ids of each block's words."""
    spark = docs.sparkSession
    parts = B.blocks(docs, word_spans, buckets, trained=C.remainder("doc_id", 7) != 2, fold=C.LOWER, name="lm", block_bytes=BLOCK, level=LEVEL)
    sent = spark.sparkContext.broadcast(ranks)

    def answer(words, total):
        enc = library(sent.value)
        ids = [enc.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int64, int(size.sum()))
        first = np.cumsum(size) - size
        seen = np.bincount(flat, np.repeat(total, size)).astype(np.int64) if len(flat) else np.zeros(0, np.int64)

        def reply(own):
            n = size[own]
            a = B.pack(total[own], "<u8", LEVEL)
            return len(a).to_bytes(4, "little") + a + B.pack(np.concatenate([[len(own)], n, flat[C.ragged(first[own], n)]]), level=LEVEL)
        return reply, B.pack(seen, "<u8")

    return parts, C.staged(B.per_word(parts, buckets, answer), "lm")


_LIBRARY: dict = {}


def library(ranks: dict[bytes, int]):
    if id(ranks) not in _LIBRARY:
        import public_tokenizers
        import tiktoken
        _LIBRARY.clear()
        _LIBRARY[id(ranks)] = (ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _LIBRARY[id(ranks)][1]


def block_words(right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's words by number: count, first id, number of ids; and all ids."""
    size = [int.from_bytes(a[:4], "little") for a in right["answer"]]
    first, n, flat = bpe.word_ids(pd.DataFrame({"numbers": right["numbers"], "answer": [a[4 + k:] for a, k in zip(right["answer"], size)]}))
    count = np.zeros(len(first), np.int64)
    for a, k, numbers in zip(right["answer"], size, right["numbers"]):
        count[B.unpack_rising(numbers)] = B.unpack(a[4:4 + k], "<u8").astype(np.int64)
    return count, first, n, flat.astype(np.int64)


def squeezed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(x).tobytes())


def opened(b: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def summed(rows: DataFrame, make, kind: type) -> np.ndarray:
    """The sum over tasks of the vector that ``make(batches)`` gives, or None. It is cut into pieces
    that are summed in two steps, so that no group holds more than some tasks' share of a piece."""
    schema = "piece int, task int, part binary"

    def give(batches):
        from pyspark import TaskContext
        task, got = TaskContext.get().partitionId(), make(batches)
        if got is not None:
            for i, x in enumerate(np.array_split(got.astype(kind, copy=False), min(PIECES, 1 + (len(got) >> 14)))):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([task % PIECES], pa.int32()), pa.array([squeezed(x)], pa.binary())], names=["piece", "task", "part"])

    def add(g: pd.DataFrame) -> pd.DataFrame:
        total = sum(opened(x, kind) for x in g["part"])
        return pd.DataFrame({"piece": g["piece"].iloc[:1], "task": g["task"].iloc[:1], "part": [squeezed(total)]})

    some = rows.mapInArrow(give, schema).groupBy("piece", "task").applyInPandas(add, schema).groupBy("piece").applyInPandas(add, schema)
    got = sorted(some.collect(), key=lambda r: r["piece"])      # at most PIECES rows, together one vector
    return np.concatenate([np.zeros(0, kind), *(opened(r["part"], kind) for r in got)])


def id_counts(answers: DataFrame, n_ids: int) -> np.ndarray:
    """Counts of all ids over the corpus."""
    def make(batches):
        total = np.zeros(n_ids, np.int64)
        for b in batches:
            for x in b.column("extra").to_pylist():
                seen = B.unpack(x, "<u8").astype(np.int64)
                total[:len(seen)] += seen
        return total

    got = summed(answers.filter("extra is not null").select("extra"), make, np.int64)
    return got if len(got) else np.zeros(n_ids, np.int64)


def training_texts(parts: DataFrame, answers: DataFrame, known: Numbers) -> DataFrame:
    """Staged rows (block, numbers, sizes) of the training texts' ids."""
    sent = parts.sparkSession.sparkContext.broadcast(known)

    def pick(row, right):
        known = sent.value
        ids_of, valid, sizes, body = B.bodies(row)
        _, first, n, flat = block_words(right)
        own = np.array([_remainder(i if v else None) != 2 for i, v in zip(ids_of.tolist(), valid.tolist())], bool)
        flat = known.of[flat].astype(known.kind)
        stop, some, per = np.cumsum(sizes), [], np.zeros(len(sizes))
        for i in range(0, len(body), SLICE):
            w = body[i:i + SLICE]
            text = np.searchsorted(stop, np.arange(i, i + len(w)), "right")
            learn = own[text]
            w, text = w[learn], text[learn]
            some.append(flat[C.ragged(first[w], n[w])])
            per += np.bincount(text, n[w], len(per))
        per = per[own]
        return pd.DataFrame({"block": [row["block"]], "ids": [squeezed(np.concatenate([*some, np.zeros(0, known.kind)]))], "sizes": [squeezed(per.astype(np.int64))]})

    return C.staged(B.reassemble(parts, answers, pick, "block long, ids binary, sizes binary"), "lm")


def _texts(batches, kind: type):
    for b in batches:
        for x, y, at in zip(b.column("ids").to_pylist(), b.column("sizes").to_pylist(), b.column("block").to_pylist()):
            yield opened(x, kind), opened(y, np.int64), at


def count_pairs(rows: DataFrame, known: Numbers, end: int) -> Pairs:
    """Neighbours in all training texts."""
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def make(batches):
        pairs = Pairs(sent.value)
        for numbers, sizes, _ in _texts(batches, sent.value.kind):
            for last, then, _ in neighbours(numbers, sizes, end):
                pairs.add(last, then)
        return pairs.flat

    pairs = Pairs(known)
    got = summed(rows.select("ids", "sizes", "block"), make, np.int64)
    if len(got):
        pairs.flat = got
    return pairs


def train(rows: DataFrame, prior: Prior, end: int) -> Attention:
    """The model from all windows of all training texts, each text in one of ``ROUNDS``."""
    spark = rows.sparkSession
    fixed = spark.sparkContext.broadcast(prior)
    model = Attention(prior)
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model.flat())

        def make(batches, turn=turn, sent=sent):
            known = fixed.value.known
            mine, seen, state = Attention(fixed.value).load(sent.value), 0, {}
            for numbers, sizes, at in _texts(batches, known.kind):
                stop = np.cumsum(sizes)
                own = np.arange((turn + at) % ROUNDS, len(sizes), ROUNDS)
                for i, j in C.chunks(np.concatenate([[0], np.cumsum(sizes[own])]), SLICE):
                    some = own[i:j]
                    windows = Windows(np.concatenate([numbers[stop[k] - sizes[k]:stop[k]] for k in some]), sizes[some], end, known)
                    mine.train(windows, RATE / (1 + turn), turn, state)
                    seen += len(windows)
            return np.append(mine.flat().astype(np.float64) * seen, seen) if seen else None

        got = summed(rows.select("ids", "sizes", "block"), make, np.float64)
        if len(got):        # else few texts: none in this round
            model.load(got[:-1] / got[-1])
    return model.ready()


def _remainder(doc_id: int | None) -> int:
    import zlib
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def score(docs: DataFrame, path: str) -> DataFrame:
    """Per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_ids."""
    spark = docs.sparkSession
    ranks = bpe.load_ranks(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, answers = counted(docs, ranks, buckets)
    ends = docs.filter(C.remainder("doc_id", 7) != 2).count()
    sums = answers.agg(F.sum("total"), F.sum("known")).first()
    n, v = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)
    end_id = max(ranks.values()) + 1
    seen = id_counts(answers, end_id + 1)
    seen[end_id] = ends
    known = Numbers(seen)
    end = int(known.of[end_id])
    rows = training_texts(parts, answers, known)
    prior = Prior(count_pairs(rows, known, end))
    sent = spark.sparkContext.broadcast((train(rows, prior, end), prior))

    def work(row, right):
        model, prior = sent.value
        known = prior.known
        ids_of, valid, sizes, body = B.bodies(row)
        count, first, k, flat = block_words(right)
        base = np.log10((count + 1.0) / (n + v + 1.0))
        last = np.log10((ends + 1.0) / (n + v + 1.0))
        flat = known.of[flat].astype(known.kind)
        stop = np.cumsum(sizes)
        out = []
        for i, j in C.chunks(np.concatenate([[0], stop]), 1 << 15):
            lo = 0 if i == 0 else stop[i - 1]
            w = body[lo:stop[j - 1]]
            doc = np.repeat(np.arange(j - i), sizes[i:j])
            per_doc = lambda x: np.bincount(doc, x, j - i)  # noqa: B023, E731
            numbers = np.concatenate([flat[C.ragged(first[x], k[x])] for x in np.split(w, range(SLICE, len(w), SLICE))])
            ids = per_doc(k[w]).astype(np.int64)
            total = model.log_sums(Windows(numbers, ids, end, known))
            for before, then, text in neighbours(numbers, ids, end):
                total += np.bincount(text, prior.inside(before, then), j - i)
            out.append(pd.DataFrame({"doc_id": pd.array(ids_of[i:j], "Int64"), "n_tokens": sizes[i:j] + 1, "n_known": per_doc(count[w] > 0).astype(np.int64) + (ends > 0),
                                     "base_score": per_doc(base[w]) + last, "score": total / np.log(10), "n_ids": ids + 1}))
            out[-1].loc[~valid[i:j], "doc_id"] = pd.NA
        return pd.concat(out)

    got = B.reassemble(parts, answers, work, "doc_id long, n_tokens long, n_known long, base_score double, score double, n_ids long")
    return got.select("doc_id", (C.remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "n_ids")
