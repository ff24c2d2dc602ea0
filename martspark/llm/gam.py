"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting visits the features in turn; each step fits a shallow tree to the gradient histogram of
one feature's bins and adds it to the feature's lookup table. Then the pairs with the largest gain
are boosted the same way over their grids. A text is scored by adding table entries by bin.

The model learns from at most ``SAMPLE`` labelled rows (by hash of doc_id); every text is scored.
Labels, lang, source and doc_id are no features.

Null text: empty, scored like any other. Null doc_id: kept, never labelled. Repeated rows: a result
each. Null labels are left out; without labels of both kinds the score is the share of ones, 0.5
without any. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 20_000            # most labelled rows that are learned from
THRESHOLD = 0.3
FEATURES = ("words", "word_bytes", "upper", "symbols", "bars", "marks", "digits", "stops", "again", "distinct", "same_lines", "line_words")

_UPPER, _ALPHA = C.table_of(bytes(range(65, 91))), C.table_of(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_SYMBOL, _BAR, _MARK, _DIGIT, _STOP = (C.table_of(x) for x in (b"#$%&*<>@^~=", b"|", b"!?", b"0123456789", b".,;:"))


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of features for each UTF-8 text."""
    n = len(offs) - 1
    s, e, first = C.spans(~C.IS_SPACE[data], offs)
    words = np.diff(first).astype(float)
    per = np.maximum(words, 1)
    per_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offs]).astype(float)
    doc = np.repeat(np.arange(n), np.diff(first))
    h, g = C.span_hashes(data, s, e)
    again = np.zeros(len(s), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    rep, _ = C.distinct(h + C.mix(doc.astype(np.uint64)), g)
    ls, le, lfirst = C.spans(data != 10, offs)
    ldoc = np.repeat(np.arange(n), np.diff(lfirst))
    lh, lg = C.span_hashes(data, ls, le)
    lrep, _ = C.distinct(lh + C.mix(ldoc.astype(np.uint64)), lg)
    lines = np.maximum(np.diff(lfirst), 1)
    return np.stack([
        np.log1p(words), per_text(~C.IS_SPACE[data]) / per, per_text(_UPPER[data]) / np.maximum(per_text(_ALPHA[data]), 1), per_text(_SYMBOL[data]) / per,
        per_text(_BAR[data]) / per, per_text(_MARK[data]) / per, per_text(_DIGIT[data]) / per, per_text(_STOP[data]) / per, np.bincount(doc[again], minlength=n) / per,
        np.bincount(doc[rep], minlength=n) / per, 1 - np.bincount(ldoc[lrep], minlength=n) / lines, np.log1p(words / lines)], axis=1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AdditiveModel:
    """Cyclic boosting of lookup tables, first of features, then of pairs of features."""

    def __init__(self, bins: int = 48, grid: int = 8, rounds: int = 150, pair_rounds: int = 60, pairs: int = 6, rate: float = 0.1, leaves: int = 4, ridge: float = 2.0):
        self.bins, self.grid, self.rounds, self.pair_rounds, self.n_pairs, self.rate, self.leaves, self.ridge = bins, grid, rounds, pair_rounds, pairs, rate, leaves, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        k = x.shape[1]
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(k)]
        self.coarse = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.grid + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(k)]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs, self.pair_tables = [], []
        share = y.mean() if len(y) else 0.5
        self.base = float(np.log(share / (1 - share))) if 0 < share < 1 else {0: -30.0, 1: 30.0}.get(share, 0.0)
        if not 0 < share < 1:
            return self
        at = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)]
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for j in range(k):
                step = self._tree(*self._sums(at[j], len(self.tables[j]), score, y)) * self.rate
                self.tables[j] += step
                score += step[at[j]]
        wide = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.coarse)]
        shape = lambda i, j: (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
        cell = lambda i, j: wide[i] * shape(i, j)[1] + wide[j]
        gains = []
        for i in range(k):
            for j in range(i + 1, k):
                m = shape(i, j)
                g, h = self._sums(cell(i, j), m[0] * m[1], score, y)
                gains.append((-self._quarters(g.reshape(m), h.reshape(m))[0], i, j))
        self.pairs = [(i, j) for _, i, j in sorted(gains)[:self.n_pairs]]
        self.pair_tables = [np.zeros(shape(i, j)) for i, j in self.pairs]
        for _ in range(self.pair_rounds):
            for (i, j), table in zip(self.pairs, self.pair_tables):
                c = cell(i, j)
                g, h = self._sums(c, table.size, score, y)
                step = self._quarters(g.reshape(table.shape), h.reshape(table.shape))[1] * self.rate
                table += step
                score += step.ravel()[c]
        return self

    def _sums(self, at, n, score, y):
        p = sigmoid(score)
        return np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n)

    def _tree(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Leaf values by bin of a tree of ``leaves`` leaves, the best cut first."""
        worth = lambda a, b: a * a / (b + self.ridge)
        sg, sh = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

        def best(lo, hi):
            mid = np.arange(lo + 1, hi)
            if not len(mid):
                return 0.0, -1
            gain = worth(sg[mid] - sg[lo], sh[mid] - sh[lo]) + worth(sg[hi] - sg[mid], sh[hi] - sh[mid]) - worth(sg[hi] - sg[lo], sh[hi] - sh[lo])
            return float(gain.max()), int(mid[gain.argmax()])

        parts = [(0, len(g))]
        while len(parts) < self.leaves:
            (gain, cut), part = max((best(*p), p) for p in parts)
            if gain <= 1e-9:
                break
            parts.remove(part)
            parts += [(part[0], cut), (cut, part[1])]
        out = np.zeros(len(g))
        for lo, hi in parts:
            out[lo:hi] = (sg[hi] - sg[lo]) / (sh[hi] - sh[lo] + self.ridge)
        return out

    def _quarters(self, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """Gain and values of the best tree with a cut along either axis."""
        cum = lambda a: np.pad(a, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
        sg, sh = cum(g), cum(h)
        best, values = 0.0, np.zeros(g.shape)
        for i in range(1, g.shape[0]):
            for j in range(1, g.shape[1]):
                gain, out = -sg[-1, -1] ** 2 / (sh[-1, -1] + self.ridge), []
                for a, b in (((0, i), (0, j)), ((0, i), (j, g.shape[1])), ((i, g.shape[0]), (0, j)), ((i, g.shape[0]), (j, g.shape[1]))):
                    box = lambda s: s[a[1], b[1]] - s[a[0], b[1]] - s[a[1], b[0]] + s[a[0], b[0]]  # noqa: B023, E731
                    v = box(sg) / (box(sh) + self.ridge)
                    gain += box(sg) * v
                    out.append((a, b, v))
                if gain > best:
                    best, values = gain, np.zeros(g.shape)
                    for a, b, v in out:
                        values[a[0]:a[1], b[0]:b[1]] = v
        return best, values

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return sigmoid(total)


def feature_table(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, features) of every text."""
    def run(batches):
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            x = [features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in C.chunks(offs)]
            x = np.concatenate(x) if x else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x[:, k]) for k in range(x.shape[1]))], names=["doc_id", *FEATURES])

    return C.staged(C.byte_texts(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"`{f}` double" for f in FEATURES)), "gam")


def learn(table: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """The model of (doc_id, quality) rows outside of the held-out fifth, by hash of doc_id."""
    known = labels.filter("quality is not null and doc_id is not null").filter(C.remainder("doc_id", 5) != 0).select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("quality"))
    known = known.orderBy(F.xxhash64("l_id"), "l_id", "quality").limit(sample)
    rows = table.join(known, table["doc_id"] == known["l_id"]).select("quality", *FEATURES).orderBy(*FEATURES, "quality").limit(sample).toPandas()
    return AdditiveModel().fit(rows[list(FEATURES)].to_numpy(float), rows["quality"].to_numpy(float))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per text: doc_id, held_out, score, predicted."""
    table = feature_table(docs)
    sent = docs.sparkSession.sparkContext.broadcast(learn(table, labels, sample))

    def run(batches):
        for b in batches:
            x = np.stack([np.asarray(b.column(f)) for f in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sent.value.score(x))], names=["doc_id", "score"])

    return table.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (C.remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
