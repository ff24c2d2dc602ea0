import math
import zlib

import numpy as np

from martspark.llm import gam as G
from martspark.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.01"


def area(y, s):
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    ones = y == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r["doc_id"]: r for r in G.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    pairs = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    y, s = np.array([q for q, _ in pairs]), np.array([r["score"] for _, r in pairs])
    assert area(y, s) > 0.97 and np.mean([r["predicted"] == q for q, r in pairs]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    m = G.AdditiveModel().fit(x[:2000], y[:2000])
    assert (0, 2) in m.pairs and ((m.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_features_brute(spark):
    for t in ["", " \n", "One two two.\nOne two two.\n|| a # b\n", "É é 12!"]:
        data = np.frombuffer(t.encode(), np.uint8)
        x = dict(zip(G.FEATURES, G.features(data, np.array([0, len(data)]))[0]))
        w = t.split()
        lines = [p for p in t.split("\n") if p]
        assert np.isclose(x["words"], np.log1p(len(w))) and np.isclose(x["again"], sum(a == b for a, b in zip(w, w[1:])) / max(1, len(w)))
        assert np.isclose(x["distinct"], len(set(w)) / max(1, len(w))) and np.isclose(x["same_lines"], 1 - len(set(lines)) / max(1, len(lines)))


def test_odd_texts_and_labels(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (7, 0), (7, 0), (999, 1)], "doc_id long, quality int")
    assert G.classify(H.odd(spark), labels).count() == len(H.ODD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in G.classify(H.odd(spark), none).collect()} == {0.5}
    assert G.classify(H.empty(spark), labels).count() == 0


def test_score_and_first_trees_by_plain_loops():
    """Scores as sums of looked-up values; the first round's tables as trees found by trying all cuts."""
    rng = np.random.default_rng(4)
    x = np.round(rng.random((400, 3)), 2)
    y = (x[:, 0] + 0.3 * rng.random(400) > 0.6).astype(float)
    m = G.AdditiveModel(bins=9, grid=4, rounds=5, pair_rounds=3, pairs=2).fit(x, y)

    def looked_up(row):
        total = m.base
        for v, cuts, table in zip(row, m.cuts, m.tables):
            total += table[sum(v >= c for c in cuts)]
        for (i, j), table in zip(m.pairs, m.pair_tables):
            total += table[sum(row[i] >= c for c in m.coarse[i])][sum(row[j] >= c for c in m.coarse[j])]
        return 1 / (1 + math.exp(-total))
    assert np.allclose(m.score(x), [looked_up(r) for r in x])

    m = G.AdditiveModel(bins=9, rounds=1, pair_rounds=0, pairs=0, leaves=3).fit(x, y)
    score = [m.base] * len(y)
    for j, (cuts, table) in enumerate(zip(m.cuts, m.tables)):
        at = [sum(v >= c for c in cuts) for v in x[:, j]]
        p = [1 / (1 + math.exp(-s)) for s in score]
        g, h = [0.0] * len(table), [0.0] * len(table)
        for a, want, have in zip(at, y, p):
            g[a] += want - have
            h[a] += have * (1 - have)
        worth = lambda lo, hi: sum(g[lo:hi]) ** 2 / (sum(h[lo:hi]) + m.ridge)  # noqa: B023, E731
        leaves = [(0, len(table))]
        for _ in range(2):          # the best cut of any leaf, twice
            gain, leaf, cut = max((worth(lo, c) + worth(c, hi) - worth(lo, hi), (lo, hi), c) for lo, hi in leaves for c in range(lo + 1, hi))
            leaves = [x for x in leaves if x != leaf] + [(leaf[0], cut), (cut, leaf[1])]
        want = [0.0] * len(table)
        for lo, hi in leaves:
            for b in range(lo, hi):
                want[b] = m.rate * sum(g[lo:hi]) / (sum(h[lo:hi]) + m.ridge)
        assert np.allclose(table, want)
        score = [s + want[a] for s, a in zip(score, at)]
