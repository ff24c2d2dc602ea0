import math
import re

import pytest

from martspark.llm import mixing as M
from martspark.llm.common import table
from martspark.llm.queries import ORACLES, op6_mix
from tests.compare import compare, duck
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def shared(sizes, weights=(3, 1, 2), share=1.5, ceiling=2):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, list(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > ceiling * sizes[s]]
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = float(ceiling * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


def check(df):
    rows = df.select("doc_id", "text", "source").collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    target = shared(sizes)
    got = M.sample(df, carry=["source"]).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r["doc_id"]), size(r["text"])) for r in rows)
    taken, largest = {}, {}
    for r in got:
        s = r["carry"]["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s], rel=1e-9, abs=1e-6)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        assert r["copies"] in (math.floor(r["target"] / max(sizes[s], 1)), math.ceil(r["target"] / max(sizes[s], 1)))
        taken[s] = taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * largest[s] + 1, s
    again = M.sample(df, carry=["source"]).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_tables(spark):
    check(table(spark, SF, "documents"))


def test_odd_and_null_sources(spark):
    rows = [(k, "w " * (k % 17), "en", [None, "a", "b", "ä", "src0"][min(k % 9, 4)]) for k in range(400)] + [(7, "w " * 7, "en", "a")] * 50
    check(H.frame(spark, rows + [(None, None, None, None), (None, "x y", "en", "z")]))


def test_empty_and_wordless(spark):
    assert M.sample(H.empty(spark)).count() == 0
    assert [r["taken"] for r in M.sample(H.frame(spark, [(1, ""), (2, None)])).collect()] == [0, 0]


def test_mix_repeats_whole_rows(spark):
    df = H.frame(spark, [(k, "w " * 5, "en", "ab"[k % 2]) for k in range(40)])
    out = M.mix(df)
    assert out.columns == df.columns
    want = {r["doc_id"]: r["copies"] for r in M.sample(df).collect() if r["copies"]}
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == want


def test_oracle(spark):
    ok, why = compare(op6_mix(spark, SF), ORACLES["op6_mix"], duck(SF))
    assert ok, why


def test_texts_of_one_id_and_size_take_the_same_copies_in_any_order(spark):
    rows = [(1, f"{w} two three", "en", f"s{k}") for w in ("a", "b", "c") for k in (0, 1)] + [(i, "x y z", "en", "s1") for i in range(2, 9)]
    taken = [sorted((r["doc_id"], r["th"], r["copies"]) for r in M.sample(H.frame(spark, order).repartition(n)).collect()) for order, n in ((rows, 1), (rows[::-1], 3), (rows[3:] + rows[:3], 5))]
    assert taken[0] == taken[1] == taken[2]
