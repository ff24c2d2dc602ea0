import random

import numpy as np
import pytest
import xxhash

from martspark.llm import simhash as S
from martspark.llm.common import table
from martspark.llm.components import components
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [words[i:i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hs = [xxhash.xxh64(b" ".join(g), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, bits=3):
    """fp -> representative, by comparing all."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    arr = np.array(fps, np.uint64)
    for f in fps:
        for g in arr[np.bitwise_count(arr ^ np.uint64(f)) <= bits].tolist():
            a, b = find(f), find(g)
            root[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def check(df):
    rows = [(r["doc_id"], brute_print(r["text"])) for r in df.select("doc_id", "text").collect()]
    group = brute_groups([f for _, f in rows])
    least = {}
    for i, f in rows:
        if i is not None:
            least[group[f]] = min(i, least.get(group[f], i))
    want = sorted(((i, f"{f:016x}", least.get(group[f])) for i, f in rows), key=str)
    assert sorted((tuple(r) for r in S.near_duplicates(df).collect()), key=str) == want


def test_tables(spark):
    check(table(spark, SF, "documents"))


def test_odd_texts(spark):
    check(H.odd(spark))


def test_empty(spark):
    assert S.near_duplicates(H.empty(spark)).count() == 0
    assert S.survivors(H.empty(spark)).count() == 0


@pytest.mark.parametrize("leaf", [4, 50, 4096])
def test_links_against_all_pairs(spark, leaf):
    """Dense groups and chains; small leaves force hot buckets to be divided again and again."""
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for f in [0, (1 << 64) - 1, fps[0]]:
        fps += [f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)]
    for f in fps[1:60]:
        for _ in range(3):
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64)) | (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.append(f)
    want = brute_groups(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), k) for k, f in enumerate(fps)], "fp long, doc_id long")
    got = {r["fp"] % (1 << 64): r["root"] for r in S.grouped(df, 3, leaf).collect()}
    assert set(got) == set(want)
    one = {}
    for f in want:
        assert one.setdefault(want[f], got[f]) == got[f]
    assert len(set(one.values())) == len(one)


def test_components_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60) if k % 20 != 19] + [(100, 100)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {k: k // 20 * 20 for k in range(60)}


def test_survivors(spark):
    text = "a b c d e f g h i j k l m n o p"
    df = H.frame(spark, [(5, text), (3, text), (3, text), (None, text), (9, "something else entirely here now")])
    out = S.survivors(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [3, 9]
