import hashlib
import random

import pytest

from martspark.llm import repeats as R
from martspark.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def brute(rows):
    """All 100-byte strings in order of (doc_id, start); rows of one doc_id and text are one."""
    import xxhash
    key = lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64(r[1], seed=42).intdigest())
    rows = [(i, (t or "").encode()) for i, t in rows]
    seen, done = set(), {}
    for r in sorted(rows, key=key):
        if key(r) in done:
            continue
        text = r[1]
        hit = bytearray(len(text))
        for s in range(len(text) - 99):
            w = text[s:s + 100]
            if w in seen:
                hit[s:s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, h in zip(text, hit) if not h)
        spans = sum(1 for k in range(len(hit)) if hit[k] and (k == 0 or not hit[k - 1]))
        done[key(r)] = (r[0], len(text), sum(hit), spans, hashlib.sha256(kept).hexdigest())
    return sorted((done[key(r)] for r in rows), key=str)


def check(df, **how):
    want = brute([tuple(r) for r in df.select("doc_id", "text").collect()])
    got = sorted((tuple(r) for r in R.remove_repeats(df, **how).collect()), key=str)
    assert got == want


@pytest.mark.parametrize("leaf", [R.LEAF, 1])
def test_tables(spark, leaf):
    check(table(spark, SF, "documents"), leaf=leaf)


def test_odd_texts(spark):
    check(H.odd(spark))


def pieces(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 300))) for _ in range(12)]
    rows = []
    for k in range(120):
        t = ""
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(pool)
            a = rng.randint(0, len(p))
            t += rng.choice([p, p[a:], p[:a], "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 150))), "ab" * rng.randint(0, 120)])
        rows.append((rng.choice([k, k, k // 2]), t))
    return rows + rows[:3]


@pytest.mark.parametrize("leaf", [R.LEAF, 3])
def test_overlapping_passages(spark, leaf):
    for seed in (1, 2):
        check(H.frame(spark, pieces(seed)), leaf=leaf)


def test_long_text_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 500)
    monkeypatch.setattr(R, "_powers", {})
    rows = pieces(4)
    data = [R.np.frombuffer(t.encode(), R.np.uint8) for _, t in rows]
    offs = R.np.concatenate([[0], R.np.cumsum([len(d) for d in data])])
    a, c, text, lo, n = R.anchors(R.np.concatenate(data), offs)
    starts = {(int(x), int(y) + k) for x, y, z in zip(text, lo, n) for k in range(int(z) - 99)}
    assert starts == {(i, s) for i, d in enumerate(data) for s in range(len(d) - 99)}
    where = {}
    for h, x, y, z in zip(a.tolist(), text.tolist(), lo.tolist(), n.tolist()):
        for k in range(z - 99):
            assert where.setdefault(bytes(data[x][y + k:y + k + 100]), h) == h


def test_empty(spark):
    assert R.remove_repeats(H.empty(spark)).count() == 0


def test_real_outputs(spark):
    p = "".join(random.Random(9).choices("abcdefghij", k=150))
    got = {r["doc_id"]: r for r in R.remove_repeats(H.frame(spark, [(1, "A" + p), (2, "B" + p + "C")]), keep=True).collect()}
    assert bytes(got[2]["kept"]) == b"BC" and got[2]["spans"] == [[1, 151]] and got[1]["n_removed"] == 0


@pytest.mark.parametrize("leaf", [R.LEAF, 1])
def test_texts_of_one_id_that_share_half_a_hash(spark, leaf):
    import xxhash
    p, seen = "".join(random.Random(11).choices("abcdefghij", k=150)), {}
    for k in range(1_000_000):
        other = seen.setdefault(xxhash.xxh64(f"{p}{k}", seed=42).intdigest() & 0xFFFFFFFF, k)
        if other != k:
            break
    got = R.remove_repeats(H.frame(spark, [(None, f"{p}{other}"), (None, f"{p}{k}"), (1, "x" + p[:120])]), leaf=leaf).collect()
    removed = sorted(r["n_removed"] for r in got)
    assert removed[0] == 0 and removed[1] == 120 and removed[2] >= 150


def test_equal_rows_are_fetched_once(spark):
    """20 000 rows of one doc_id and text bring their contexts once, in whatever task they are."""
    rng = random.Random(13)
    p = "".join(rng.choices("abcdefghij", k=150))
    rows = [(1, "A" + p + "B")] * 20_000 + [(2, "C" + p + "D")]
    df = H.frame(spark, rows).repartition(7)
    texts, buckets = R.keyed(df), 8
    packed, _ = R._taken_apart(R.C.staged(R.context_packets(texts, buckets), "repeats"))
    wanted = R.C.staged(R.compared(packed, buckets, R.LEAF), "repeats").filter("a is not null")
    n = sum(len(R.unpack(r["lo"])) for r in wanted.select("lo").collect())
    assert R.fetched(texts, wanted).count() <= 8 * n
    got = R.remove_repeats(df).groupBy("doc_id", "n_removed").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 20_000), (2, 150, 1)]


def test_places_that_several_tasks_bring_are_one():
    import pyarrow as pa
    t = pa.table({"a": [1, 1, 1, 2, 2], "doc": [None, None, 0, 0, 0], "tie": [5, 5, 5, 5, 5], "lo": [0, 0, 0, 0, 3]})
    kept, last = R.unlike_last(t, None)
    assert kept.to_pydict() == {"a": [1, 1, 2, 2], "doc": [None, 0, 0, 0], "tie": [5] * 4, "lo": [0, 0, 0, 3]}
    again, _ = R.unlike_last(t.slice(4), last)
    assert not len(again)
