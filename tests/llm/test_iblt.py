import hashlib
import re

import pytest
import xxhash

from martspark.llm import iblt as I
from martspark.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def pieces(t):
    return {p for part, n in ((t[:I.HEAD], I.SHORT), (t[I.HEAD:], I.PIECE)) for p in re.findall(r"[^\n]{1,%d}" % n, part)}


def like(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    signed = lambda t: (h := xxhash.xxh64(t.encode(), seed=42).intdigest()) - (h >> 63 << 64)
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, signed(r[1])))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(like(t, edited), 9), round(like(t, after), 9)))
    return sorted(out, key=str)


def check(df):
    got = I.fingerprints(df).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got), key=str) == brute(
        [tuple(r) for r in df.select("doc_id", "text").collect()])
    return got


def test_tables(spark):
    check(table(spark, SF, "documents"))


def test_odd_texts(spark):
    got = check(H.odd(spark))
    same = [r["fingerprint"] for r in got if r["doc_id"] in (1, 7)]
    assert len(same) == 3 and len(set(same)) == 1


def test_empty_and_single(spark):
    assert I.fingerprints(H.empty(spark)).count() == 0
    check(H.frame(spark, [(4, "one two three four five six seven eight")]))


@pytest.mark.parametrize("n", [0, 1, 5, 40, 700])
def test_all_differences_recovered(spark, n):
    """Digest sets that share 300 members and differ in n on either side."""
    df = spark.range(1).select(I.digests(_lines(0, 300 + n)).alias("a"), I.digests(_lines(0, 300, n)).alias("b"))
    df = df.withColumns({"pa": I.F.expr(I.placed("a", "0L")), "pb": I.F.expr(I.placed("b", "0L"))})
    df = df.withColumns({"sa": I.F.expr(I.sketch("pa")), "sb": I.F.expr(I.sketch("pb"))})
    df = df.select(I.F.lit(0).cast("long").alias("row"), I.F.expr(I.subtracted("sa", "sb")).alias("cells"), "a", "b")
    a, b = (set(x) for x in df.select("a", "b").first())
    assert I.differences(df).first()["n"] == len(a ^ b)


def _lines(lo, hi, other=0):
    return I.F.lit("\n".join([f"line {k} {'x' * 20}" for k in range(lo, hi)] + [f"other {k}" for k in range(other)]))
