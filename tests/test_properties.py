"""Property checks against brute force on small random inputs."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martspark.functions import exact_div
from martspark.operators.merge import rank_merge, upsert
from martspark.plans import report_mart as rm


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**7), st.integers(0, 2)),
                min_size=1, max_size=200))
def test_exact_div_matches_decimal(spark, cases):
    df = spark.createDataFrame([(n, d, s) for n, d, s in cases], "n long, d long, s int")
    got = df.select(*[exact_div(F.col("n").cast("decimal(20,2)") / 100, "d", s).alias(f"q{s}")
                      for s in range(3)]).collect()
    with localcontext() as ctx:
        ctx.prec = 60
        for (n, d, _), row in zip(cases, got):
            exact = Decimal(n) / (Decimal(100) * Decimal(d))
            for s in range(3):
                want = exact.quantize(Decimal(1).scaleb(-s), rounding=ROUND_HALF_UP)
                assert row[f"q{s}"] == want, (n, d, s)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.integers(0, 3)), max_size=12),
       st.lists(st.tuples(st.sampled_from([None, 2, 3, 4]), st.integers(10, 13)), max_size=12))
def test_upsert_equals_rank_merge_and_brute_force(spark, target, source):
    t = spark.createDataFrame(target, "k int, v int")
    s = spark.createDataFrame(source, "k int, v int")
    src_keys = {k for k, _ in source}
    want = sorted([r for r in target if r[0] not in src_keys] + list(source), key=repr)
    assert sorted(map(tuple, upsert(t, s, ["k"]).collect()), key=repr) == want
    assert sorted(map(tuple, rank_merge(t, s, ["k"]).collect()), key=repr) == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(1, 6), st.integers(0, 8), st.integers(1, 50)),
                min_size=1, max_size=25))
def test_report_bill_counts_match_brute_force(spark, rows):
    # rows: plant, billnum, day offset, cents
    D = dt.date(2021, 1, 1)
    bills = spark.createDataFrame(
        [(b, 1, 1, p, D + dt.timedelta(days=o), Decimal(c) / 100, 1) for p, b, o, c in rows],
        "billnum long, billitem long, material long, plant string, calday date, rpa_sat decimal(17,2), qty long")
    stores = spark.createDataFrame([("A", "a"), ("B", "b")], "plant string, txt string")
    empty_c = spark.createDataFrame([], "plant string, date date, coupon_num string, promo_id string, material long, billnum long")
    empty_p = spark.createDataFrame([], "promo_id string, promo_name string, promo_type string, material long, discount_amount long")
    empty_t = spark.createDataFrame([], "plant string, date date, time string, frame_id string, quantity int")
    for cumulative in (True, False):
        ws = rm.report_windows("20210101", "20210106", 1, ["daily"], cumulative)
        got = {(r["report_name"], r["plant"]): (r["bills_qty"], r["material_qty"])
               for r in rm.build_report(stores, bills, empty_c, empty_p, empty_t, ws).collect()}
        for w in ws:
            for plant in ("A", "B"):
                sel = [(b, o) for p, b, o, c in rows if p == plant and w.start <= D + dt.timedelta(days=o) < w.end]
                assert got[(w.report_name, plant)] == (len({b for b, _ in sel}), len(sel))
