import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martspark.plans import report_mart as rm

D = dt.date


def names(ws):
    return [w.report_name for w in ws]


def test_windows_month_modes():
    ws = rm.report_windows("20210101", "20210228", 2, ["month_interval", "monthly"])
    assert names(ws) == ["report_202101_202103", "report_202101", "report_202102"]
    assert all(w.start == D(2021, 1, 1) for w in ws)          # period-to-date
    assert [w.end for w in ws] == [D(2021, 3, 1), D(2021, 2, 1), D(2021, 3, 1)]


def test_windows_day_modes():
    ws = rm.report_windows("20210101", "20210105", 4, ["day_interval", "daily"])
    assert names(ws) == ["report_20210101_20210105", "report_20210101", "report_20210102",
                         "report_20210103", "report_20210104"]
    assert ws[-1].end == D(2021, 1, 5)


def test_windows_not_cumulative():
    ws = rm.report_windows("20210101", "20210103", 1, ["daily"], cumulative=False)
    assert [(w.start, w.end) for w in ws] == [(D(2021, 1, 1), D(2021, 1, 2)), (D(2021, 1, 2), D(2021, 1, 3))]


@pytest.mark.parametrize("args", [
    ("20210101", "20210105", 4, []),
    ("20210101", "20210105", 4, ["weekly"]),
    ("2021-01-01", "20210105", 4, ["daily"]),
    ("20210132", "20210105", 4, ["daily"])])
def test_window_input_errors_are_logged(args):
    logged = []
    with pytest.raises(rm.ReportInputError):
        rm.report_windows(*args, log=lambda t, m: logged.append((t, m)))
    assert logged and logged[0][0] == "ERROR"


def _frames(spark):
    stores = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c"), ("D", "d")], "plant string, txt string")
    bills = spark.createDataFrame([
        # billnum, billitem, material, plant, calday, rpa_sat, qty
        (1, 1, 10, "A", D(2021, 1, 1), Decimal("100.00"), 2),
        (1, 2, 11, "A", D(2021, 1, 1), Decimal("50.25"), 1),
        (2, 1, 10, "A", D(2021, 1, 2), Decimal("10.00"), 4),
        (2, 2, 10, "A", D(2021, 1, 3), Decimal("5.00"), 1),      # a bill seen on two days
        (3, 1, 12, "B", D(2021, 1, 2), Decimal("7.00"), 7),      # B: bills, no coupons
        (4, 1, 12, "D", D(2021, 1, 2), Decimal("9.99"), 1),      # D: bills, no traffic
    ], "billnum long, billitem long, material long, plant string, calday date, rpa_sat decimal(17,2), qty long")
    coupons = spark.createDataFrame([
        ("A", D(2021, 1, 1), "c1", "P1", 10, 1),
        ("A", D(2021, 1, 1), "c1", "P1", 10, 1),                  # duplicate coupon row
        ("A", D(2021, 1, 2), "c2", "P2", 11, 1),
    ], "plant string, date date, coupon_num string, promo_id string, material long, billnum long")
    promos = spark.createDataFrame([("P1", "p1", "001", 10, 5), ("P2", "p2", "002", 11, 10)],
                                   "promo_id string, promo_name string, promo_type string, material long, discount_amount long")
    traffic = spark.createDataFrame([
        ("A", D(2021, 1, 1), "000000", "f", 10), ("A", D(2021, 1, 2), "000000", "f", 5),
        ("B", D(2021, 1, 2), "000000", "f", 3), ("C", D(2021, 1, 1), "000000", "f", 9),  # C: traffic, no bills
    ], "plant string, date date, time string, frame_id string, quantity int")
    return stores, bills, coupons, promos, traffic


def test_report_edge_cases(spark):
    ws = rm.report_windows("20210101", "20210103", 1, ["daily"])        # [1,2) and [1,3)
    rows = {(r["report_name"], r["plant"]): r for r in rm.build_report(*_frames(spark), ws).collect()}
    assert len(rows) == 8
    a2 = rows[("report_20210102", "A")]
    assert a2["bills_qty"] == 2 and a2["material_qty"] == 7 and a2["turnover"] == 160
    assert a2["coupon_discount"] == Decimal("10.03")      # 5 + 50.25*10/100 = 10.025 (tie rounds up), duplicate once
    assert a2["turnover_with_discount"] == Decimal("150.23")
    assert a2["matdisc_qty"] == 2 and a2["traffic"] == 15
    assert a2["conversion_rate"] == Decimal("13.33") and a2["avg_bill"] == Decimal("80.1")
    a1 = rows[("report_20210101", "A")]
    assert a1["bills_qty"] == 1 and a1["turnover"] == 150 and a1["traffic"] == 10
    b2 = rows[("report_20210102", "B")]
    assert b2["coupon_discount"] == 0 and b2["turnover_with_discount"] == 0   # no coupons -> 0
    assert b2["turnover"] == 7 and b2["traffic"] == 3
    c2 = rows[("report_20210102", "C")]
    assert c2["turnover"] == 0 and c2["traffic"] == 0 and c2["conversion_rate"] == 0   # no bills -> no traffic
    d2 = rows[("report_20210102", "D")]
    assert d2["traffic"] == 0 and d2["avg_profit"] == 0 and d2["bills_qty"] == 1


def test_shared_start_matches_separate_runs(spark):
    frames = _frames(spark)
    ws = rm.report_windows("20210101", "20210104", 1, ["daily", "day_interval"])
    together = sorted(tuple(r) for r in rm.build_report(*frames, ws).collect())
    apart = sorted(tuple(r) for w in ws for r in rm.build_report(*frames, [w]).collect())
    assert together == apart


def test_general_path_matches(spark):
    frames = _frames(spark)
    ws = rm.report_windows("20210101", "20210104", 1, ["daily"], cumulative=False)
    got = sorted(tuple(r) for r in rm.build_report(*frames, ws).collect())
    apart = sorted(tuple(r) for w in ws for r in rm.build_report(*frames, [w]).collect())
    assert got == apart
    assert {r[0]: r[7] for r in got if r[1] == "A"}["report_20210102"] == 1   # bill 2 on day 2 only


@pytest.mark.parametrize("modes,end", [(["daily"], "20210107"), (["daily", "day_interval", "monthly"], "20210106")])
def test_running_totals_equal_single_windows(spark, modes, end):
    frames = _frames(spark)
    ws = rm.report_windows("20210101", end, 2, modes)
    a = sorted(tuple(r) for r in rm.build_report(*frames, ws).collect())
    b = sorted(tuple(r) for w in ws for r in rm.build_report(*frames, [w]).collect())
    assert a == b


def test_running_totals_equal_windows_met_by_day(spark):
    import os
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    from martspark.sources.standins import RetailTables
    t = RetailTables(spark, sf)
    ws = rm.report_windows("19960101", "19960120", 2, ["daily", "day_interval"])
    args = (t.stores, t.bills, t.coupons, t.promos, t.traffic, ws)
    a = sorted(tuple(r) for r in rm.build_report(*args).collect())
    # a window with another start sends all windows the other way
    other = rm.ReportWindow("report_other", ws[0].start - dt.timedelta(days=1), ws[0].end)
    b = sorted(tuple(r) for r in rm.build_report(*args[:-1], [*ws, other]).collect() if r[0] != "report_other")
    assert a == b and len(a) == 25 * len(ws)


def test_no_windows_gives_empty_report(spark):
    ws = rm.report_windows("20210105", "20210105", 1, ["daily"])
    assert ws == []
    df = rm.build_report(*_frames(spark), ws)
    assert df.count() == 0 and df.columns == list(rm.REPORT_COLUMNS)


def test_plan_fact_null_material_can_lead(spark):
    """The best-seller search runs over every (region, material) group, NULL material
    included, while the plan/fact sums only use rows with a material (as the source)."""
    from martspark.plans import plan_fact as PF
    sales = spark.createDataFrame([
        (D(2021, 1, 5), "R", None, 1, 50, "c1", "c1-1"),
        (D(2021, 1, 5), "R", "m1", 1, 10, "c2", "c2-1"),
        (D(2021, 1, 6), "R", "m2", 1, 10, "c3", "c3-1")],
        "date date, region string, material string, distr_chan int, quantity int, check_nm string, check_pos string")
    plan = spark.createDataFrame([(D(2021, 1, 5), "R", "dir", 30, 1), (D(2021, 1, 6), "R", "dir", 8, 1)],
                                 "date date, region string, matdirec string, quantity int, distr_chan int")
    rows = PF.plan_fact(sales, plan, "202101").collect()
    got = [(r["planned_quantity"], r["real_quantity"], r["complete_percent"], r["mosteff_material"]) for r in rows]
    assert got == [(38, 20, 52, None)]


def test_export_narrow_overflow_fails_wide_keeps(spark):
    from martspark.operators.export import EXPORT_SCHEMA_WIDE, export_frame
    rep = rm.build_report(*_frames(spark), rm.report_windows("20210101", "20210103", 1, ["daily"]))
    big = rep.withColumn("turnover", F.lit(5_000_000_000).cast("bigint"))
    with pytest.raises(Exception):
        export_frame(big).collect()                  # Int32 in the declared export table
    wide = export_frame(big, EXPORT_SCHEMA_WIDE).collect()
    assert {r["turnover"] for r in wide} == {5_000_000_000}
    assert sorted(r["plant_id"] for r in wide if r["report_name"] == "report_20210101") == [1, 2, 3, 4]


def test_plan_fact_wide_quantities(spark):
    from martspark.plans import plan_fact as PF
    sales = spark.createDataFrame([(D(2021, 1, 5), "R", "m1", 1, 2_000_000_000, "c1", "c1-1"),
                                   (D(2021, 1, 5), "R", "m1", 1, 2_000_000_000, "c2", "c2-1")],
                                  "date date, region string, material string, distr_chan int, quantity int, "
                                  "check_nm string, check_pos string")
    plan = spark.createDataFrame([(D(2021, 1, 5), "R", "dir", 2_000_000_000, 1)],
                                 "date date, region string, matdirec string, quantity int, distr_chan int")
    with pytest.raises(Exception):
        PF.plan_fact(sales, plan, "202101").collect()
    r = PF.plan_fact(sales, plan, "202101", wide=True).first()
    assert (r["planned_quantity"], r["real_quantity"], r["complete_percent"]) == (4_000_000_000, 4_000_000_000, 100)
