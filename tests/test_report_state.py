"""Reports from maintained state against reports from the facts, after re-loads of all kinds."""

import datetime as dt
import random

import pytest

from martspark.operators import loads as LD
from martspark.operators.tables import data_files, read_table
from martspark.plans import report_mart as RM
from martspark.plans import report_state as RS
from martspark.session import scratch_path

BILLS = "billnum long, material long, plant string, calday date, rpa_sat decimal(17,2), qty long"
COUPONS = "plant string, date date, coupon_num string, promo_id string, material long, billnum long"
PROMOS = "promo_id string, promo_name string, promo_type string, material long, discount_amount long"
TRAFFIC = "plant string, date date, quantity int"
ARGS = [("20210101", "20210401", 3, ("month_interval", "monthly")), ("20210105", "20210220", 20, ("daily", "day_interval")), ("20210115", "20210310", 9, ("daily", "day_interval"), False)]


class World:
    """Facts stored by month, with bills of several days and months and coupons of other months' bills."""

    def __init__(self, spark, seed=1):
        self.spark, self.r, self.root = spark, random.Random(seed), scratch_path(spark, "tests/state")
        self.stores = spark.createDataFrame([(str(p), f"store {p}") for p in range(4)], "plant string, txt string")
        self.promos = spark.createDataFrame([(f"p{m % 3}", "x", "001" if m % 2 else "002", m, m + 1) for m in range(6)], PROMOS)
        day = lambda: dt.date(2021, 1, 1) + dt.timedelta(days=self.r.randrange(100))
        self.bills = [(self.r.randrange(60), self.r.randrange(6), str(self.r.randrange(4)), day(), self.r.randrange(100, 9999) / 100, self.r.randrange(1, 9)) for _ in range(400)]
        self.coupons = [(str(self.r.randrange(4)), day(), str(i % 50), f"p{self.r.randrange(3)}", self.r.randrange(6), self.r.randrange(60)) for i in range(150)] * 2
        self.traffic = [(str(self.r.randrange(4)), day(), self.r.randrange(1, 9)) for _ in range(300)]
        for name in ("bills", "coupons", "traffic"):
            LD.load_full(self.frame(name), f"{self.root}/{name}", "pmonth", "calday" if name == "bills" else "date")

    def frame(self, name):
        from decimal import Decimal
        rows = [tuple(Decimal(str(x)) if isinstance(x, float) else x for x in r) for r in getattr(self, name)]
        return self.spark.createDataFrame(rows, {"bills": BILLS, "coupons": COUPONS, "traffic": TRAFFIC}[name])

    def stored(self, name):
        return read_table(self.spark, f"{self.root}/{name}")

    def reload(self, name, month):
        day = "calday" if name == "bills" else "date"
        LD.load_delta_partitions(self.spark, self.frame(name), f"{self.root}/{name}", day, month, month)

    def refresh(self, months):
        return RS.refresh(self.spark, f"{self.root}/state", self.stored("bills"), self.stored("coupons"), self.promos, self.stored("traffic"), months)

    def check(self):
        for args in ARGS:
            got = RS.report(self.spark, f"{self.root}/state", self.stores, *args)
            want = RM.build_report(self.stores, self.frame("bills"), self.frame("coupons"), self.promos, self.frame("traffic"), RM.report_windows(*args))
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.fixture()
def world(spark):
    return World(spark)


FEB = dt.date(2021, 2, 1)


def in_feb(d):
    return (d.year, d.month) == (2021, 2)


def test_state_follows_reloads(world):
    world.refresh([])
    world.check()
    # other sums, bills taken away and brought
    world.bills = [b for b in world.bills if not in_feb(b[3]) or b[0] % 3] + [(1000 + i, i % 6, "1", dt.date(2021, 2, 3), 5.5, 2) for i in range(9)]
    world.coupons += [("1", dt.date(2021, 3, 3), "77", "p1", 1, 1001), ("2", dt.date(2021, 2, 9), "78", "p0", 3, 1003)]
    world.traffic = [t for t in world.traffic if not in_feb(t[1])]
    for name in ("bills", "coupons", "traffic"):
        world.reload(name, "2021-02-01")
    world.reload("coupons", "2021-03-01")
    read = world.refresh([FEB])
    assert read["bill_days"] == read["traffic_days"] == [FEB] and dt.date(2021, 3, 1) in read["coupon_lines"]
    world.check()


def test_other_promos_rebuild_all_coupons_and_no_bills(spark, world):
    world.refresh([])
    before = data_files(spark, f"{world.root}/state/bill_days")
    world.promos = world.promos.selectExpr("promo_id", "promo_name", "promo_type", "material", "discount_amount + 1 AS discount_amount")
    assert len(world.refresh([])["coupon_lines"]) == 4
    assert data_files(spark, f"{world.root}/state/bill_days") == before
    world.check()


def test_a_reload_of_nothing_new_leaves_the_state(spark, world):
    world.refresh([])
    before = data_files(spark, f"{world.root}/state")
    world.reload("bills", "2021-02-01")
    world.refresh([FEB])
    assert [f for f in data_files(spark, f"{world.root}/state") if "promos_digest" not in f] == [f for f in before if "promos_digest" not in f]


def test_only_the_reloaded_month_of_bills_is_read(spark, world, monkeypatch):
    world.refresh([])
    seen = []
    real = RM.bill_days
    monkeypatch.setattr(RM, "bill_days", lambda df: seen.append(df) or real(df))
    world.refresh([FEB])
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "2021-02-01" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_coupon_branch_reads_bills_in_ranges(spark, world):
    one = RM.coupon_lines(world.stored("coupons").where("billnum IN (3, 4, 50)"), world.promos, world.stored("bills"), ranges=4)
    assert "BETWEEN" in one._jdf.queryExecution().analyzed().toString() or "billnum" in one._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[2]
    want = RM.coupon_lines(world.stored("coupons").where("billnum IN (3, 4, 50)"), world.promos, world.stored("bills"))
    assert sorted(map(str, one.collect())) == sorted(map(str, want.collect()))
