"""End-to-end runs: CSV sources -> warehouse loads -> marts, checked against the oracle."""

import os

import pytest
from pyspark.sql import functions as F

from martspark import oracle as O
from martspark.plans import jobs as J
from martspark.operators.tables import data_files, is_bucketed
from martspark.plans import report_mart as RM
from martspark.session import scratch_path
from martspark.sources.files import write_csv
from martspark.sources.schemas import SCHEMAS, _s, I, S
from martspark.sources.standins import RetailTables
from martspark.streaming import month_reload_stream
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_store_report_run_matches_oracle(spark):
    t = RetailTables(spark, SF)
    root = scratch_path(spark, "tests/job")
    frames = {"promos": t.promos, "stores": t.stores, "traffic": t.traffic_source, "coupons": t.coupons,
              "bills_head": t.bills_head, "bills_item": t.bills_item,
              "promo_types": t.promos.select(F.col("promo_type").alias("type_id"),
                                             F.concat(F.lit("type "), F.col("promo_type")).alias("txt")).distinct()}
    sources = {}
    for name, df in frames.items():
        write_csv(df, f"{root}/src/{name}")
        sources[name] = J.Source("csv", f"{root}/src/{name}",
                                 schema="traffic_source" if name == "traffic" else name)
    cfg = J.RunConfig(warehouse=f"{root}/wh", sources=sources, database="store_report_test", buckets=8)
    J.store_report_run(spark, cfg, "1996-01-01", "1996-02-28", "1995-11-01",
                       ("19960101", "19960228", 2), ("19960101", "19960105", 4))
    wh = J.Warehouse(spark, cfg.warehouse)
    got = wh.report.select(*RM.REPORT_COLUMNS)
    windows = (RM.report_windows("19960101", "19960228", 2, ("month_interval", "monthly"))
               + RM.report_windows("19960101", "19960105", 4, ("day_interval", "daily")))
    ok, msg = compare(got, O.report_sql(windows), duck(SF))
    assert ok, msg
    exp = wh.report_export
    assert exp.count() == got.count()
    assert dict(exp.dtypes)["plant_id"] == "int"
    logs = [r["log_msg"] for r in wh.logs.collect()]
    assert "End store report run" in logs

    # a second run: months and items that are the same keep their files; items join without a shuffle
    files = {n: data_files(spark, f"{cfg.warehouse}/{n}") for n in ("traffic", "coupons", "bills_head", "bills")}
    some = t.bills_item.where("billnum % 500 = 1")
    write_csv(some, f"{root}/src/bills_item")
    before = set(data_files(spark, f"{cfg.warehouse}/bills_item"))
    J.store_report_run(spark, cfg, "1996-01-01", "1996-02-28", "1995-11-01",
                       ("19960101", "19960228", 2), ("19960101", "19960105", 4))
    assert {n: data_files(spark, f"{cfg.warehouse}/{n}") for n in files} == files
    after = set(data_files(spark, f"{cfg.warehouse}/bills_item"))
    touched = {r[0] for r in some.select(F.pmod(F.hash("billnum"), F.lit(8))).distinct().collect()}
    assert len(before - after) == len(touched) < 8 and is_bucketed(spark, f"{cfg.warehouse}/bills_item")
    assert sorted(map(str, wh.bills_item.collect())) == sorted(map(str, t.bills_item.select(*wh.bills_item.columns).collect()))
    ok, msg = compare(wh.report.select(*RM.REPORT_COLUMNS), O.report_sql(windows), duck(SF))
    assert ok, msg
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = spark.table("store_report_test.bills_item").join(wh.bills_head, "billnum")._jdf.queryExecution().executedPlan()
        sides = {}
        todo = [(plan, False)]
        while todo:
            p, shuffled = todo.pop()
            if p.nodeName().startswith("Scan"):
                sides["bills_item" in p.nodeName()] = shuffled
            todo += [(p.children().apply(i), shuffled or p.nodeName() == "Exchange") for i in range(p.children().size())]
        assert sides == {True: False, False: True}          # the heads come to the items
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_month_reload_stream(spark):
    root = scratch_path(spark, "tests/stream")
    schema = _s(("plant", S, True), ("date", S, True), ("quantity", I, True))
    a = spark.createDataFrame([("1", "05.01.2021", 1), ("2", "06.02.2021", 2)], "plant string, date string, quantity int")
    write_csv(a, f"{root}/in/batch1")
    q = month_reload_stream(spark, f"{root}/in/*", schema, f"{root}/traffic", "date", f"{root}/ckpt", convert=True)
    q.awaitTermination()
    rows = sorted((r["plant"], str(r["date"])) for r in spark.read.parquet(f"{root}/traffic").collect())
    assert rows == [("1", "2021-01-05"), ("2", "2021-02-06")]
    b = spark.createDataFrame([("9", "07.02.2021", 5)], "plant string, date string, quantity int")
    write_csv(b, f"{root}/in/batch2")             # one more extract of February
    q = month_reload_stream(spark, f"{root}/in/*", schema, f"{root}/traffic", "date", f"{root}/ckpt", convert=True)
    q.awaitTermination()
    rows = sorted((r["plant"], str(r["date"])) for r in spark.read.parquet(f"{root}/traffic").collect())
    assert rows == [("1", "2021-01-05"), ("2", "2021-02-06"), ("9", "2021-02-07")]      # no row of the month is lost


def test_plan_fact_run(spark):
    from martspark.plans import plan_fact as PF
    t = RetailTables(spark, SF)
    root = scratch_path(spark, "tests/pfjob")
    srcs = {"price": t.price, "chanel": t.chanel, "product": t.product, "region": t.region_dim,
            "plan": t.plan}
    sources = {}
    for name, df in srcs.items():
        write_csv(df, f"{root}/src/{name}")
        sources[name] = J.Source("csv", f"{root}/src/{name}")
    t.sales.write.parquet(f"{root}/src/sales")
    sources["sales"] = J.Source("parquet", f"{root}/src/sales")
    cfg = J.RunConfig(warehouse=f"{root}/wh", sources=sources, database="plan_fact_test")
    n = J.plan_fact_run(spark, cfg, "1996-01-02", "199601")
    wh = J.Warehouse(spark, cfg.warehouse)
    # the run loads sales only for [1996-01-02, 1996-02-02), as the source's example call does
    month_sales = t.sales.where((F.col("date") >= "1996-01-02") & (F.col("date") < "1996-02-02"))
    want = sorted(map(tuple, PF.plan_fact(month_sales, t.plan, "199601").collect()))
    got = sorted(map(tuple, wh.__getattr__("plan_fact_199601").collect()))
    assert n == len(want) and got == want
    view = spark.newSession().sql("SELECT * FROM plan_fact_test.v_plan_fact")       # no temporary view is seen there
    want_view = PF.plan_fact_view(PF.plan_fact(month_sales, t.plan, "199601"), t.product, t.price)
    assert view.columns == want_view.columns and sorted(map(str, view.collect())) == sorted(map(str, want_view.collect()))
    # a second run upserts the plan (same rows) and gives the same mart
    assert J.plan_fact_run(spark, cfg, "1996-01-02", "199601") == n
    m = J.sales_mart_run(spark, cfg, "199602")
    want_mart = sorted(map(tuple, PF.sales_mart(month_sales, "199602").collect()))
    assert m == len(want_mart) and sorted(map(tuple, wh.mart.collect())) == want_mart
    assert "End sales mart" in [r["log_msg"] for r in wh.logs.collect()]
