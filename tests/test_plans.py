"""Plan-shape checks: pushdown, pruning, semi joins, no fact windows, no cross joins."""

import os

import re

import pytest
from pyspark.sql import functions as F

from martspark.plans import exercises as X
from martspark.plans import registry
from martspark.sources.standins import RetailTables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def only_running_totals(plan):
    """Windows run over the report's totals, a row per plant and window end, and nothing else."""
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    return all(re.match(r"plant#\d+, _k#\d+ ASC", s) for s in specs) and ("Window [" not in plan or specs)


def test_range_predicate_is_pushed_and_trunc_is_not(spark):
    estate = RetailTables(spark, SF).real_estate
    rng = X.year_sum_range(estate, 1996)
    trunc = X.year_sum_trunc(estate, 1996)
    scan = [ln for ln in formatted(rng).splitlines() if ln.startswith("PushedFilters")]
    # the cast-to-date range is unwrapped onto the raw timestamp column and pushed
    assert scan and "GreaterThanOrEqual(o_orderdate,1996-01-01" in scan[0] and "(o_orderdate,1997-01-01" in scan[0]
    tscan = [ln for ln in formatted(trunc).splitlines() if ln.startswith("PushedFilters")]
    assert not tscan or "GreaterThanOrEqual" not in tscan[0]   # a function of the column is not pushed
    assert rng.first()[0] == trunc.first()[0]
    assert rng.first()[0] == X.year_sum_window(estate, 1996).first()[0]


def test_equivalent_join_forms(spark):
    t = RetailTables(spark, SF)
    ip, colors = t.inventory_parts, t.colors
    a = sorted(map(tuple, X.semi_join_in(ip, colors).collect()))
    b = sorted(map(tuple, X.join_distinct(ip, colors).collect()))
    assert a == b
    assert "LeftSemi" in optimized(X.semi_join_in(ip, colors))
    c = sorted(map(tuple, X.join_agg_pruned(ip, colors).collect()))
    d = sorted(map(tuple, X.join_agg_implicit(spark, ip, colors).collect()))
    assert c == d


@pytest.mark.parametrize("name", ["report_mart_month_interval", "report_mart_daily", "plan_fact",
                                  "sales_mart_trailing", "join_one_key", "rank_merge"])
def test_no_fact_window_and_no_cross_join(spark, name):
    p = optimized(registry.QUERIES[name](spark, SF))
    assert only_running_totals(p)
    assert "Cross" not in p and "CartesianProduct" not in plan_text(registry.QUERIES[name](spark, SF))


def test_report_reads_only_needed_columns(spark):
    df = registry.QUERIES["report_mart_month_interval"](spark, SF)
    df.collect()
    txt = formatted(df)
    for line in [ln for ln in txt.splitlines() if ln.startswith("ReadSchema: ")]:
        assert "l_comment" not in line and "l_shipdate" not in line


def test_bucketed_tables_join_without_shuffle(spark):
    from martspark.operators import catalog
    from martspark.operators.loads import load_full
    from martspark.session import scratch_path
    t = RetailTables(spark, SF)
    root = scratch_path(spark, "tests/bucketed")
    catalog.create_database(spark, "bucketed", root)
    for name in ("bills_head", "bills_item"):
        load_full(getattr(t, name), f"{root}/{name}", bucket=("billnum", 8))
        catalog.register(spark, f"bucketed.{name}", f"{root}/{name}", bucket=("billnum", 8))
    h, i = spark.table("bucketed.bills_head"), spark.table("bucketed.bills_item")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = i.join(h, "billnum")
        assert j.count() == t.bills.count()
        txt = formatted(j)
        assert "SortMergeJoin" in txt and "Exchange" not in txt.split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


# Windows are allowed only over small results: the report's running totals (one row per plant
# and window end).


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_every_query_plan_has_no_cross_product(spark, name):
    df = registry.QUERIES[name](spark, SF)
    physical = plan_text(df)
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    assert only_running_totals(optimized(df)), name


def test_report_over_stored_tables(spark):
    """Two scans of bills, and the coupons' bills as a runtime filter on the one without dates."""
    from martspark.plans import report_mart as RM
    from martspark.session import scratch_path
    t, root = RetailTables(spark, SF), scratch_path(spark, "tests/report_scans")
    names = ("bills", "coupons", "promos", "traffic", "stores")
    for n in names:
        getattr(t, n).write.parquet(f"{root}/{n}")
    stored = type("Stored", (), {n: spark.read.parquet(f"{root}/{n}") for n in names})
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        plan = optimized(RM.report_mart(stored, "19960101", "19960228", 2, ("month_interval",)))
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert len(re.findall(r"Relation \[[^\]]*rpa_sat", plan)) == 2
    assert len(re.findall(r"isnotnull\(calday#\d+\)", plan)) == 1
    assert re.search(r"Filter \(+isnotnull\(billnum#\d+L\) AND isnotnull\(material#\d+L\)\) AND \(might_contain\(", plan)


def test_items_laid_out_by_bill(spark):
    from martspark.operators.loads import load_full
    from martspark.operators.merge import upsert_table
    from martspark.operators.tables import read_table
    from martspark.session import scratch_path
    items, path = RetailTables(spark, SF).bills_item, f"{scratch_path(spark, 'tests/laid_out')}/items"
    load_full(items, path, order_by="billnum")
    for _ in range(2):
        files = (read_table(spark, path).groupBy(F.input_file_name().alias("f")).agg(F.min("billnum").alias("lo"), F.max("billnum").alias("hi"))
                 .orderBy("lo").collect())
        assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:])) and read_table(spark, path).count() == items.count()
        upsert_table(spark, path, items.where("billnum % 7 = 0"), ["billnum"], order_by="billnum")
