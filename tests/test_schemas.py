"""Schema-template checks (Q11): stand-in tables conform to the declared DDL."""

import os

import pytest
from pyspark.sql import functions as F

from martspark.sources.schemas import SCHEMAS, check_schema
from martspark.sources.standins import RetailTables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

CONFORMING = ["stores", "bills_head", "bills_item", "bills", "coupons", "promos", "traffic", "sales",
              "plan", "product", "price", "chanel"]


@pytest.mark.parametrize("name", CONFORMING)
def test_standin_matches_declared_schema(spark, name):
    df = getattr(RetailTables(spark, SF), name)
    assert check_schema(df, name) == []


def test_region_and_traffic_source_forms(spark):
    t = RetailTables(spark, SF)
    assert check_schema(t.region_dim, "region") == []
    assert check_schema(t.traffic_source, "traffic_source") == []


def test_mismatches_are_reported(spark):
    t = RetailTables(spark, SF)
    bad = t.bills_head.withColumn("billnum", F.col("billnum").cast("int")).drop("plant").withColumn("x", F.lit(1))
    got = sorted(check_schema(bad, "bills_head"))
    assert got == [("billnum", "bigint", "int"), ("plant", "string", "<missing>"), ("x", "<absent>", "int")]


def test_report_schema_matches_declared(spark):
    from martspark.plans import registry
    rep = registry.QUERIES["report_mart_month_interval"](spark, SF).drop("report_name")
    assert check_schema(rep, "report") == []
    assert set(SCHEMAS) >= {"logs", "mart", "plan_fact"}


def test_mart_outputs_match_declared(spark):
    from martspark.plans import registry
    assert check_schema(registry.QUERIES["sales_mart_trailing"](spark, SF), "mart") == []
    assert check_schema(registry.QUERIES["plan_fact"](spark, SF), "plan_fact") == []
