"""Equivalent query forms from the warehouse tuning exercises, as DataFrame/SQL code.

Each pair returns the same rows; the point is the plan each form gets:
* a function-of-column predicate vs a range predicate (only the range prunes/pushes),
* ``IN (SELECT DISTINCT ...)`` vs a semi join vs a join to a distinct derived table,
* a wide derived table vs a pruned one vs an implicit comma join (same plan),
* grouping on native types and casting after (char(n) casts out of the group key).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martspark.functions import bpchar, prune_months, year_window

INVENTORY_COLUMNS = ("inventory_id", "part_num", "color_id", "quantity", "is_spare")


def year_sum_trunc(real_estate: DataFrame, year: int) -> DataFrame:
    """``date_trunc('year', date) = 'Y-01-01'``: the predicate is a function of the column."""
    cond = F.date_trunc("year", F.col("date")) == F.lit(dt.datetime(year, 1, 1))
    return real_estate.where(cond).agg(F.sum("sale_price").cast(DecimalType(18, 2)).alias("sum_sale_price"))


def year_sum_range(real_estate: DataFrame, year: int) -> DataFrame:
    """``date >= 'Y-01-01' AND date <= 'Y-12-31'``: pushed to the scan; on a
    month-partitioned table the same range on the partition column prunes partitions."""
    cond = (F.col("date") >= F.lit(dt.date(year, 1, 1))) & (F.col("date") <= F.lit(dt.date(year, 12, 31)))
    return prune_months(real_estate, dt.date(year, 1, 1), dt.date(year, 12, 31)).where(cond).agg(F.sum("sale_price").cast(DecimalType(18, 2)).alias("sum_sale_price"))


def year_sum_window(real_estate: DataFrame, year: int) -> DataFrame:
    """The half-open form used by the loaders (``functions.year_window``)."""
    return prune_months(real_estate, dt.date(year, 1, 1), dt.date(year, 12, 31)).where(year_window("date", year)).agg(
        F.sum("sale_price").cast(DecimalType(18, 2)).alias("sum_sale_price"))


def semi_join_in(ip: DataFrame, colors: DataFrame) -> DataFrame:
    """``WHERE inventory_id IN (SELECT DISTINCT id FROM colors)`` as a left semi join;
    the DISTINCT is dropped because a semi join ignores duplicates anyway."""
    return ip.join(colors.select("id"), ip.inventory_id == colors.id, "left_semi")


def join_distinct(ip: DataFrame, colors: DataFrame) -> DataFrame:
    """``JOIN (SELECT DISTINCT id FROM colors) c ON ip.inventory_id = c.id``."""
    ids = colors.select("id").distinct()
    return ip.join(ids, ip.inventory_id == ids.id).select(*INVENTORY_COLUMNS)


def join_agg_pruned(ip: DataFrame, colors: DataFrame) -> DataFrame:
    """Sum of quantity per color over the pruned derived table (color_id, quantity)."""
    narrow = ip.select("color_id", "quantity")
    return (colors.join(narrow, colors.id == narrow.color_id)
                  .groupBy("id").agg(F.sum("quantity").alias("sum_quantity")))


def join_agg_implicit(spark: SparkSession, ip: DataFrame, colors: DataFrame) -> DataFrame:
    """The comma-join form in SQL; Catalyst turns it into the same inner join.
    View names are unique per call, so concurrent callers never see each other's data."""
    tag = uuid.uuid4().hex[:8]
    ip.createOrReplaceTempView(f"inventory_parts_{tag}")
    colors.createOrReplaceTempView(f"colors_{tag}")
    return spark.sql(f"""
        SELECT c.id, SUM(ip.quantity) AS sum_quantity
        FROM colors_{tag} c, inventory_parts_{tag} ip
        WHERE c.id = ip.color_id
        GROUP BY c.id""")


def left_join_char_group(ip: DataFrame, colors: DataFrame) -> DataFrame:
    """Group on the native columns, then apply the int4 / char(n) casts to the result."""
    j = ip.join(colors, ip.color_id == colors.id, "left")
    g = j.groupBy(ip.inventory_id, colors.name, ip.is_spare).agg(F.sum("quantity").alias("sum_quantity"))
    return g.select(F.col("inventory_id").cast("int").alias("inventory_id"),
                    bpchar("name", 250).alias("name"),
                    bpchar("is_spare", 1).alias("is_spare"),
                    "sum_quantity")
