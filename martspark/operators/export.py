"""Publishing reports to a sharded, sorted store.

The export narrows the report to the target schema, numbers the stores by plant within
each report (``row_number`` over the report's rows only: one row per store, so the
window holds |stores| rows, never facts), and writes ``repartition(shards, shard_key)``
+ ``sortWithinPartitions`` by report and order key. Reading the root back gives all shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType

from martspark.operators import catalog
from martspark.operators.tables import beside, delete_path, path_exists, swap_in, write_observed

# The export table's column types.
EXPORT_SCHEMA = (
    ("plant_id", IntegerType()), ("plant", StringType()), ("txt", StringType()),
    ("turnover", IntegerType()), ("coupon_discount", DecimalType(17, 2)),
    ("turnover_with_discount", DecimalType(17, 2)), ("material_qty", IntegerType()),
    ("bills_qty", IntegerType()), ("traffic", IntegerType()), ("matdisc_qty", IntegerType()),
    ("matdisc_percent", DecimalType(7, 1)), ("avg_mat_qty", DecimalType(7, 2)),
    ("conversion_rate", DecimalType(7, 2)), ("avg_bill", DecimalType(7, 1)),
    ("avg_profit", DecimalType(7, 1)),
)


# The same columns without narrowing: 64-bit counts and amounts, report precision kept.
# The declared export table is Int32 / Decimal(7, s); with ANSI casts a store whose
# turnover or counts exceed it fails the export instead of wrapping, so at large scale
# publish with this schema.
EXPORT_SCHEMA_WIDE = (
    ("plant_id", IntegerType()), ("plant", StringType()), ("txt", StringType()),
    ("turnover", LongType()), ("coupon_discount", DecimalType(17, 2)),
    ("turnover_with_discount", DecimalType(17, 2)), ("material_qty", LongType()),
    ("bills_qty", LongType()), ("traffic", LongType()), ("matdisc_qty", LongType()),
    ("matdisc_percent", DecimalType(17, 1)), ("avg_mat_qty", DecimalType(17, 2)),
    ("conversion_rate", DecimalType(17, 2)), ("avg_bill", DecimalType(17, 1)),
    ("avg_profit", DecimalType(17, 1)),
)


def export_frame(report: DataFrame, schema=EXPORT_SCHEMA) -> DataFrame:
    """Number the stores per report and cast to the export schema (declared by default)."""
    w = Window.partitionBy("report_name").orderBy("plant")
    numbered = report.withColumn("plant_id", F.row_number().over(w))
    return numbered.select("report_name", *[F.col(n).cast(t).alias(n) for n, t in schema])


def publish_sharded(df: DataFrame, path: str, shards: int, shard_key: str = "plant_id",
                    order_key: str = "plant", partition_by: tuple[str, ...] = ("report_name",)) -> None:
    """``shards`` files a report, each in order of ``order_key``: the rows are sorted by the
    folders' columns first, so the writer has no reason to sort them again."""
    writer = (df.repartition(shards, shard_key).sortWithinPartitions(*partition_by, order_key)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish_shards(df: DataFrame, table: str, path: str, shards: int, shard_key: str = "plant_id",
                   order_key: str = "plant", report_col: str = "report_name") -> int:
    """The export as a table of the catalog whose shards can be read by key: a folder a report,
    ``shards`` buckets of ``shard_key`` in each, in order of ``order_key``. A filter on the key
    reads its bucket only. Reports in ``df`` are written beside the table and exchanged; other
    reports' files stay. Returns the rows."""
    spark, new_path = df.sparkSession, beside(path)
    try:
        rows, reports = write_observed(df, new_path, "overwrite", report_col, order_by=order_key, bucket=(shard_key, shards))
        if path_exists(spark, path):
            swap_in(spark, new_path, path, reports, report_col)
        else:
            swap_in(spark, new_path, path)
    finally:
        delete_path(spark, new_path)
    catalog.register(spark, table, path, report_col, (shard_key, shards), order_key)
    return rows


# The columns of the plan/fact export table (shards by ``complete_percent``,
# order by ``region_code``; unsigned 32-bit columns there, so no value may be negative).
PLAN_FACT_UNSIGNED = ("distr_chanel", "planned_quantity", "real_quantity", "complete_percent")


def plan_fact_export_frame(mart: DataFrame) -> DataFrame:
    """The plan/fact mart as the export table declares it: its whole-number columns are
    unsigned 32-bit there. A negative or larger value ends the export, it never wraps."""
    out = mart
    for name in PLAN_FACT_UNSIGNED:
        n = F.col(name).cast("bigint")
        out = out.withColumn(name, F.when(n.isNull() | n.between(0, 4294967295), n).otherwise(
            F.raise_error(F.concat(F.lit(f"{name} does not fit UInt32: "), n.cast("string")))))
    return out.withColumn("matdirec_code", F.col("matdirec_code").cast("string"))


def publish_plan_fact(mart: DataFrame, path: str, shards: int) -> None:
    """Write the plan/fact export: sharded by completion, in order of the region."""
    publish_sharded(plan_fact_export_frame(mart), path, shards, "complete_percent", "region_code", ())
