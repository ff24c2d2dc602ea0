"""Data-quality and metadata checks: rows per segment, skew coefficient, partition
bounds, date bounds, table size, schema-template check. All are aggregates that
combine map-side; nothing is collected except the final few rows."""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from martspark.operators.tables import PART_COL, table_partition_values


def rows_per_segment(df: DataFrame, key: str | None, segments: int) -> DataFrame:
    """Rows per segment of a planned distribution on ``key`` (``pmod(key, n)`` for an
    integral key, a hash otherwise); with ``key=None`` the current Spark partitions."""
    if key is None:
        seg = F.spark_partition_id()
    elif dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        seg = F.pmod(F.col(key), F.lit(segments))
    else:
        seg = F.pmod(F.xxhash64(key), F.lit(segments))
    return df.groupBy(seg.cast("int").alias("segment")).agg(F.count(F.lit(1)).alias("rows"))


def skew_coefficient(per_segment: DataFrame) -> DataFrame:
    """stddev / mean * 100 of the rows per segment (0 = perfectly even)."""
    return per_segment.agg(
        F.count(F.lit(1)).alias("segments"),
        F.sum("rows").alias("rows"),
        (F.stddev_samp("rows") / F.avg("rows") * 100).cast(DecimalType(20, 4)).alias("skew_pct"))


def partition_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """One row per month partition: its range, row count and the dates actually held."""
    g = df.groupBy(F.trunc(date_col, "MM").alias("partition_start")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))
    return g.select("partition_start", F.add_months("partition_start", 1).alias("partition_end"),
                    "rows", "min_date", "max_date")


def date_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """Min/max date and row count, checked before choosing the partition range."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.count(F.lit(1)).alias("rows"))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same cluster, same catalog) that answers counts, minima and maxima
    of parquet tables from the files' footers. Types whose footers can't tell (texts, timestamps)
    are read as ever."""
    s = spark.newSession()
    v1 = s.conf.get("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,parquet,text").split(",")
    s.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in v1 if x != "parquet"))
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return s


def _by_footers(spark: SparkSession, table_path: str, bounds: Callable[[DataFrame], DataFrame], partition_col: str) -> tuple[DataFrame, DataFrame | None]:
    """``bounds`` of the months by footers, and of the partition of NULL months, where there is one,
    by reading it (a file of NULLs alone has no bounds in its footer). If any other file's footer
    can't tell either, everything is read."""
    stored, read = footer_session(spark).read.parquet(table_path), spark.read.parquet(table_path)
    null_month = partition_col in read.columns and None in table_partition_values(spark, table_path, partition_col)
    known = bounds(stored.where(F.col(partition_col).isNotNull()) if null_month else stored)
    try:
        known.collect()                 # footers only, a row a partition at most
    except Exception as e:
        if "No min/max found" not in str(e):
            raise
        return bounds(read), None
    return known, bounds(read.where(F.col(partition_col).isNull())) if null_month else None


def stored_date_bounds(spark: SparkSession, table_path: str, date_col: str, partition_col: str = PART_COL) -> DataFrame:
    """``date_bounds`` of a stored table, from its footers: no row is read."""
    known, rest = _by_footers(spark, table_path, lambda df: date_bounds(df, date_col), partition_col)
    if rest is None:
        return known
    return known.unionByName(rest).agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.sum("rows").alias("rows"))


def stored_partition_bounds(spark: SparkSession, table_path: str, date_col: str, partition_col: str = PART_COL) -> DataFrame:
    """``partition_bounds`` of a stored table partitioned by month, from its footers."""
    def bounds(df: DataFrame) -> DataFrame:
        g = df.groupBy(F.col(partition_col).alias("partition_start")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))
        return g.select("partition_start", F.add_months("partition_start", 1).alias("partition_end"), "rows", "min_date", "max_date")

    known, rest = _by_footers(spark, table_path, bounds, partition_col)
    return known if rest is None else known.unionByName(rest)


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """The values of a distribution key that hold at least ``share`` of the rows each, with their
    exact counts: they make a segment heavy whatever the number of segments.

    The first pass keeps a sketch of the most frequent values (its size depends on ``share``
    alone; it misses none above the share), the second counts these candidates exactly. NULL is a
    value like others."""
    if not 0 < share <= 1:
        raise ValueError("a share of the rows: above 0, at most 1")
    tracked = 1 << max(3, math.ceil(math.log2(16 / share)))     # counts are off by 3.5 / tracked of the rows at most
    first = df.agg(F.expr(f"approx_top_k(`{key}`, {min(tracked, math.ceil(2 / share) + 1)}, {tracked})").alias("top"),
                   F.count(F.lit(1)).alias("n")).first()
    values = [x["item"] for x in first["top"] or [] if x["item"] is not None]
    hit = F.col(f"`{key}`").isin(values) | F.col(f"`{key}`").isNull() if values else F.col(f"`{key}`").isNull()
    n = F.lit(first["n"])
    counted = df.where(hit).groupBy(F.col(f"`{key}`").alias(key)).agg(F.count(F.lit(1)).alias("rows"))
    return (counted.where(F.col("rows") >= F.lit(decimal.Decimal(str(share))) * n)
            .withColumn("share_pct", (F.col("rows").cast(DecimalType(20, 0)) * 100 / n.cast(DecimalType(20, 0))).cast(DecimalType(7, 4))))


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and bytes per table from a file listing (file contents are not read)."""
    frames = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
              .select(F.lit(name).alias("table_name"), "length") for name, p in paths.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("table_name").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def schema_mismatches(df: DataFrame, expected: StructType) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) for each column that is missing, extra or
    of another type than the registered template. Empty list = conforms."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    out = []
    for name, t in want.items():
        if actual.get(name) != t:
            out.append((name, t, actual.get(name, "<missing>")))
    for name, t in actual.items():
        if name not in want:
            out.append((name, "<absent>", t))
    return out


def table_partitions(spark: SparkSession, table_path: str, partition_col: str = "pmonth") -> DataFrame:
    """Partition list of a month-partitioned table from its file listing (contents are not
    read): range start and end, number of files, bytes. The analogue of a catalog's
    partition view."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(table_path).select("path", "length"))
    start = F.to_date(F.regexp_extract("path", rf"/{partition_col}=(\d{{4}}-\d{{2}}-\d{{2}})/", 1))
    g = files.groupBy(start.alias("partition_start")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return g.select("partition_start", F.add_months("partition_start", 1).alias("partition_end"), "files", "bytes")
