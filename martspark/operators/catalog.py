"""Tables of Spark's catalog: typed, with registered month partitions that are swapped by location,
bucketed by a distribution key, read by views that outlive the session.

The loaders of ``loads`` keep a table as a path and rename folders; on an object store a rename is
a copy. Here a month is exchanged by pointing its partition at newly written files: one change in
the catalog, no data moved, and readers see the old month until then. With a session catalog that
is shared (a metastore) tables and views are the warehouse's; with Spark's in-memory catalog they
live as long as the application.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martspark.operators.loads import _as_date, delta_window
from martspark.operators.tables import (PART_COL, _fs, delete_path, month_key, month_start, months_in, next_month_start,
                                        partition_folder, write_observed)


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_month_table(spark: SparkSession, table: str, schema: StructType, location: str, start=None, end=None,
                       partition_col: str = PART_COL) -> int:
    """A typed external table partitioned by month. With ``start`` and ``end`` (exclusive) the
    months from ``start`` on, each a month long, are registered, empty; returns their number."""
    fields = [f for f in schema.fields if f.name != partition_col]
    spark.sql(f"CREATE TABLE {table} ({_columns(StructType(fields))}, `{partition_col}` DATE) USING parquet "
              f"PARTITIONED BY (`{partition_col}`) LOCATION '{location}'")
    if start is None:
        return 0
    s, e = _as_date(start), _as_date(end)
    return add_months(spark, table, months_in(s, e, s.day), partition_col)


def create_like(spark: SparkSession, table: str, like: str, location: str) -> None:
    """An empty table with the columns and partitioning of another (``CREATE TABLE t (LIKE u)``)."""
    spark.sql(f"CREATE TABLE {table} LIKE {like} LOCATION '{location}'")


def register(spark: SparkSession, table: str, path: str, partition_col: str | None = None,
             bucket: tuple[str, int] | None = None, order_by: str | None = None) -> None:
    """Make a path table known to the catalog, or known anew: its columns from its files, its
    partitions from its folders. ``bucket`` says how its files were written (``write_observed``):
    joins and aggregates on that key then need no shuffle of it, a filter on it reads its bucket."""
    schema = spark.read.parquet(path).schema
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    by = f"PARTITIONED BY (`{partition_col}`) " if partition_col else ""
    into = f"CLUSTERED BY (`{bucket[0]}`) SORTED BY (`{order_by or bucket[0]}`) INTO {bucket[1]} BUCKETS " if bucket else ""
    spark.sql(f"CREATE TABLE {table} ({_columns(schema)}) USING parquet {by}{into}LOCATION '{path}'")
    if partition_col:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _spec(value, partition_col: str) -> str:
    return f"PARTITION (`{partition_col}` = {'NULL' if value is None else f"DATE'{value}'"})"


def add_months(spark: SparkSession, table: str, months: list[dt.date], partition_col: str = PART_COL) -> int:
    """Register month partitions; those that the table has already stay. Returns the number added."""
    new = [m for m in months if m not in set(registered_months(spark, table, partition_col))]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(_spec(m, partition_col) for m in new))
    return len(new)


def month_partitions(spark: SparkSession, table: str, partition_col: str = PART_COL) -> DataFrame:
    """(partition_start, partition_end) of the catalog's partitions; no file is listed or read."""
    start = F.regexp_extract("partition", rf"{partition_col}=(.*)$", 1).try_cast("date")
    return (spark.sql(f"SHOW PARTITIONS {table}").select(start.alias("partition_start"))
            .select("partition_start", F.add_months("partition_start", 1).alias("partition_end")))


def registered_months(spark: SparkSession, table: str, partition_col: str = PART_COL) -> list[dt.date]:
    """Starts of the registered months, rising (one per partition of the table)."""
    return sorted(r[0] for r in month_partitions(spark, table, partition_col).collect() if r[0] is not None)


def add_missing_months(spark: SparkSession, table: str, value, partition_col: str = PART_COL) -> int:
    """Add month partitions after the last one until ``value`` falls inside one, only where the
    table has more than one partition already. Returns the number added."""
    have, v = registered_months(spark, table, partition_col), _as_date(value)
    if len(have) < 2:
        return 0
    anchor = max(m.day for m in have)
    new, end = [], next_month_start(have[-1], anchor)
    while v >= end:
        new.append(end)
        end = next_month_start(end, anchor)
    return add_months(spark, table, new, partition_col)


def _detail(spark: SparkSession, table: str, spec: str, after: str) -> str:
    """The location said under the heading ``after`` of a table's description."""
    rows = [(r[0], r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").collect()]
    at = next(i for i, r in enumerate(rows) if r[0] == after)
    return next(v for k, v in rows[at:] if k == "Location")


def table_location(spark: SparkSession, table: str) -> str:
    return _detail(spark, table, "", "# Detailed Table Information")


def month_location(spark: SparkSession, table: str, month, partition_col: str = PART_COL) -> str:
    """Where a registered month's files lie."""
    return _detail(spark, table, _spec(month, partition_col), "# Detailed Partition Information")


def exchange_months(spark: SparkSession, table: str, df: DataFrame, ws: dt.date, we: dt.date, key: str,
                    partition_col: str = PART_COL, anchor_day: int = 1, validate: bool = True) -> int:
    """Exchange the months of [ws, we) with the rows of ``df``: written once to a fresh place, then
    each month's partition is pointed at its new folder (months that are new are registered; a
    month without rows gets an empty folder). With ``validate`` a row outside the window ends the
    load before any exchange. The old folders go after the last exchange. Returns the rows."""
    have = registered_months(spark, table, partition_col)
    if odd := [m for m in have if m != month_start(m, anchor_day)]:
        raise ValueError(f"{table} has a partition that starts on {odd[0]}, the load's months start on day {anchor_day}")
    columns = [c for c in spark.table(table).columns if c != partition_col]
    rows = df.select(*columns, month_key(key, anchor_day).alias(partition_col))
    inside = (F.col(key) >= F.lit(ws)) & (F.col(key) < F.lit(we))
    if validate:
        rows = rows.withColumn(partition_col, F.when(inside, F.col(partition_col)).otherwise(
            F.raise_error(F.concat(F.lit("row outside the partition window: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))))
    else:
        rows = rows.where(inside)
    new = f"{table_location(spark, table).rstrip('/')}_months/{uuid.uuid4().hex[:12]}"
    try:
        n, _ = write_observed(rows, new, "overwrite", partition_col, cluster=True)
    except BaseException:
        delete_path(spark, new)
        raise
    months, old = months_in(ws, we, anchor_day), []
    for m in months:
        folder = f"{new}/{partition_folder(partition_col, m)}"
        fs, p = _fs(spark, folder)
        fs.mkdirs(p)
        if m in have:
            old.append(month_location(spark, table, m, partition_col))
            spark.sql(f"ALTER TABLE {table} {_spec(m, partition_col)} SET LOCATION '{folder}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {_spec(m, partition_col)} LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    for folder in old:
        delete_path(spark, folder)
    return n


def exchange_month(spark: SparkSession, table: str, df: DataFrame, month, key: str, partition_col: str = PART_COL,
                   anchor_day: int = 1, validate: bool = True) -> int:
    """``EXCHANGE PARTITION FOR (month) WITH TABLE df WITH VALIDATION``."""
    ws = month_start(_as_date(month), anchor_day)
    return exchange_months(spark, table, df, ws, next_month_start(ws, anchor_day), key, partition_col, anchor_day, validate)


def load_delta(spark: SparkSession, table: str, source: DataFrame, key: str, start, end, partition_col: str = PART_COL,
               anchor_day: int = 1) -> int:
    """The whole months covering [start, end] of a catalog table replaced by the source's rows."""
    ws, we = delta_window(start, end, anchor_day)
    return exchange_months(spark, table, source, ws, we, key, partition_col, anchor_day, validate=False)


def exchange_table(spark: SparkSession, table: str, df: DataFrame) -> int:
    """Exchange all rows of an unpartitioned table: written to a fresh place, then the table is
    pointed there. Returns the rows."""
    old = table_location(spark, table)
    new = f"{old.rstrip('/')}_{uuid.uuid4().hex[:12]}"
    n, _ = write_observed(df.select(*spark.table(table).columns), new, "overwrite")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table)
    delete_path(spark, old)
    return n


def create_view(spark: SparkSession, view: str, query: str) -> None:
    """A view of the catalog: any session that sees the catalog reads it."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
