"""Loaders: full, filtered full, single month, multi-month delta (with text-date
conversion), header x item delta, partition swap with validation, table swap,
missing-month partitions. Each returns the number of rows it loaded."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martspark.functions import add_months_py, parse_date_text, prune_months, trunc_month_py
from martspark.operators.ranges import RANGES, in_ranges, key_ranges
from martspark.operators.tables import (PART_COL, beside, check_anchor, delete_path, month_key, month_start,
                                        months_in, next_month_start, path_exists, read_table, replace_table,
                                        staging_path, swap_in, table_partition_values, write_observed)
from martspark.sources.files import CheckedRead, RejectLimitExceeded, split_rejects


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v)[:10])


def _cond(where: str | Column | None) -> Column:
    if where is None:
        return F.lit(True)
    return F.expr(where) if isinstance(where, str) else where


@contextlib.contextmanager
def accepted(source: DataFrame | CheckedRead, target_path: str) -> Iterator[DataFrame]:
    """The rows of a source. Of a read with a reject limit, the good rows, staged and counted
    first: a limit that is reached ends the load before the target is touched."""
    if not isinstance(source, CheckedRead):
        yield source
        return
    spark = source.good.sparkSession
    path = staging_path(spark, target_path)
    try:
        write_observed(source.good, path)
        source.check()
        yield read_table(spark, path, source.good.schema)
    finally:
        delete_path(spark, path)


def load_full(source: DataFrame | CheckedRead, target_path: str, partition_col: str | None = None,
              date_key: str | None = None, anchor_day: int = 1, order_by: str | None = None,
              bucket: tuple[str, int] | None = None) -> int:
    """Replace the target by every source row. A load that fails leaves the target as it was."""
    with accepted(source, target_path) as df:
        if partition_col and date_key:
            df = df.withColumn(partition_col, month_key(date_key, anchor_day))
        return replace_table(df, target_path, partition_col, cluster=True, order_by=order_by, bucket=bucket)


def load_filtered(source: DataFrame | CheckedRead, target_path: str, where: str | Column | None = None,
                  truncate: bool = False, partition_col: str | None = None,
                  date_key: str | None = None, anchor_day: int = 1) -> int:
    """Load the source rows matching ``where`` (default: all); append unless ``truncate``."""
    with accepted(source, target_path) as df:
        df = df.where(_cond(where))
        if partition_col and date_key:
            if not truncate:
                check_anchor(df.sparkSession, target_path, anchor_day, partition_col)
            df = df.withColumn(partition_col, month_key(date_key, anchor_day))
        if truncate:
            return replace_table(df, target_path, partition_col, cluster=True)
        return write_observed(df, target_path, "append", partition_col, cluster=True)[0]


def load_full_keeping_rejects(spark: SparkSession, path: str, schema: StructType, target_path: str, rejects_path: str,
                              limit: int | None = 10, partition_col: str | None = None, date_key: str | None = None,
                              **options) -> tuple[int, int]:
    """Replace the target by the good rows of delimited files and keep the malformed lines, with
    their file and the time of the load, in a table of their own. The files are read once. ``limit``
    counts by file, as the source counts by segment: a file with so many malformed lines ends the
    load, the target and the kept lines stay as they were. Returns (rows loaded, lines rejected)."""
    staged = staging_path(spark, target_path)
    try:
        good, bad = split_rejects(spark, path, schema, staged, **options)
        per_file = bad.groupBy("file").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "file")
        worst = per_file.first()
        if limit is not None and worst is not None and worst["n"] >= limit:
            raise RejectLimitExceeded(f"{worst['n']} rejected rows in {worst['file']} reach the reject limit {limit}")
        rows = load_full(good, target_path, partition_col, date_key)
        kept, _ = write_observed(bad.withColumn("loaded_at", F.current_timestamp()), rejects_path, "append")
    finally:
        delete_path(spark, staged)
    return rows, kept


def truncate_table(spark: SparkSession, target_path: str, schema) -> None:
    """Empty a table, keeping its schema readable (an overwrite with no rows)."""
    replace_table(spark.createDataFrame([], schema), target_path)


def insert_rows(spark: SparkSession, target_path: str, rows: list[tuple], schema) -> int:
    """``INSERT ... VALUES``: append literal rows (a handful, from the caller) to a table."""
    rows_written, _ = write_observed(spark.createDataFrame(rows, schema), target_path, "append")
    return rows_written


def load_single_partition(source: DataFrame | CheckedRead, target_path: str, key: str, start,
                          end=None, partition_col: str = PART_COL, anchor_day: int | None = None) -> int:
    """Empty the WHOLE table, then load the month starting at ``start``
    (``[start, start + 1 month)``). ``end`` is accepted and ignored, as in the source."""
    s = _as_date(start)
    e = add_months_py(s, 1)
    with accepted(source, target_path) as df:
        df = (df.where((F.col(key) >= F.lit(s)) & (F.col(key) < F.lit(e)))
                .withColumn(partition_col, month_key(key, anchor_day or s.day)))
        return replace_table(df, target_path, partition_col, cluster=True)


def delta_window(start, end, anchor_day: int = 1) -> tuple[dt.date, dt.date]:
    """Whole months covering [start, end], from the start of the first's to the start of the
    one after the last's; months start on ``anchor_day``."""
    return (month_start(_as_date(start), anchor_day),
            next_month_start(month_start(_as_date(end), anchor_day), anchor_day))


def month_digests(df: DataFrame, columns: list[str], partition_col: str = PART_COL) -> DataFrame:
    """Row count and two order-free hashes of the rows of each month: equal rows, as often, in
    any order and any files give equal digests."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    g = F.xxhash64(F.lit("second"), *[F.col(f"`{c}`") for c in columns])
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("total"),
                                         F.bit_xor(g).alias("parity"))


def unchanged_months(spark: SparkSession, staged_path: str, target_path: str, months: list[str],
                     partition_col: str = PART_COL) -> set[str]:
    """Those of ``months`` that hold the same rows in both tables."""
    here = set(table_partition_values(spark, target_path, partition_col)) & set(table_partition_values(spark, staged_path, partition_col)) & set(months)
    if not here:
        return set()
    new, old = read_table(spark, staged_path), read_table(spark, target_path)
    if sorted(new.dtypes) != sorted(old.dtypes):
        return set()
    cols, hit = sorted(new.columns), F.col(partition_col).isin([dt.date.fromisoformat(m) for m in sorted(here)])
    a, b = (month_digests(x.where(hit), cols, partition_col) for x in (new, old))
    return {str(r[0]) for r in a.intersect(b).select(partition_col).collect()}


def replace_months(spark: SparkSession, df: DataFrame, target_path: str, ws: dt.date, we: dt.date,
                   key: str, partition_col: str = PART_COL, validate: bool = True, anchor_day: int = 1,
                   keep_equal: bool = False) -> int:
    """Replace every month partition in [ws, we) with the rows of ``df``: written beside the
    table, then all months renamed in together; months of the window that receive no row are
    emptied. A load that fails leaves the table as it was. The table's months must start on
    ``anchor_day``, or the load is refused. ``keep_equal`` leaves months alone whose rows are the
    same as before (their files keep their names), for a scan of both."""
    check_anchor(spark, target_path, anchor_day, partition_col)
    staged, new_path = df.withColumn(partition_col, month_key(key, anchor_day)), beside(target_path)
    if validate:
        staged = staged.withColumn(partition_col, F.when(
            (F.col(key) >= F.lit(ws)) & (F.col(key) < F.lit(we)), F.col(partition_col)
        ).otherwise(F.raise_error(F.concat(F.lit("row outside the partition window: "), F.col(key).cast("string")))))
    try:
        rows, _ = write_observed(staged, new_path, "overwrite", partition_col, cluster=True)
        months = [str(m) for m in months_in(ws, we, anchor_day)]
        same = unchanged_months(spark, new_path, target_path, months, partition_col) if keep_equal else set()
        if rows and not path_exists(spark, target_path):
            swap_in(spark, new_path, target_path)
        else:
            swap_in(spark, new_path, target_path, [m for m in months if m not in same], partition_col)
    finally:
        delete_path(spark, new_path)
    return rows


def load_delta_partitions(spark: SparkSession, source: DataFrame | CheckedRead, target_path: str, key: str,
                          start, end, convert: bool = False, date_format: str = "dd.MM.yyyy",
                          partition_col: str = PART_COL, anchor_day: int = 1, keep_equal: bool = False) -> int:
    """Replace the whole months covering [start, end] with the source rows of those
    months. With ``convert`` the source key is text in ``date_format`` and is parsed
    before filtering (bad text raises, as the source database does)."""
    ws, we = delta_window(start, end, anchor_day)
    with accepted(source, target_path) as src:
        src = src.withColumn(key, parse_date_text(key, date_format)) if convert else src
        df = src.where((F.col(key) >= F.lit(ws)) & (F.col(key) < F.lit(we)))
        return replace_months(spark, df, target_path, ws, we, key, partition_col, validate=False,
                              anchor_day=anchor_day, keep_equal=keep_equal)


HEADER_ITEM_COLUMNS = ("billnum", "billitem", "material", "plant", "calday", "calmonth",
                       "rpa_sat", "qty", "netval", "tax")


def load_header_item(spark: SparkSession, items: DataFrame, heads: DataFrame, target_path: str,
                     start, end, key: str = "calday", join_key: str = "billnum",
                     key_range_pushdown: bool = False, partition_col: str = PART_COL,
                     anchor_day: int = 1, ranges: int = RANGES, keep_equal: bool = False) -> int:
    """Items joined to the heads of each month in the window, ``calmonth`` derived,
    months replaced. Of heads partitioned by month only the window's partitions are opened.
    ``key_range_pushdown`` first cuts the heads' join keys into up to ``ranges`` ranges at their
    largest gaps and reads the items in these only: a JDBC source evaluates that remotely, and of
    items laid out by that key the row groups between the ranges are skipped. Items bucketed by
    the join key (``catalog.register``) meet the heads where they lie."""
    ws, we = delta_window(start, end, anchor_day)
    h = prune_months(heads, ws, we, partition_col).where((F.col(key) >= F.lit(ws)) & (F.col(key) < F.lit(we)))
    h = h.drop(partition_col)
    it = items.where(in_ranges(join_key, key_ranges(h, join_key, ranges))) if key_range_pushdown else items
    j = it.join(h, join_key).select(
        join_key, "billitem", "material", "plant", key,
        F.date_format(key, "yyyyMM").alias("calmonth"), "rpa_sat", "qty", "netval", "tax")
    return replace_months(spark, j, target_path, ws, we, key, partition_col, validate=False, anchor_day=anchor_day,
                          keep_equal=keep_equal)


def partition_swap(spark: SparkSession, target_path: str, staged: DataFrame, month, key: str,
                   partition_col: str = PART_COL, validate: bool = True, anchor_day: int = 1) -> int:
    """Exchange one month partition with the staged rows. With ``validate`` every staged
    row must lie in that month (the write fails otherwise). An empty stage empties it."""
    ws = month_start(_as_date(month), anchor_day)
    return replace_months(spark, staged, target_path, ws, next_month_start(ws, anchor_day), key, partition_col,
                          validate, anchor_day)


def table_swap(spark: SparkSession, target_path: str, staged_path: str) -> int:
    """Replace the whole table with a table staged beside it (``stage``), by renames: no row is
    copied, and the old table stays until the new one is in. Returns the rows by file footers."""
    rows = read_table(spark, staged_path).count()
    swap_in(spark, staged_path, target_path)
    return rows


def stage(spark: SparkSession, df: DataFrame, target_path: str, partition_col: str | None = None) -> str:
    """Write ``df`` to a fresh hidden place beside the target; returns its path."""
    p = beside(target_path)
    write_observed(df, p, "overwrite", partition_col)
    return p


def missing_month_partitions(existing: DataFrame, partition_col: str, value) -> DataFrame:
    """Month partitions to append after the last one until ``value`` falls inside,
    only when the table already has more than one partition (as the source does)."""
    v = trunc_month_py(_as_date(value))
    b = existing.agg(F.count_distinct(partition_col).alias("n"), F.max(partition_col).alias("last"))
    seq = F.sequence(F.add_months("last", 1), F.lit(v), F.expr("INTERVAL 1 MONTH"))
    return (b.where((F.col("n") > 1) & (F.add_months("last", 1) <= F.lit(v)))
             .select(F.explode(seq).alias("partition_start"))
             .select("partition_start", F.add_months("partition_start", 1).alias("partition_end")))
