"""Upsert (delete matching keys, insert all source rows) and rank merge.

Keys match NULL-safely (``<=>``), and every source row is inserted, duplicates
included. Both are joins/aggregates on the key, so a hot key is split by AQE's skew
handling instead of landing in one window partition.

``upsert_table`` is copy-on-write by file: only the files that hold a replaced row are written
again, beside the table (a path cannot be read and overwritten in one job), and renamed into it.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.operators.loads import accepted
from martspark.operators.ranges import in_ranges, key_ranges
from martspark.operators.tables import (PART_COL, beside, check_anchor, data_files, delete_path, month_key, read_table,
                                        staging_path, swap_files, write_observed)
from martspark.sources.files import CheckedRead


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], where: str | Column | None = None) -> DataFrame:
    """Target rows whose key is absent from the source, plus all source rows (of those
    matching ``where`` when given). The source keys are de-duplicated (combined map-side)
    so a key repeated many times in the source never builds one huge hash bucket."""
    if where is not None:
        source = source.where(F.expr(where) if isinstance(where, str) else where)
    src_keys = source.select(*keys).distinct()
    kept = target.join(src_keys, _null_safe_on(target, src_keys, keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def rank_merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
               where: str | Column | None = None) -> DataFrame:
    """Tag source 1 and target 2, union, keep the rows whose tag is the smallest of their key
    (``RANK() OVER (PARTITION BY key ORDER BY tag) = 1``, ties kept). The smallest tag of a key
    that the source has is the source's, so these are all source rows and the target rows of
    other keys: each input is read once, and no key's rows meet in a window."""
    return upsert(target, source, keys, where)


def touched_files(spark: SparkSession, target_path: str, target: DataFrame, src_keys: DataFrame,
                  keys: Sequence[str], narrow: bool = True) -> list[str]:
    """The files of a table that hold a row with one of the keys. With ``narrow`` only the row
    groups within a single key's ranges of the source, and those of NULLs, are searched."""
    if narrow and len(keys) == 1:
        target = target.where(in_ranges(keys[0], key_ranges(src_keys, keys[0]), nulls=True))
    rows = target.select(*keys, F.col("_metadata.file_path").alias("file_of_row"))
    hits = {r[0] for r in rows.join(src_keys, _null_safe_on(rows, src_keys, keys), "left_semi").select("file_of_row").distinct().collect()}
    hits |= {unquote(h) for h in hits}
    bare = {h.split(":", 1)[-1].lstrip("/") for h in hits}      # file:/x and file:///x are one
    return [f for f in data_files(spark, target_path) if f.split(":", 1)[-1].lstrip("/") in bare]


def upsert_table(spark: SparkSession, target_path: str, source: DataFrame | CheckedRead, keys: Sequence[str],
                 date_key: str | None = None, partition_col: str = PART_COL, anchor_day: int = 1,
                 order_by: str | None = None, bucket: tuple[str, int] | None = None) -> int:
    """Upsert into a parquet table, file by file: only the files that hold a replaced row are
    rewritten, without these rows; the source's rows come in new files; all other files stay as
    they are. The source is staged once on shared storage (its row count observed in that write,
    lineage cut). New files are written beside the table and renamed into it, so a failure leaves
    the old table whole. Where a month-partitioned table's date is a key, only the source's months
    are searched. ``bucket`` keeps a bucketed table bucketed. Returns the number of source rows
    inserted."""
    target = read_table(spark, target_path)
    src_path = staging_path(spark, target_path + "_source")
    new_path = beside(target_path)
    by_month = date_key is not None and partition_col in target.columns
    if by_month:
        check_anchor(spark, target_path, anchor_day, partition_col)
    try:
        with accepted(source, target_path) as src:
            if by_month:
                src = src.withColumn(partition_col, month_key(date_key, anchor_day))
            src = src.select(*target.columns)
            inserted = write_observed(src, src_path)[0]
        src = read_table(spark, src_path, src.schema)
        src_keys, search = src.select(*keys).distinct(), target
        if by_month and date_key in keys:
            # at most one value per partition of the table, a partition filter on the target
            months = [r[0] for r in src.select(partition_col).distinct().collect()]
            hit = F.col(partition_col).isin([m for m in months if m is not None])
            search = target.where(hit | F.col(partition_col).isNull() if None in months else hit)
        files = touched_files(spark, target_path, search, src_keys, keys, narrow=search is target)
        if files:
            old = spark.read.schema(target.schema).option("basePath", target_path).parquet(*files).select(*target.columns)
            src = upsert(old, src, keys)
        write_observed(src, new_path, "overwrite", partition_col if by_month else None, cluster=by_month,
                       order_by=order_by, bucket=bucket)
        swap_files(spark, new_path, target_path, files)
    finally:
        delete_path(spark, src_path)
        delete_path(spark, new_path)
    return inserted
