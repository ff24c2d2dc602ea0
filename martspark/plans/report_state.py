"""The store report from maintained day-grain state.

Kept by month beside the warehouse tables: what each bill sold on each day, each coupon's discount
on each line of its bill, each store's visitors of each day. After a re-load only the re-loaded
months are read from the facts again and exchanged; a report then reads state alone, of its windows'
months. A coupon's discount also depends on its bill, which may lie in another month, and on the
promos: months with coupons of a bill that the re-load took away, brought or changed are rebuilt as
well, and all of them if the promos are others than before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.operators.loads import month_digests, replace_months
from martspark.operators.ranges import RANGES, in_ranges, key_ranges
from martspark.operators.tables import (PART_COL, month_key, next_month_start, path_exists,
                                        read_table, replace_table, table_partition_values)
from martspark.plans import report_mart as RM

KEPT = ("bill_days", "coupon_lines", "traffic_days")


def _months_of(spark: SparkSession, path: str) -> list[dt.date]:
    return [dt.date.fromisoformat(m) for m in table_partition_values(spark, path) if m is not None]


def _of(df: DataFrame, months: Iterable[dt.date], day: str) -> DataFrame:
    """The rows of some months, by the partition column and by the day."""
    months = sorted(months)
    hit = F.col(PART_COL).isin(months) if PART_COL in df.columns else month_key(day).isin(months)
    return df.where(hit).drop(PART_COL)


def _exchange(spark: SparkSession, df: DataFrame, path: str, months: list[dt.date], day: str) -> None:
    """Exchange months of a state table, runs of neighbours together; equal months stay as they are."""
    run: list[dt.date] = []
    for m in [*sorted(months), None]:
        if run and (m is None or m != next_month_start(run[-1])):
            ws, we = run[0], next_month_start(run[-1])
            part = df.where((F.col(day) >= F.lit(ws)) & (F.col(day) < F.lit(we)))
            replace_months(spark, part, path, ws, we, day, validate=False, keep_equal=True)
            run = []
        if m is not None:
            run.append(m)


def _promos_changed(spark: SparkSession, promos: DataFrame, path: str) -> bool:
    """Whether the promos are others than at the last refresh; remembers their digest."""
    now = month_digests(promos.withColumn("all", F.lit(1)), sorted(promos.columns), "all").drop("all")
    was = read_table(spark, path).collect() if path_exists(spark, path) else None
    if was == (digest := now.collect()):
        return False
    replace_table(spark.createDataFrame(digest, now.schema), path)
    return True


def refresh(spark: SparkSession, state: str, bills: DataFrame, coupons: DataFrame, promos: DataFrame, traffic: DataFrame,
            months: Iterable[dt.date]) -> dict[str, list[dt.date]]:
    """Bring the state up to date after a load of ``months`` into bills, coupons or traffic.
    A first refresh builds the state of all months of the tables. Returns the months that were read
    again, by state table."""
    state, months = state.rstrip("/"), sorted(set(months))
    path = {k: f"{state}/{k}" for k in KEPT}
    fresh = not all(path_exists(spark, p) for p in path.values())
    facts = {"bill_days": (bills, "calday"), "coupon_lines": (coupons, "date"), "traffic_days": (traffic, "date")}
    every = {}
    for k, (df, day) in facts.items():
        col = F.col(PART_COL) if PART_COL in df.columns else month_key(day)
        every[k] = months if not fresh else sorted(r[0] for r in df.select(col.alias("m")).distinct().collect() if r[0] is not None)   # a row a month
    others = _promos_changed(spark, promos, f"{state}/promos_digest")

    again = set(every["coupon_lines"])
    if not fresh:
        if others:
            again |= set(_months_of(spark, path["coupon_lines"])) | {r[0] for r in coupons.select(month_key("date")).distinct().collect() if r[0] is not None}
        else:
            # bills of these months as they were, and as they are: coupons of theirs in other months
            numbers = (_of(read_table(spark, path["bill_days"]), months, "calday").select("billnum")
                       .union(_of(bills, months, "calday").select("billnum")).distinct())
            far = coupons.where(in_ranges("billnum", key_ranges(numbers, "billnum", RANGES))).join(numbers, "billnum", "left_semi")
            again |= {r[0] for r in far.select(month_key("date")).distinct().collect() if r[0] is not None}

    _exchange(spark, RM.bill_days(_of(bills, every["bill_days"], "calday")), path["bill_days"], every["bill_days"], "calday")
    lines = RM.coupon_lines(_of(coupons, again, "date"), promos, bills, 0 if fresh else RANGES).distinct()
    _exchange(spark, lines, path["coupon_lines"], sorted(again), "date")
    _exchange(spark, RM.traffic_days(_of(traffic, every["traffic_days"], "date")), path["traffic_days"], every["traffic_days"], "date")
    return {"bill_days": every["bill_days"], "coupon_lines": sorted(again), "traffic_days": every["traffic_days"]}


def report(spark: SparkSession, state: str, stores: DataFrame, start: str, end: str, interval: int = 2,
           modes: Iterable[str] = ("month_interval",), cumulative: bool = True,
           log: Callable[[str, str], None] | None = None) -> DataFrame:
    """The store report (``report_mart.report_mart``) from the state."""
    windows = RM.report_windows(start, end, interval, tuple(modes), cumulative, log)
    if not windows:
        return RM.assemble(stores, stores, stores, stores, windows)
    bd, cd, td = (RM.within(read_table(spark, f"{state.rstrip('/')}/{k}"), windows, day)
                  for k, day in (("bill_days", "calday"), ("coupon_lines", "date"), ("traffic_days", "date")))
    return RM.assemble(stores, bd, cd, td, windows)
