"""Per-store KPI report (turnover, coupon discounts, traffic, conversion, average bill)
over day or month windows.

All windows of one call are computed in ONE job. Bills are scanned once for their sums and
their count: one aggregate by (plant, bill, day). Every fact comes down to (plant, day) grain
with map-side combine before windows are attached. Windows that share their start (the
cumulative default) are running totals per plant over the days' first window ends, and distinct
bills and coupon rows count on their first day; other windows meet the facts by day, in a join
with the windows' days, never in a test of every window on every row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martspark.functions import add_months_py, exact_div, months_between_whole, prune_months, to_int8, to_numeric
from martspark.operators.ranges import in_ranges, key_ranges

# The selection modes, the promo type whose discount is an amount,
# the report table prefix and the input-check messages.
MODES = ("daily", "day_interval", "monthly", "month_interval")
AMOUNT_PROMO_TYPE = "001"
REPORT_PREFIX = "report_"
MSG_NO_MODES = "Parameters for p_selection_modes not provided"
MSG_BAD_MODE = "Invalid value detected in p_selection_modes"
MSG_BAD_DATE = "Date {} - {} doesn't match the required format. Check your input"

REPORT_COLUMNS = (
    "report_name", "plant", "txt", "turnover", "coupon_discount", "turnover_with_discount",
    "material_qty", "bills_qty", "traffic", "matdisc_qty", "matdisc_percent", "avg_mat_qty",
    "conversion_rate", "avg_bill", "avg_profit")


@dataclass(frozen=True)
class ReportWindow:
    report_name: str
    start: dt.date
    end: dt.date  # exclusive


class ReportInputError(ValueError):
    pass


def _parse(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y%m%d").date()


def report_windows(start: str, end: str, interval: int = 2,
                   modes: Sequence[str] | None = ("month_interval",),
                   cumulative: bool = True,
                   log: Callable[[str, str], None] | None = None) -> list[ReportWindow]:
    """Windows and table names for the selection modes (validated before any job runs).

    Every window starts at ``start`` (period-to-date) unless ``cumulative=False``.
    A later mode that yields an existing name replaces it.
    """
    def fail(msg: str):
        if log:
            log("ERROR", msg)
        raise ReportInputError(msg)

    if not modes:
        fail(MSG_NO_MODES)
    for m in modes:
        if m not in MODES:
            fail(MSG_BAD_MODE)
    try:
        d0, d1 = _parse(start), _parse(end)
    except (TypeError, ValueError):
        fail(MSG_BAD_DATE.format(start, end))

    out: dict[str, ReportWindow] = {}

    def put(name: str, ws: dt.date, we: dt.date):
        out.pop(name, None)
        out[name] = ReportWindow(REPORT_PREFIX + name, ws, we)

    for m in modes:
        if m == "daily":
            for i in range(1, (d1 - d0).days + 1):
                prev, cur = d0 + dt.timedelta(days=i - 1), d0 + dt.timedelta(days=i)
                put(prev.strftime("%Y%m%d"), d0 if cumulative else prev, cur)
        elif m == "day_interval":
            e = d0 + dt.timedelta(days=interval)
            put(f"{d0:%Y%m%d}_{e:%Y%m%d}", d0, e)
        elif m == "monthly":
            n = months_between_whole(d1 + dt.timedelta(days=1), d0)
            for i in range(1, n + 1):
                prev, cur = add_months_py(d0, i - 1), add_months_py(d0, i)
                put(prev.strftime("%Y%m"), d0 if cumulative else prev, cur)
        else:  # month_interval
            e = add_months_py(d0, interval)
            put(f"{d0:%Y%m}_{e + dt.timedelta(days=1):%Y%m}", d0, e)
    return list(out.values())


def _window_array(windows: Sequence[ReportWindow]) -> Column:
    return F.array(*[
        F.struct(F.lit(w.report_name).alias("report_name"), F.lit(w.start).alias("ws"),
                 F.lit(w.end).alias("we")) for w in windows])


def _window_days(spark: SparkSession, windows: Sequence[ReportWindow]) -> DataFrame:
    """(day, report_name) of every day of every window; bounded by the parameters."""
    w = spark.range(1).select(F.explode(_window_array(windows)).alias("w"))
    return w.select(F.explode(F.sequence("w.ws", F.date_sub("w.we", 1))).alias("_day"), "w.report_name")


def _running(df: DataFrame, day: str, cols: Sequence[str], windows: Sequence[ReportWindow]) -> DataFrame:
    """Sums of the additive ``cols`` of a (plant, day) frame per (window, plant), for windows
    with one start; a (window, plant) appears only when it has rows.

    Each day goes to the first window end after it; a window is the running total of these
    buckets up to its end, so a bucket's total holds for all ends up to the plant's next bucket.
    One aggregate and one pass per plant over at most one row per window end.
    """
    ends = sorted({w.end for w in windows})
    names = F.array(*[F.array(*[F.lit(w.report_name) for w in windows if w.end == e]) for e in ends])
    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col(day)))
    agg = df.groupBy("plant", bucket.alias("_k")).agg(*[F.sum(c).alias(c) for c in cols])
    along = Window.partitionBy("plant").orderBy("_k")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.coalesce(F.lead("_k").over(along) - 1, F.lit(len(ends) - 1))
    cum = agg.select("plant", F.col("_k"), last.alias("_last"), *[F.sum(c).over(upto).alias(c) for c in cols])
    return (cum.select("plant", F.explode(F.flatten(F.transform(F.sequence("_k", "_last"), lambda k: names[k]))).alias("report_name"), *cols)
               .select("report_name", "plant", *cols))


def _by_day(df: DataFrame, day: str, days: DataFrame) -> DataFrame:
    """A row of ``df`` for each window that holds its day, with the window's report_name."""
    return df.join(days, df[day] == days["_day"]).drop("_day")


def coupon_discount_expr(rpa_sat: Column, qty: Column, promo_type: Column, amount: Column) -> Column:
    """Amount promos give the amount; others give ``rpa_sat / qty * amount / 100``.

    Written as one division (12 fractional digits kept) so no intermediate rounding
    loses precision before the sum.
    """
    pct = (rpa_sat.cast(DecimalType(17, 2)) * amount.cast(DecimalType(10, 0))) / \
        (qty * 100).cast(DecimalType(19, 0))
    return F.when(promo_type == AMOUNT_PROMO_TYPE, amount.cast(DecimalType(20, 0))).otherwise(pct)


def bill_days(bills: DataFrame) -> DataFrame:
    """Sums of each bill's days: (plant, billnum, calday, turnover, quant)."""
    return bills.groupBy("plant", "billnum", "calday").agg(F.sum("rpa_sat").alias("turnover"), F.sum("qty").alias("quant"))


COUPON_KEY = ["billnum", "coupon_num", "material", "plant", "promo_type", "discount_amount", "coupon_discount"]


def coupon_lines(coupons: DataFrame, promos: DataFrame, bills: DataFrame, ranges: int = 0) -> DataFrame:
    """Coupons with their discount on each line of their bill: ``COUPON_KEY`` and date. With
    ``ranges`` the bills are read in so many ranges of the coupons' bill numbers only (found
    first, in a job of its own): for stored bills, whose row groups between these are skipped."""
    c = coupons.select("billnum", "coupon_num", "material", "plant", "promo_id", "date")
    p = promos.select("material", "promo_id", "promo_type", "discount_amount")
    if ranges:
        bills = bills.where(in_ranges("billnum", key_ranges(c, "billnum", ranges)))
    bi = bills.select("billnum", "material", "rpa_sat", "qty")
    return (c.join(p, ["material", "promo_id"]).join(bi, ["billnum", "material"])
             .select("billnum", "coupon_num", "material", "plant", "promo_type", "discount_amount", "date",
                     coupon_discount_expr(F.col("rpa_sat"), F.col("qty"), F.col("promo_type"),
                                          F.col("discount_amount")).alias("coupon_discount")))


def traffic_days(traffic: DataFrame) -> DataFrame:
    """Visitors of each store's days: (plant, date, t_qty)."""
    return traffic.groupBy("plant", "date").agg(F.sum("quantity").alias("t_qty"))


def build_report(stores: DataFrame, bills: DataFrame, coupons: DataFrame, promos: DataFrame,
                 traffic: DataFrame, windows: Sequence[ReportWindow], ranges: int = 0) -> DataFrame:
    """Report rows for every (window, store); see module doc for the plan shape."""
    if not windows:
        return _no_report(stores.sparkSession)
    c = within(coupons, windows, "date")
    return assemble(stores, bill_days(within(bills, windows, "calday")), coupon_lines(c, promos, bills, ranges),
                    traffic_days(within(traffic, windows, "date")), windows)


def _no_report(spark: SparkSession) -> DataFrame:
    """E.g. a daily run whose end equals its start: no report rows."""
    from martspark.sources.schemas import SCHEMAS
    from pyspark.sql.types import StringType, StructField, StructType
    return spark.createDataFrame([], StructType([StructField("report_name", StringType(), True)] + list(SCHEMAS["report"].fields)))


def within(df: DataFrame, windows: Sequence[ReportWindow], day: str) -> DataFrame:
    """The rows from the first window's start to the last one's end, months pruned."""
    lo, hi = min(w.start for w in windows), max(w.end for w in windows)
    return prune_months(df, lo, hi).where((F.col(day) >= F.lit(lo)) & (F.col(day) < F.lit(hi)))


def assemble(stores: DataFrame, bd: DataFrame, cd: DataFrame, tday: DataFrame, windows: Sequence[ReportWindow]) -> DataFrame:
    """The report from its day-grain parts (``bill_days``, ``coupon_lines``, ``traffic_days``) of
    the windows' days."""
    spark = stores.sparkSession
    if not windows:
        return _no_report(spark)
    lo = min(w.start for w in windows)
    shared_start = all(w.start == lo for w in windows)
    arr = _window_array(windows)
    days = None if shared_start else _window_days(spark, windows)

    # ---- bills ----
    if shared_start:
        # a bill counts on its first day; count(DISTINCT billnum) does not count a NULL number
        own = bd.groupBy("plant", "billnum").agg(F.array_sort(F.collect_list(F.struct("calday", "turnover", "quant"))).alias("own"))
        per_day = (own.select("plant", "billnum", F.posexplode("own").alias("nth", "x"))
                      .select("plant", "x.*", ((F.col("nth") == 0) & F.col("billnum").isNotNull()).cast("bigint").alias("bill_qty"))
                      .groupBy("plant", "calday").agg(*[F.sum(c).alias(c) for c in ("turnover", "quant", "bill_qty")]))
        st = _running(per_day, "calday", ["turnover", "quant", "bill_qty"], windows)
    else:
        st = (_by_day(bd, "calday", days).groupBy("report_name", "plant", "billnum")
              .agg(F.sum("turnover").alias("turnover"), F.sum("quant").alias("quant"))
              .groupBy("report_name", "plant").agg(F.sum("turnover").alias("turnover"), F.sum("quant").alias("quant"),
                                                   F.count("billnum").alias("bill_qty")))

    # ---- coupons: distinct coupon rows with their discount ----
    if shared_start:
        firsts = cd.groupBy(*COUPON_KEY).agg(F.min("date").alias("d"))
        per_day = firsts.groupBy("plant", "d").agg(F.sum("coupon_discount").alias("sum_disc"),
                                                   F.count("material").alias("matdisc_qty"))
        sd = _running(per_day, "d", ["sum_disc", "matdisc_qty"], windows)
    else:
        sd = (_by_day(cd, "date", days).select("report_name", *COUPON_KEY).distinct()
              .groupBy("report_name", "plant")
              .agg(F.sum("coupon_discount").alias("sum_disc"), F.count("material").alias("matdisc_qty")))

    # ---- traffic ----
    tr = (_running(tday, "date", ["t_qty"], windows) if shared_start else
          _by_day(tday, "date", days).groupBy("report_name", "plant").agg(F.sum("t_qty").alias("t_qty")))

    # ---- stores x windows, then the three left joins ----
    s = stores.select(F.explode(F.transform(arr, lambda w: w["report_name"])).alias("report_name"), "plant", "txt")
    s, st, sd, tr = s.alias("s"), st.alias("st"), sd.alias("sd"), tr.alias("tr")
    j = (s.join(st, (F.col("s.report_name") == F.col("st.report_name")) & (F.col("s.plant") == F.col("st.plant")), "left")
          .join(sd, (F.col("s.report_name") == F.col("sd.report_name")) & (F.col("s.plant") == F.col("sd.plant")), "left")
          # traffic is matched on the turnover side's plant: no bills -> no traffic
          .join(tr, (F.col("s.report_name") == F.col("tr.report_name")) & (F.col("st.plant") == F.col("tr.plant")), "left"))

    turn, quant, nb = F.col("st.turnover"), F.col("st.quant"), F.col("st.bill_qty")
    disc, ndisc, tq = F.col("sd.sum_disc"), F.col("sd.matdisc_qty"), F.col("tr.t_qty")
    zero = F.lit(0)
    return j.select(
        F.col("s.report_name").alias("report_name"),
        F.col("s.plant").alias("plant"),
        F.col("s.txt").alias("txt"),
        to_int8(F.coalesce(turn, zero)).alias("turnover"),
        to_numeric(F.coalesce(disc, zero), 17, 2).alias("coupon_discount"),
        to_numeric(F.coalesce(turn - disc, zero), 17, 2).alias("turnover_with_discount"),
        F.coalesce(quant, zero).cast("bigint").alias("material_qty"),
        F.coalesce(nb, zero).cast("bigint").alias("bills_qty"),
        F.coalesce(tq, zero).cast("bigint").alias("traffic"),
        F.coalesce(ndisc, zero).cast("bigint").alias("matdisc_qty"),
        to_numeric(F.coalesce(exact_div(ndisc * 100, quant, 1), zero), 17, 1).alias("matdisc_percent"),
        to_numeric(F.coalesce(exact_div(quant, nb, 2), zero), 17, 2).alias("avg_mat_qty"),
        to_numeric(F.coalesce(exact_div(nb * 100, tq, 2), zero), 17, 2).alias("conversion_rate"),
        to_numeric(F.coalesce(exact_div(turn, nb, 1), zero), 17, 1).alias("avg_bill"),
        to_numeric(F.coalesce(exact_div(turn, tq, 2), zero), 17, 2).alias("avg_profit"),
    )


def report_mart(tables, start: str, end: str, interval: int = 2,
                modes: Iterable[str] = ("month_interval",), cumulative: bool = True,
                log: Callable[[str, str], None] | None = None, ranges: int = 0) -> DataFrame:
    """``build_report`` over a ``RetailTables``-like object (stores, bills, coupons, promos, traffic)."""
    windows = report_windows(start, end, interval, tuple(modes), cumulative, log)
    return build_report(tables.stores, tables.bills, tables.coupons, tables.promos, tables.traffic, windows, ranges)
