"""Ranges of a key, cut at its largest gaps: what one side of a join lets the other side skip.

One MIN/MAX range spans everything between a month's bills and a single late one. Several ranges
leave the gaps out; as ``key BETWEEN .. OR key BETWEEN ..`` they reach the scan, where row groups
that lie in a gap are skipped, or a JDBC source's WHERE clause.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 32         # at most; also the length of the pushed condition
NUMBERS = ("tinyint", "smallint", "int", "bigint", "date")


def key_ranges(df: DataFrame, key: str, ranges: int = RANGES) -> list[tuple]:
    """At most ``ranges`` disjoint ranges (lo, hi), rising, that hold all keys of ``df`` and leave
    out the largest gaps between them; none where every key is NULL. A key that is no whole number
    or date gets one range.

    Distributed: quantiles of the keys deal the distinct keys out in order, gaps are taken between
    neighbours within each share and between the shares' ends, and the largest are kept. The driver
    gets the quantiles and the largest gaps."""
    kind = dict(df.dtypes)[key]
    c = F.col(key).alias("k")
    if ranges < 2 or kind not in NUMBERS:
        lo, hi = df.agg(F.min(key), F.max(key)).first()
        return [] if lo is None else [(lo, hi)]
    shares = max(2, min(200, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    whole = F.unix_date(key) if kind == "date" else F.col(key).cast("bigint")
    lo, hi, cuts = df.agg(F.min(key), F.max(key), F.percentile_approx(whole, [i / shares for i in range(1, shares)])).first()
    if lo is None:
        return []
    keys = df.where(F.col(key).isNotNull()).select(c, whole.alias("n")).distinct()
    share = F.size(F.filter(F.array(*[F.lit(x).cast("bigint") for x in sorted(set(cuts))]), lambda x: x <= F.col("n")))
    keys = keys.withColumn("share", share)
    along = Window.partitionBy("share").orderBy("n")
    within = keys.select(F.lag("k").over(along).alias("lo"), F.col("k").alias("hi"), F.lag("n").over(along).alias("a"), F.col("n").alias("b"))
    ends = keys.groupBy("share").agg(F.min_by("k", "n").alias("k0"), F.max_by("k", "n").alias("k1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    next_to = Window.orderBy("share")           # a row a share
    between = ends.select(F.lag("k1").over(next_to).alias("lo"), F.col("k0").alias("hi"), F.lag("n1").over(next_to).alias("a"), F.col("n0").alias("b"))
    wide = (F.col("b").cast("decimal(20,0)") - F.col("a")).alias("wide")
    gaps = (within.unionByName(between).select("lo", "hi", "a", wide).where("wide > 1")
            .orderBy(F.desc("wide"), "a").limit(ranges - 1).collect())
    out, begin = [], lo
    for g in sorted(gaps, key=lambda g: g["lo"]):
        out.append((begin, g["lo"]))
        begin = g["hi"]
    return [*out, (begin, hi)]


def in_ranges(key: str, ranges: list[tuple], nulls: bool = False) -> Column:
    """Whether the key lies in one of the ranges; also where it is NULL with ``nulls``."""
    hit = F.col(key).isNull() if nulls else F.lit(False)
    for lo, hi in ranges:
        one = F.col(key) == F.lit(lo) if lo == hi else F.col(key).between(F.lit(lo), F.lit(hi))
        hit = one if not nulls and (lo, hi) == ranges[0] else hit | one
    return hit
