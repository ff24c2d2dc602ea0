"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``links`` (a, b: long): root is the smallest node reachable.

    Each round writes its links to the shared folder. A star's centre may have any number of
    neighbours: its rows meet its smallest neighbour in a join of two written tables, which Spark
    splits where a key is hot, and minima are taken before the shuffle.
    """
    edges = C.staged(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = C.staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = C.staged(large.filter("u != v"), "links")
        low = C.staged(large.groupBy("u").agg(F.min("v").alias("m")), "links")
        small = large.join(low, "u")
        edges = C.staged(small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                         .select("e.u", "e.v").filter("u != v").distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
