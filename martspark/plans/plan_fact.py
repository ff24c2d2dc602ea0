"""Sales marts: the trailing sales mart and the monthly plan/fact comparison.

Plan/fact avoids the many-to-many sales x plan join of the source: sales are first
combined to (region, date, channel) with their row count ``n`` and sum ``q``; a plan row
matched by n sales rows contributes ``quantity * n`` planned and ``q`` sold, which is
exactly what the row-level join would sum. The best-selling material per region is an
arg-max by join-back (ties give several rows), with no window over the facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.functions import add_months_py, prune_months
from martspark.operators.lookup import dictionary

PLAN_FACT_COLUMNS = ("region_code", "matdirec_code", "distr_chanel", "planned_quantity",
                     "real_quantity", "complete_percent", "mosteff_material")


def parse_month(month: str) -> dt.date:
    """'YYYYMM' -> first day of that month (raises on bad text)."""
    return dt.datetime.strptime(month, "%Y%m").date()


def sales_mart(sales: DataFrame, month: str) -> DataFrame:
    """Quantity and distinct receipts by region, material, channel over the inclusive
    window [month start - 3 months, month start]."""
    m = parse_month(month)
    lo = add_months_py(m, -3)
    return (prune_months(sales, lo, m).where(F.col("date").between(F.lit(lo), F.lit(m)))
                 .groupBy("region", "material", "distr_chan")
                 .agg(F.sum("quantity").alias("qnt"), F.count_distinct("check_nm").alias("chk_cnt")))


def plan_fact(sales: DataFrame, plan: DataFrame, month: str, wide: bool = False) -> DataFrame:
    """Planned vs sold quantity by (region, direction, channel) for one month, with the
    region's best-selling material. Both date bounds are inclusive, as in the source.

    The mart declares int4 quantities; a month sum beyond that range fails (ANSI), as an
    out-of-range assignment does in the source. ``wide=True`` keeps 64-bit sums."""
    start = parse_month(month)
    end = add_months_py(start, 1)
    s = prune_months(sales, start, end).where(F.col("date").between(F.lit(start), F.lit(end)))

    total = s.groupBy("region", "material").agg(F.sum("quantity").alias("quantity_day"))
    best_q = (total.groupBy("region").agg(F.max("quantity_day").alias("max_quantity"))
                   .withColumnRenamed("region", "max_region"))
    best = (total.join(best_q, (F.col("region") == F.col("max_region"))
                       & (F.col("quantity_day") == F.col("max_quantity")))
                 .select("region", F.col("material").alias("mosteff_material")))

    # the join to `total` only drops rows whose material or region is NULL
    s_key = (s.where(F.col("material").isNotNull() & F.col("region").isNotNull())
              .groupBy("region", "date", "distr_chan")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q")))
    p = prune_months(plan, start, end).where(F.col("date").between(F.lit(start), F.lit(end)))
    qic = (p.join(s_key, ["region", "date", "distr_chan"])
            .groupBy("region", "matdirec", "distr_chan")
            .agg(F.sum(F.col("quantity") * F.col("n")).alias("planned"), F.sum("q").alias("real")))
    qty_type = "bigint" if wide else "int"
    return (qic.join(best, "region")
               .select(F.col("region").alias("region_code"),
                       F.col("matdirec").alias("matdirec_code"),
                       F.col("distr_chan").alias("distr_chanel"),
                       F.col("planned").cast(qty_type).alias("planned_quantity"),
                       F.col("real").cast(qty_type).alias("real_quantity"),
                       F.expr("(real * 100) div planned").cast(qty_type).alias("complete_percent"),
                       "mosteff_material"))


def plan_fact_view(pf: DataFrame, product: DataFrame, price: DataFrame) -> DataFrame:
    """Mart joined to product and price on material. ``price`` is keyed by material,
    region and channel but joined on material only, so rows fan out; kept as is."""
    pr = product.select("material", "brand", "txt")
    pc = price.select(F.col("material").alias("pc_material"), "price")
    return (pf.join(pr, pf.mosteff_material == pr.material)
              .join(pc, pf.mosteff_material == pc.pc_material)
              .select(*PLAN_FACT_COLUMNS, "brand", "txt", "price"))


def plan_fact_view_sql(mart: str, product: str, price: str) -> str:
    """``plan_fact_view`` over catalog tables, for a view that outlives the session."""
    columns = ", ".join(f"p.{c}" for c in PLAN_FACT_COLUMNS)
    return (f"SELECT {columns}, pr.brand, pr.txt, pc.price FROM {mart} p "
            f"JOIN {product} pr ON p.mosteff_material = pr.material JOIN {price} pc ON pc.material = p.mosteff_material")


def plan_fact_lookup(pf: DataFrame, product: DataFrame, price: DataFrame) -> DataFrame:
    """The same view over key-value dictionaries: one product and one price per material."""
    pr = dictionary(product, "material", ["brand", "txt"])
    pc = dictionary(price, "material", ["price", "region", "distr_chan"]).select(
        F.col("material").alias("pc_material"), "price")
    return (pf.join(pr, pf.mosteff_material == pr.material)
              .join(pc, pf.mosteff_material == pc.pc_material)
              .select(*PLAN_FACT_COLUMNS, "brand", "txt", "price"))
