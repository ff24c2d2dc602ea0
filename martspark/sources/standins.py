"""The retail warehouse tables, derived from the driver's TPC-H-style parquet tables.

Every table here is a lazy DataFrame over the given parquet files, so its work grows
with them. Column names and types follow the source warehouse DDL (see FIXTURES.md):

  stores        plant, txt                               <- nation
  bills_head    billnum, plant, calday                   <- orders x customer
  bills_item    billnum, billitem, material, netval, tax, qty, rpa_sat <- lineitem
  bills         bills_item x bills_head (+ calmonth)
  coupons       plant, date, coupon_num, promo_id, material, billnum
                                                         <- lineitem(discount >= .05) x orders x customer x part
  promos        promo_id, promo_name, promo_type, material, discount_amount <- part
  traffic       plant, date, time, frame_id, quantity    <- events (dates moved back 28 years)
  sales         date, region, material, distr_chan, quantity, check_nm, check_pos
                                                         <- lineitem x orders x customer x nation x region
  plan          date, region, matdirec, quantity, distr_chan  <- sales x part, grouped
  product, price, region_dim, chanel                     <- part, sales, region, orders
  real_estate, inventory_parts, colors                   <- orders, lineitem, supplier
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed values of the stand-in mapping.
TRAFFIC_PLANTS = 25          # plant = user_id mod 25 (the 25 nations)
TRAFFIC_MONTH_SHIFT = -336   # events of 2024 become traffic of 1996 (28 years back)
COUPON_MIN_DISCOUNT = 0.05   # line items with at least this discount carry a coupon
PLAN_EXTRA = 5               # plan quantity = sold quantity + 5


class RetailTables:
    """Lazy stand-in tables over ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._schemas: dict[str, object] = {}

    def raw(self, name: str) -> DataFrame:
        """A driver table. Its parquet schema is read once by this object, which lives as long
        as the query that is being built."""
        path = f"{self.sf_dir}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    # ---------------- store-report mart ----------------
    @property
    def stores(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("string").alias("plant"), F.col("n_name").alias("txt"))

    @property
    def bills_head(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        return o.join(c, o.o_custkey == c.c_custkey).select(
            F.col("o_orderkey").alias("billnum"),
            F.col("c_nationkey").cast("string").alias("plant"),
            F.col("o_orderdate").cast("date").alias("calday"))

    @property
    def bills_item(self) -> DataFrame:
        li = self.raw("lineitem")
        rpa = F.col("l_extendedprice").cast(DecimalType(17, 2))
        netval = (rpa * (F.lit(1) - F.col("l_discount").cast(DecimalType(4, 2)))).cast(DecimalType(17, 2))
        return li.select(
            F.col("l_orderkey").alias("billnum"),
            F.col("l_linenumber").cast("bigint").alias("billitem"),
            F.col("l_partkey").alias("material"),
            netval.alias("netval"),
            (netval * F.col("l_tax").cast(DecimalType(4, 2))).cast(DecimalType(17, 2)).alias("tax"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            rpa.alias("rpa_sat"))

    @property
    def bills(self) -> DataFrame:
        i = self.bills_item
        h = self.bills_head
        return i.join(h, "billnum").select(
            "billnum", "billitem", "material", "plant", "calday",
            F.date_format("calday", "yyyyMM").alias("calmonth"),
            "rpa_sat", "qty", "netval", "tax")

    @property
    def coupons(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_discount").where(
            F.col("l_discount") >= COUPON_MIN_DISCOUNT)
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        p = self.raw("part").select("p_partkey", "p_brand")
        j = (li.join(o, li.l_orderkey == o.o_orderkey)
               .join(c, o.o_custkey == c.c_custkey)
               .join(p, li.l_partkey == p.p_partkey))
        return j.select(
            F.col("c_nationkey").cast("string").alias("plant"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("l_orderkey").cast("string").alias("coupon_num"),
            F.col("p_brand").alias("promo_id"),
            F.col("l_partkey").alias("material"),
            F.col("l_orderkey").alias("billnum"))

    @property
    def promos(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_brand").alias("promo_id"),
            F.col("p_name").alias("promo_name"),
            F.when(F.col("p_partkey") % 2 == 0, F.lit("001")).otherwise(F.lit("002")).alias("promo_type"),
            F.col("p_partkey").alias("material"),
            F.col("p_size").cast("bigint").alias("discount_amount"))

    def _traffic_cols(self, date_col):
        return [
            (F.col("user_id") % TRAFFIC_PLANTS).cast("string").alias("plant"),
            date_col.alias("date"),
            F.date_format("ts", "HHmmss").alias("time"),
            F.col("event_id").cast("string").alias("frame_id"),
            (F.lit(1) + F.col("event_id") % 7).cast("int").alias("quantity")]

    @property
    def traffic(self) -> DataFrame:
        d = F.add_months(F.col("ts").cast("date"), TRAFFIC_MONTH_SHIFT)
        return self.raw("events").select(*self._traffic_cols(d))

    @property
    def traffic_source(self) -> DataFrame:
        """The source-system form of traffic: the date is text ``DD.MM.YYYY``."""
        d = F.date_format(F.add_months(F.col("ts").cast("date"), TRAFFIC_MONTH_SHIFT), "dd.MM.yyyy")
        return self.raw("events").select(*self._traffic_cols(d))

    # ---------------- plan/fact mart ----------------
    def _sales_base(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        n = self.raw("nation").select("n_nationkey", "n_regionkey")
        r = self.raw("region").select("r_regionkey", "r_name")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                  .join(c, o.o_custkey == c.c_custkey)
                  .join(n, c.c_nationkey == n.n_nationkey)
                  .join(r, n.n_regionkey == r.r_regionkey))

    @staticmethod
    def _sales_cols():
        return [
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("r_name").alias("region"),
            F.col("l_partkey").cast("string").alias("material"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("distr_chan"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("o_orderkey").cast("string").alias("check_nm"),
            F.concat(F.col("o_orderkey").cast("string"), F.lit("-"),
                     F.col("l_linenumber").cast("string")).alias("check_pos")]

    @property
    def sales(self) -> DataFrame:
        return self._sales_base().select(*self._sales_cols())

    @property
    def plan(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_type")
        s = self._sales_base().join(p, F.col("l_partkey") == p.p_partkey)
        return (s.groupBy(F.col("o_orderdate").cast("date").alias("date"),
                          F.col("r_name").alias("region"),
                          F.col("p_type").alias("matdirec"),
                          F.substring("o_orderpriority", 1, 1).cast("int").alias("distr_chan"))
                 .agg((F.sum(F.col("l_quantity").cast("int")) + PLAN_EXTRA).cast("int").alias("quantity"))
                 .select("date", "region", "matdirec", "quantity", "distr_chan"))

    @property
    def product(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").cast("string").alias("material"),
            F.substring("p_type", 1, 10).alias("asgrp"),
            F.col("p_brand").alias("brand"),
            F.col("p_size").cast("string").alias("matcateg"),
            F.col("p_size").alias("matdirec"),
            F.col("p_name").alias("txt"))

    @property
    def price(self) -> DataFrame:
        """One price per (material, region, channel) that was sold; the price itself is
        the part's retail price, so it repeats across regions and channels."""
        keys = self.sales.select("material", "region", "distr_chan").distinct()
        p = self.raw("part").select(F.col("p_partkey").cast("string").alias("material"),
                                    F.col("p_retailprice").cast(DecimalType(8, 2)).alias("price"))
        return keys.join(p, "material").select("material", "region", "distr_chan", "price")

    @property
    def region_dim(self) -> DataFrame:
        return self.raw("region").select(F.col("r_name").alias("region"), F.col("r_name").alias("txt"))

    @property
    def chanel(self) -> DataFrame:
        return self.raw("orders").select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("distr_chan"),
            F.col("o_orderpriority").alias("txtsh")).distinct()

    # ---------------- query-rewrite exercises ----------------
    @property
    def real_estate(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_totalprice").cast(DecimalType(12, 2)).alias("sale_price"))

    @property
    def inventory_parts(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("inventory_id"),
            F.col("l_partkey").alias("part_num"),
            F.col("l_suppkey").alias("color_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_returnflag").alias("is_spare"))

    @property
    def colors(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
