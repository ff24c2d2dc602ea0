"""Registered queries: name -> (Spark builder over an sf dir, DuckDB oracle SQL or None).

Every query reads the driver tables through ``RetailTables`` so its work grows with
them. Oracles are written independently in DuckDB SQL over the same stand-ins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martspark import oracle as O
from martspark.operators import catalog, export, quality
from martspark.operators import loads as LD
from martspark.operators.lookup import dict_get, dictionary
from martspark.operators.merge import rank_merge, upsert_table
from martspark.operators.runlog import RunLog
from martspark.operators.tables import create_table, read_table
from martspark.plans import exercises as X
from martspark.plans import plan_fact as PF
from martspark.plans import report_mart as RM
from martspark.plans import report_state as RS
from martspark.plans import showcase as SC
from martspark.session import scratch_path
from martspark.sources.dispatch import read_source
from martspark.sources.files import read_csv, write_csv
from martspark.sources.schemas import SCHEMAS, I, L, S, _s
from martspark.sources.standins import RetailTables
from martspark.streaming import month_reload_stream

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def database(spark, name: str) -> tuple[str, str]:
    """A fresh folder and a catalog database of its own for a query's tables."""
    root = scratch_path(spark, name)
    db = f"q_{root.rsplit('/', 1)[-1].replace('-', '_')}"
    catalog.create_database(spark, db, f"{root}/_database")
    return root, db


def T(spark, sf_dir) -> RetailTables:
    return RetailTables(spark, sf_dir)


# ---------------------------------------------------------------- report mart
# Fixed run parameters, the same calls as the source's examples moved to 1996.
REPORT_RUNS = {
    "report_mart_month_interval": ("19960101", "19960228", 2, ("month_interval",)),
    "report_mart_monthly": ("19960101", "19960331", 2, ("monthly",)),
    "report_mart_daily": ("19960101", "19960105", 4, ("daily",)),
    "report_mart_day_interval": ("19960101", "19960105", 4, ("day_interval",)),
}


REPORT_RUNS_EXTRA = {
    # disjoint day windows (cumulative=False): rows are assigned to the windows holding them
    "report_mart_daily_disjoint": ("19960101", "19960108", 4, ("daily",), False),
    # all four modes in one call, computed in one pass
    "report_mart_all_modes": ("19960101", "19960131", 3, ("daily", "day_interval", "monthly", "month_interval"), True),
    # a month of daily period-to-date reports: 31 window ends
    "report_mart_daily_month": ("19960101", "19960201", 1, ("daily",), True),
}


def _report_query(args):
    def q(spark, sf_dir):
        return RM.report_mart(T(spark, sf_dir), *args)
    return q


for _name, _args in {**REPORT_RUNS, **REPORT_RUNS_EXTRA}.items():
    register(_name, O.report_sql(RM.report_windows(*_args[:5])))(_report_query(_args))


_EXPORT_ARGS = ("19960101", "19960228", 2, ("month_interval", "monthly"))


@register("report_export_plant_id", f"""
WITH rep AS ({O.report_sql(RM.report_windows(*_EXPORT_ARGS))})
SELECT report_name, CAST(row_number() OVER (PARTITION BY report_name ORDER BY plant) AS INTEGER) AS plant_id,
  plant, txt, CAST(turnover AS INTEGER) AS turnover, coupon_discount, turnover_with_discount,
  CAST(material_qty AS INTEGER) AS material_qty, CAST(bills_qty AS INTEGER) AS bills_qty,
  CAST(traffic AS INTEGER) AS traffic, CAST(matdisc_qty AS INTEGER) AS matdisc_qty,
  CAST(matdisc_percent AS DECIMAL(7,1)) AS matdisc_percent, CAST(avg_mat_qty AS DECIMAL(7,2)) AS avg_mat_qty,
  CAST(conversion_rate AS DECIMAL(7,2)) AS conversion_rate, CAST(avg_bill AS DECIMAL(7,1)) AS avg_bill,
  CAST({O.units_to_decimal(O.round_div_units(O.hi('avg_profit', 2), '10'), 1, 7)} AS DECIMAL(7,1)) AS avg_profit
FROM rep""")
def _report_export(spark, sf_dir):
    """Published to shards and read back from their root."""
    path = f"{scratch_path(spark, 'report_export')}/report"
    export.publish_sharded(export.export_frame(RM.report_mart(T(spark, sf_dir), *_EXPORT_ARGS)), path, 4)
    return read_table(spark, path)


@register("report_export_shard", f"""
SELECT plant_id, plant, turnover, bills_qty FROM (
  SELECT CAST(row_number() OVER (PARTITION BY report_name ORDER BY plant) AS INTEGER) AS plant_id, plant,
    CAST(turnover AS INTEGER) AS turnover, CAST(bills_qty AS INTEGER) AS bills_qty, report_name
  FROM ({O.report_sql(RM.report_windows(*_EXPORT_ARGS))})) WHERE plant_id = 7""")
def _report_export_shard(spark, sf_dir):
    """One store's rows of all published reports, from its shard."""
    root, db = database(spark, "report_export_shard")
    export.publish_shards(export.export_frame(RM.report_mart(T(spark, sf_dir), *_EXPORT_ARGS)), f"{db}.report", f"{root}/report", 4)
    return spark.table(f"{db}.report").where("plant_id = 7").select("plant_id", "plant", "turnover", "bills_qty")


@register("report_from_state", O.report_sql(RM.report_windows("19960101", "19960430", 4, ("month_interval", "monthly"))))
def _report_from_state(spark, sf_dir):
    """Facts stored by month, one month of them incomplete at first; its re-load refreshes the
    state of that month only, and the report is read from the state."""
    t, root = T(spark, sf_dir), scratch_path(spark, "report_state")
    days, late = {"bills": "calday", "coupons": "date", "traffic": "date"}, dt.date(1996, 2, 1)
    for name, day in days.items():
        df = getattr(t, name)
        df = df.where((F.col(day) >= F.lit(dt.date(1996, 1, 1))) & (F.col(day) < F.lit(dt.date(1996, 5, 1))))
        LD.load_full(df.where((F.trunc(day, "MM") != F.lit(late)) | (F.col("plant") < "2")), f"{root}/{name}", "pmonth", day)
    stored = lambda name: read_table(spark, f"{root}/{name}")
    refresh = lambda months: RS.refresh(spark, f"{root}/state", stored("bills"), stored("coupons"), t.promos, stored("traffic"), months)
    refresh([])
    for name, day in days.items():
        LD.load_delta_partitions(spark, getattr(t, name), f"{root}/{name}", day, "1996-02-01", "1996-02-29")
    read = refresh([late])
    if read["bill_days"] != [late] or read["traffic_days"] != [late]:
        raise AssertionError(f"read again: {read}")
    return RS.report(spark, f"{root}/state", t.stores, "19960101", "19960430", 4, ("month_interval", "monthly"))


# ---------------------------------------------------------------- plan/fact marts
PLAN_MONTH = "199601"
SALES_MART_MONTH = "199604"

register("sales_mart_trailing", O.with_tables("""
SELECT region, material, distr_chan, CAST(SUM(quantity) AS BIGINT) AS qnt,
       COUNT(DISTINCT check_nm) AS chk_cnt
FROM sales WHERE "date" BETWEEN DATE '1996-01-01' AND DATE '1996-04-01'
GROUP BY region, material, distr_chan""", "sales"))(
    lambda spark, sf: PF.sales_mart(T(spark, sf).sales, SALES_MART_MONTH))

_PLAN_FACT_SQL = """
, month_sales AS (
    SELECT * FROM sales WHERE "date" BETWEEN DATE '1996-01-01' AND DATE '1996-02-01')
, by_material AS (
    SELECT region, material, SUM(quantity) AS q FROM month_sales GROUP BY ALL)
, leaders AS (
    SELECT region, material FROM (
        SELECT region, material, RANK() OVER (PARTITION BY region ORDER BY q DESC) AS pos
        FROM by_material) r
    WHERE pos = 1)
, pairs AS (
    SELECT p.region, p.matdirec, p.distr_chan, p.quantity AS planned, s.quantity AS sold
    FROM plan p JOIN month_sales s
      ON s.region = p.region AND s."date" = p."date" AND s.distr_chan = p.distr_chan
    WHERE p."date" BETWEEN DATE '1996-01-01' AND DATE '1996-02-01'
      AND s.material IS NOT NULL)
, cmp AS (
    SELECT region, matdirec, distr_chan, SUM(planned) AS planned, SUM(sold) AS sold
    FROM pairs GROUP BY ALL)
, pf AS (
    SELECT cmp.region AS region_code, cmp.matdirec AS matdirec_code, cmp.distr_chan AS distr_chanel,
           CAST(cmp.planned AS INTEGER) AS planned_quantity, CAST(cmp.sold AS INTEGER) AS real_quantity,
           CAST((cmp.sold * 100) // cmp.planned AS INTEGER) AS complete_percent,
           l.material AS mosteff_material
    FROM cmp JOIN leaders l ON l.region = cmp.region)
"""


def _with_pf(body: str, *extra: str) -> str:
    return O.cte_head("sales", "plan", *extra) + _PLAN_FACT_SQL + body


register("plan_fact", _with_pf("SELECT * FROM pf"))(
    lambda spark, sf: PF.plan_fact(T(spark, sf).sales, T(spark, sf).plan, PLAN_MONTH))


@register("plan_fact_export", _with_pf("""
SELECT region_code, matdirec_code, CAST(distr_chanel AS BIGINT) AS distr_chanel, CAST(planned_quantity AS BIGINT) AS planned_quantity,
  CAST(real_quantity AS BIGINT) AS real_quantity, CAST(complete_percent AS BIGINT) AS complete_percent, mosteff_material FROM pf"""))
def _plan_fact_export(spark, sf):
    """The mart published to shards by completion, in order of the region, and read back."""
    t, path = T(spark, sf), f"{scratch_path(spark, 'plan_fact_export')}/plan_fact"
    export.publish_plan_fact(PF.plan_fact(t.sales, t.plan, PLAN_MONTH), path, 4)
    return read_table(spark, path)


@register("plan_fact_view_key", _with_pf("""
SELECT pr.brand, COUNT(*) AS rows, CAST(SUM(pf.real_quantity) AS BIGINT) AS real_quantity FROM pf
JOIN product pr ON pf.mosteff_material = pr.material
JOIN price pc ON pc.material = pf.mosteff_material
WHERE pf.region_code = 'ASIA' GROUP BY pr.brand""", "product", "price"))
def _plan_fact_view_key(spark, sf):
    """The stored mart queried by region through the catalog's view over stored tables."""
    t = T(spark, sf)
    root, db = database(spark, "plan_fact_view")
    for name, df in (("plan_fact", PF.plan_fact(t.sales, t.plan, PLAN_MONTH)), ("product", t.product), ("price", t.price)):
        LD.load_full(df, f"{root}/{name}")
        catalog.register(spark, f"{db}.{name}", f"{root}/{name}")
    catalog.create_view(spark, f"{db}.v_plan_fact", PF.plan_fact_view_sql(f"{db}.plan_fact", f"{db}.product", f"{db}.price"))
    return spark.sql(f"SELECT brand, COUNT(*) AS rows, SUM(real_quantity) AS real_quantity FROM {db}.v_plan_fact "
                     "WHERE region_code = 'ASIA' GROUP BY brand")


@register("plan_fact_view", _with_pf("""
SELECT pf.*, pr.brand, pr.txt, pc.price FROM pf
JOIN product pr ON pf.mosteff_material = pr.material
JOIN price pc ON pc.material = pf.mosteff_material""", "product", "price"))
def _plan_fact_view(spark, sf):
    t = T(spark, sf)
    return PF.plan_fact_view(PF.plan_fact(t.sales, t.plan, PLAN_MONTH), t.product, t.price)


@register("plan_fact_lookup", _with_pf("""
, pr AS (SELECT material, min(struct_pack(brand := brand, txt := txt)) AS v FROM product WHERE material IS NOT NULL GROUP BY material)
, pc AS (SELECT material, min(struct_pack(price := price, region := region, distr_chan := distr_chan)) AS v FROM price WHERE material IS NOT NULL GROUP BY material)
SELECT pf.*, pr.v.brand AS brand, pr.v.txt AS txt, pc.v.price AS price FROM pf
JOIN pr ON pf.mosteff_material = pr.material
JOIN pc ON pc.material = pf.mosteff_material""", "product", "price"))
def _plan_fact_lookup(spark, sf):
    t = T(spark, sf)
    return PF.plan_fact_lookup(PF.plan_fact(t.sales, t.plan, PLAN_MONTH), t.product, t.price)


@register("dict_lookup", O.with_tables("""
SELECT k.material, COALESCE(d.v.asgrp, '') AS asgrp, COALESCE(d.v.brand, '') AS brand
FROM (SELECT DISTINCT material FROM sales UNION SELECT DISTINCT material || '-x' FROM sales) k
LEFT JOIN (SELECT material, min(struct_pack(asgrp := asgrp, brand := brand)) AS v
           FROM product WHERE material IS NOT NULL GROUP BY material) d ON d.material = k.material""",
    "sales", "product"))
def _dict_lookup(spark, sf):
    t = T(spark, sf)
    sold = t.sales.select("material").distinct()
    keys = sold.union(sold.select(F.concat("material", F.lit("-x"))))     # half of them in no dictionary
    return dict_get(keys, "material", dictionary(t.product, "material", ["asgrp", "brand"]), "material",
                    ["asgrp", "brand"])


# ---------------------------------------------------------------- query-form exercises
YEAR = 1996
_INV = "SELECT inventory_id, part_num, color_id, quantity, is_spare FROM inventory_parts"

register("year_sum_trunc", O.with_tables(
    "SELECT CAST(SUM(sale_price) AS DECIMAL(18,2)) AS sum_sale_price FROM real_estate "
    "WHERE date_trunc('year', \"date\") = DATE '1996-01-01'", "real_estate"))(
    lambda spark, sf: X.year_sum_trunc(T(spark, sf).real_estate, YEAR))
register("year_sum_range", O.with_tables(
    "SELECT CAST(SUM(sale_price) AS DECIMAL(18,2)) AS sum_sale_price FROM real_estate "
    "WHERE \"date\" >= DATE '1996-01-01' AND \"date\" <= DATE '1996-12-31'", "real_estate"))(
    lambda spark, sf: X.year_sum_range(T(spark, sf).real_estate, YEAR))
register("semi_join_in", O.with_tables(
    _INV + " WHERE inventory_id IN (SELECT DISTINCT id FROM colors)", "inventory_parts", "colors"))(
    lambda spark, sf: X.semi_join_in(T(spark, sf).inventory_parts, T(spark, sf).colors))
register("join_distinct", O.with_tables(
    "SELECT inventory_id, part_num, color_id, quantity, is_spare FROM inventory_parts ip "
    "JOIN (SELECT DISTINCT id FROM colors) c ON ip.inventory_id = c.id", "inventory_parts", "colors"))(
    lambda spark, sf: X.join_distinct(T(spark, sf).inventory_parts, T(spark, sf).colors))
register("join_agg_pruned", O.with_tables(
    "SELECT c.id, CAST(SUM(ip.quantity) AS BIGINT) AS sum_quantity FROM colors c "
    "JOIN (SELECT color_id, quantity FROM inventory_parts) ip ON c.id = ip.color_id GROUP BY c.id",
    "inventory_parts", "colors"))(
    lambda spark, sf: X.join_agg_pruned(T(spark, sf).inventory_parts, T(spark, sf).colors))
register("join_agg_implicit", O.with_tables(
    "SELECT c.id, CAST(SUM(ip.quantity) AS BIGINT) AS sum_quantity FROM colors c, inventory_parts ip "
    "WHERE c.id = ip.color_id GROUP BY c.id", "inventory_parts", "colors"))(
    lambda spark, sf: X.join_agg_implicit(spark, T(spark, sf).inventory_parts, T(spark, sf).colors))
register("left_join_char_group", O.with_tables(
    "SELECT CAST(ip.inventory_id AS INTEGER) AS inventory_id, rtrim(substr(c.name, 1, 250)) AS name, "
    "rtrim(substr(ip.is_spare, 1, 1)) AS is_spare, CAST(SUM(ip.quantity) AS BIGINT) AS sum_quantity "
    "FROM inventory_parts ip LEFT JOIN colors c ON ip.color_id = c.id "
    "GROUP BY ip.inventory_id, c.name, ip.is_spare", "inventory_parts", "colors"))(
    lambda spark, sf: X.left_join_char_group(T(spark, sf).inventory_parts, T(spark, sf).colors))
register("join_one_key", O.with_tables(
    "SELECT s.\"date\", COUNT(*) AS pairs FROM sales s JOIN plan p ON p.\"date\" = s.\"date\" "
    "GROUP BY s.\"date\"", "sales", "plan"))(
    lambda spark, sf: SC.join_one_key(T(spark, sf).sales, T(spark, sf).plan))

# ---------------------------------------------------------------- predicates, functions
register("predicates", O.with_tables("""
SELECT 'in_list' AS predicate, COUNT(*) FILTER (WHERE distr_chan IN (1, 2)) AS rows FROM sales
UNION ALL SELECT 'not_in_list', COUNT(*) FILTER (WHERE distr_chan NOT IN (1, 2)) FROM sales
UNION ALL SELECT 'like_prefix', COUNT(*) FILTER (WHERE region LIKE 'A%') FROM sales
UNION ALL SELECT 'is_null', COUNT(*) FILTER (WHERE material IS NULL) FROM sales
UNION ALL SELECT 'is_not_null', COUNT(*) FILTER (WHERE material IS NOT NULL) FROM sales
UNION ALL SELECT 'is_true', COUNT(*) FILTER (WHERE (quantity > 25) IS TRUE) FROM sales
UNION ALL SELECT 'any_array', COUNT(*) FILTER (WHERE CAST(distr_chan AS VARCHAR) = ANY(['1', '5'])) FROM sales
UNION ALL SELECT 'and_or_not', COUNT(*) FILTER (WHERE (distr_chan = 1 OR distr_chan = 2) AND NOT (quantity < 10)) FROM sales
UNION ALL SELECT 'between_incl', COUNT(*) FILTER (WHERE "date" BETWEEN DATE '1996-01-01' AND DATE '1996-01-31') FROM sales
""", "sales"))(lambda spark, sf: SC.predicates(T(spark, sf).sales))

register("text_functions", """
SELECT p_partkey, upper(p_name) AS name_upper, lower(p_type) AS type_lower,
  trim('  ' || p_name || ' ') AS name_trim, translate(p_brand, '#', '') AS brand_translate,
  replace(p_brand, 'Brand#', 'B-') AS brand_replace, left(p_type, 3) AS type_left,
  right(p_brand, 2) AS brand_right, CAST(instr(p_name, ' ') AS INTEGER) AS name_space_pos,
  CAST(length(p_name) AS INTEGER) AS name_length, p_brand || '|' || p_type AS brand_type,
  CAST(len(string_split(p_name, ' ')) AS INTEGER) AS name_words,
  array_to_string(string_split(p_name, ' '), ',') AS name_words_joined,
  string_split(p_name, ' ')[1] AS name_first_word,
  CASE WHEN length(CAST(abs(p_partkey) AS VARCHAR)) > 9 THEN (CASE WHEN p_partkey < 0 THEN '-' ELSE ' ' END) || '#########'
       ELSE lpad((CASE WHEN p_partkey < 0 THEN '-' ELSE ' ' END) || CAST(abs(p_partkey) AS VARCHAR), 10, ' ') END AS key_to_char
FROM part""")(lambda spark, sf: SC.text_functions(T(spark, sf).raw("part")))

register("unify_name", """
SELECT p_partkey, lower(trim(translate(' ' || p_brand || '/;' || p_type || '''. ' || p_name || ' ', ';/''', ''))) AS unified_name
FROM part""")(lambda spark, sf: SC.unified_names(T(spark, sf).raw("part")))

register("qualified_name_split", """
WITH q AS (SELECT p_partkey, lower(p_type || '.' || replace(p_name, ' ', '_')) AS qn FROM part)
SELECT p_partkey, qn AS qualified_name,
  CASE WHEN instr(qn, '.') > 0 THEN substr(qn, 1, instr(qn, '.') - 1) ELSE substr(qn, 1, length(qn) - 1) END AS schema_name,
  substr(qn, instr(qn, '.') + 1) AS table_name,
  'stg_' || CASE WHEN instr(qn, '.') > 0 THEN substr(qn, 1, instr(qn, '.') - 1) ELSE substr(qn, 1, length(qn) - 1) END
    || '.delta_' || substr(qn, instr(qn, '.') + 1) AS staging_name
FROM q""")(lambda spark, sf: SC.qualified_names(T(spark, sf).raw("part")))

register("date_formats", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, strftime(d, '%Y%m') AS yyyymm, strftime(d, '%Y%m%d') AS yyyymmdd,
  strftime(d, '%d.%m.%Y') AS ddmmyyyy, CAST(strptime(strftime(d, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed,
  CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(date_trunc('year', d) AS DATE) AS year_start,
  CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS next_month,
  CAST(d + INTERVAL 4 DAY AS DATE) AS plus_4_days, CAST(d - INTERVAL 3 MONTH AS DATE) AS minus_3_months,
  CAST(date_diff('day', d, CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE)) AS INTEGER) AS days_to_month_end,
  CAST(date_diff('month', CAST(date_trunc('month', d) AS DATE), DATE '2002-01-01') AS INTEGER) AS months_to_2002,
  CASE WHEN length(CAST(abs(o_orderkey - 7500) AS VARCHAR)) > 9
       THEN (CASE WHEN o_orderkey - 7500 < 0 THEN '-' ELSE ' ' END) || '#########'
       ELSE lpad((CASE WHEN o_orderkey - 7500 < 0 THEN '-' ELSE ' ' END) || CAST(abs(o_orderkey - 7500) AS VARCHAR), 10, ' ')
  END AS key_char9
FROM o""")(lambda spark, sf: SC.date_formats(T(spark, sf).raw("orders")))

register("ordered_concat", """
SELECT r_name, string_agg(n_name, ',' ORDER BY n_nationkey) AS nations
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")(
    lambda spark, sf: SC.ordered_concat(T(spark, sf).raw("nation"), T(spark, sf).raw("region")))

register("limit_sorted", """
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")(
    lambda spark, sf: SC.limit_sorted(T(spark, sf).raw("orders")))

# ---------------------------------------------------------------- quality / metadata
SEGMENTS = 8


def _stored(spark, sf, name: str, partition_col: str | None = None, date_key: str | None = None) -> str:
    """A stand-in table loaded to a path of its own."""
    path = f"{scratch_path(spark, f'stored_{name}')}/{name}"
    LD.load_full(getattr(T(spark, sf), name), path, partition_col, date_key)
    return path


register("distribution_rows", O.with_tables(
    f"SELECT CAST(billnum % {SEGMENTS} AS INTEGER) AS segment, COUNT(*) AS rows FROM bills_head GROUP BY 1",
    "bills_head"))(lambda spark, sf: quality.rows_per_segment(T(spark, sf).bills_head, "billnum", SEGMENTS))
register("distribution_skew", O.with_tables(f"""
SELECT COUNT(*) AS segments, CAST(SUM(rows) AS BIGINT) AS rows,
  CAST(stddev_samp(rows) / avg(rows) * 100 AS DECIMAL(20,4)) AS skew_pct
FROM (SELECT billnum % {SEGMENTS} AS segment, COUNT(*) AS rows FROM bills_head GROUP BY 1) g""", "bills_head"))(
    lambda spark, sf: quality.skew_coefficient(quality.rows_per_segment(T(spark, sf).bills_head, "billnum", SEGMENTS)))
register("partition_bounds", O.with_tables("""
SELECT CAST(date_trunc('month', calday) AS DATE) AS partition_start,
  CAST(date_trunc('month', calday) + INTERVAL 1 MONTH AS DATE) AS partition_end,
  COUNT(*) AS rows, MIN(calday) AS min_date, MAX(calday) AS max_date
FROM bills_head GROUP BY 1, 2""", "bills_head"))(
    lambda spark, sf: quality.stored_partition_bounds(spark, _stored(spark, sf, "bills_head", "pmonth", "calday"), "calday"))
register("date_bounds", O.with_tables(
    'SELECT MIN("date") AS min_date, MAX("date") AS max_date, COUNT(*) AS rows FROM sales', "sales"))(
    lambda spark, sf: quality.stored_date_bounds(spark, _stored(spark, sf, "sales"), "date"))
HEAVY_PCT = 4
register("distribution_heavy_keys", O.with_tables(f"""
SELECT plant, COUNT(*) AS rows, CAST(CAST(COUNT(*) AS DOUBLE) * 100 / (SELECT COUNT(*) FROM bills) AS DECIMAL(7,4)) AS share_pct
FROM bills GROUP BY plant HAVING COUNT(*) * 100 >= {HEAVY_PCT} * (SELECT COUNT(*) FROM bills)""", "bills"))(
    lambda spark, sf: quality.heavy_keys(T(spark, sf).bills, "plant", HEAVY_PCT / 100))


# ---------------------------------------------------------------- loaders (write, read back)
# Each query writes under the shared scratch root (spark.checkpoint.dir) and returns the
# final table state; the oracle states that state in SQL.


INVENTORY_SCHEMA: StructType = _s(("inventory_id", L, True), ("part_num", L, True), ("color_id", L, True),
                                  ("quantity", I, True), ("is_spare", S, True))
COLORS_SCHEMA: StructType = _s(("id", L, True), ("name", S, True))
_PM = "CAST(date_trunc('month', {c}) AS DATE) AS pmonth"


@register("load_full", O.with_tables("SELECT * FROM bills_head", "bills_head"))
def _load_full(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "load_full")
    write_csv(t.bills_head, f"{root}/bills_head_csv")
    LD.load_full(read_source(spark, "csv", f"{root}/bills_head_csv", SCHEMAS["bills_head"]), f"{root}/bills_head")
    return read_table(spark, f"{root}/bills_head")


@register("load_full_filtered", O.with_tables(
    "SELECT * FROM bills_head WHERE calday < DATE '1997-01-01'", "bills_head"))
def _load_full_filtered(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "load_full_filtered")
    tgt = f"{root}/bills_head"
    LD.load_filtered(t.bills_head, tgt, "calday < DATE'1996-01-01'", truncate=True)
    LD.load_filtered(t.bills_head, tgt, (F.col("calday") >= F.lit("1996-01-01").cast("date"))
                     & (F.col("calday") < F.lit("1997-01-01").cast("date")))
    return read_table(spark, tgt)


@register("load_single_partition", O.with_tables(
    "SELECT *, DATE '1996-01-02' AS pmonth FROM sales "
    "WHERE \"date\" >= DATE '1996-01-02' AND \"date\" < DATE '1996-02-02'", "sales"))
def _load_single_partition(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "load_single_partition")
    tgt = f"{root}/sales"
    LD.load_full(t.sales, tgt, partition_col="pmonth", date_key="date", anchor_day=2)
    LD.load_single_partition(t.sales, tgt, "date", "1996-01-02", "1996-07-27")
    return read_table(spark, tgt)


_SECOND = "CAST(date_trunc('month', \"date\" - INTERVAL 1 DAY) + INTERVAL 1 DAY AS DATE)"


@register("load_delta_anchored", O.with_tables(f"""
SELECT s.*, {_SECOND} AS pmonth FROM sales s
WHERE distr_chan <> 5 OR ("date" >= DATE '1996-01-02' AND "date" < DATE '1996-04-02')""", "sales"))
def _load_delta_anchored(spark, sf):
    """Months that run from the 2nd to the 2nd: a table without one channel's rows gets them
    back for the months of the load."""
    t, root = T(spark, sf), scratch_path(spark, "load_delta_anchored")
    tgt = f"{root}/sales"
    LD.load_full(t.sales.where("distr_chan <> 5"), tgt, "pmonth", "date", anchor_day=2)
    LD.load_delta_partitions(spark, t.sales, tgt, "date", "1996-01-15", "1996-04-01", anchor_day=2)
    return read_table(spark, tgt)


_DELTA_WIN = "calday >= DATE '1996-01-01' AND calday < DATE '1996-05-01'"


@register("load_delta_partition", O.with_tables(f"""
SELECT *, {_PM.format(c='calday')} FROM bills_head
WHERE billnum IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND NOT ({_DELTA_WIN})
UNION ALL
SELECT *, {_PM.format(c='calday')} FROM bills_head WHERE {_DELTA_WIN}""", "bills_head"))
def _load_delta_partition(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "load_delta_partition")
    tgt = f"{root}/bills_head"
    finished = t.raw("orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("billnum"))
    LD.load_full(t.bills_head.join(finished, "billnum", "left_semi"), tgt, "pmonth", "calday")
    LD.load_delta_partitions(spark, t.bills_head, tgt, "calday", "1996-01-15", "1996-04-10")
    return read_table(spark, tgt)


@register("load_delta_text_dates", O.with_tables(
    f"SELECT *, {_PM.format(c='\"date\"')} FROM traffic "
    "WHERE \"date\" >= DATE '1996-01-01' AND \"date\" < DATE '1996-02-01'", "traffic"))
def _load_delta_text_dates(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "load_delta_text_dates")
    write_csv(t.traffic_source, f"{root}/traffic_csv")
    src = read_source(spark, "csv", f"{root}/traffic_csv", SCHEMAS["traffic_source"])
    LD.load_delta_partitions(spark, src, f"{root}/traffic", "date", "1996-01-01", "1996-01-31", convert=True)
    return read_table(spark, f"{root}/traffic")


@register("load_header_item", O.with_tables(
    f"SELECT *, {_PM.format(c='calday')} FROM bills "
    "WHERE calday >= DATE '1996-01-01' AND calday < DATE '1996-03-01'", "bills"))
def _load_header_item(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "load_header_item")
    LD.load_header_item(spark, t.bills_item, t.bills_head, f"{root}/bills", "1996-01-01", "1996-02-28",
                        key_range_pushdown=True)
    return read_table(spark, f"{root}/bills")


# The plan of one region and channel has no date: NULL keys, and a partition of NULL months.
_UNDATED = "region = 'ASIA' AND distr_chan = 5"
_REVISED_PLAN = ("SELECT \"date\", region, matdirec, quantity - 5 AS quantity, distr_chan FROM undated "
                 "WHERE (\"date\" >= DATE '1996-01-01' AND \"date\" < DATE '1996-02-01') OR (\"date\" IS NULL AND quantity > 50)")


def _undated_plan(t):
    return t.plan.withColumn("date", F.when(~F.expr(_UNDATED), F.col("date")))


def _revised_plan(t):
    d = F.col("date")
    return (_undated_plan(t).where(((d >= F.lit("1996-01-01").cast("date")) & (d < F.lit("1996-02-01").cast("date")))
                                   | (d.isNull() & (F.col("quantity") > 50)))
                            .withColumn("quantity", F.col("quantity") - 5))


_UPSERT_SQL = """
, undated AS (SELECT CASE WHEN NOT (region = 'ASIA' AND distr_chan = 5) THEN "date" END AS "date", region, matdirec, quantity, distr_chan FROM plan)
, src AS ({src})
SELECT p.*{pm} FROM undated p WHERE NOT EXISTS (SELECT 1 FROM src WHERE src."date" IS NOT DISTINCT FROM p."date")
UNION ALL SELECT src.*{pm2} FROM src"""


def _upsert_oracle(with_pm: bool) -> str:
    head = O.cte_head("plan")
    pm = (", " + _PM.format(c='p."date"')) if with_pm else ""
    pm2 = (", " + _PM.format(c='src."date"')) if with_pm else ""
    return head + _UPSERT_SQL.format(src=_REVISED_PLAN, pm=pm, pm2=pm2)


@register("upsert", _upsert_oracle(True))
def _upsert(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "upsert")
    tgt = f"{root}/plan"
    LD.load_full(_undated_plan(t), tgt, "pmonth", "date")
    upsert_table(spark, tgt, _revised_plan(t), ["date"], date_key="date")
    return read_table(spark, tgt)


register("rank_merge", _upsert_oracle(False))(
    lambda spark, sf: rank_merge(_undated_plan(T(spark, sf)), _revised_plan(T(spark, sf)), ["date"]))


_MISSING_SQL = """
, g AS (SELECT unnest(generate_series(date_trunc('month', MIN(calday)), TIMESTAMP '2002-03-01', INTERVAL 1 MONTH)) AS m FROM bills_head)
SELECT CAST(m AS DATE) AS partition_start, CAST(m + INTERVAL 1 MONTH AS DATE) AS partition_end FROM g"""


@register("missing_partitions", O.cte_head("bills_head") + _MISSING_SQL)
def _missing_partitions(spark, sf):
    """A typed table with a partition for each month of the stored dates gets the months up to a
    later date; the catalog lists them."""
    t = T(spark, sf)
    root, db = database(spark, "missing_partitions")
    b = quality.date_bounds(t.bills_head, "calday").first()
    n = catalog.create_month_table(spark, f"{db}.bills_head", SCHEMAS["bills_head"], f"{root}/bills_head",
                                   b["min_date"].replace(day=1), b["max_date"] + dt.timedelta(days=1))
    added = catalog.add_missing_months(spark, f"{db}.bills_head", "2002-03-15")
    months = catalog.month_partitions(spark, f"{db}.bills_head")
    if added < 1 or months.count() != n + added:
        raise AssertionError(f"{n} months, {added} added, {months.count()} listed")
    return months


_FEB = "calday >= DATE '1996-02-01' AND calday < DATE '1996-03-01'"


@register("partition_swap", O.with_tables(f"""
SELECT *, {_PM.format(c='calday')} FROM bills_head WHERE NOT ({_FEB})
UNION ALL
SELECT *, {_PM.format(c='calday')} FROM bills_head
WHERE {_FEB} AND billnum IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""", "bills_head"))
def _partition_swap(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "partition_swap")
    tgt = f"{root}/bills_head"
    LD.load_full(t.bills_head, tgt, "pmonth", "calday")
    open_orders = t.raw("orders").where(F.col("o_orderstatus") == "O").select(F.col("o_orderkey").alias("billnum"))
    staged = (t.bills_head.where((F.col("calday") >= F.lit("1996-02-01").cast("date"))
                                 & (F.col("calday") < F.lit("1996-03-01").cast("date")))
                          .join(open_orders, "billnum", "left_semi"))
    LD.partition_swap(spark, tgt, staged, "1996-02-01", "calday")
    return read_table(spark, tgt)


@register("catalog_exchange", O.with_tables(f"""
SELECT *, {_PM.format(c='calday')} FROM bills_head WHERE NOT ({_FEB}) AND calday < DATE '1996-07-01' AND calday >= DATE '1995-07-01'
UNION ALL
SELECT *, {_PM.format(c='calday')} FROM bills_head
WHERE {_FEB} AND billnum IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""", "bills_head"))
def _catalog_exchange(spark, sf):
    """A year of months loaded into a typed table of the catalog, one of them exchanged, read by name."""
    t = T(spark, sf)
    root, db = database(spark, "catalog_exchange")
    table = f"{db}.bills_head"
    catalog.create_month_table(spark, table, SCHEMAS["bills_head"], f"{root}/bills_head", "1995-07-01", "1996-07-01")
    catalog.load_delta(spark, table, t.bills_head, "calday", "1995-07-01", "1996-06-30")
    open_orders = t.raw("orders").where(F.col("o_orderstatus") == "O").select(F.col("o_orderkey").alias("billnum"))
    feb = ((F.col("calday") >= F.lit("1996-02-01").cast("date")) & (F.col("calday") < F.lit("1996-03-01").cast("date")))
    catalog.exchange_month(spark, table, t.bills_head.where(feb).join(open_orders, "billnum", "left_semi"), "1996-02-01", "calday")
    return spark.table(table)


@register("table_swap", O.with_tables(
    "SELECT * FROM bills_head WHERE calday >= DATE '1996-01-01' AND calday < DATE '1997-01-01'", "bills_head"))
def _table_swap(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "table_swap")
    tgt = f"{root}/bills_head"
    LD.load_full(t.bills_head, tgt)
    staged = LD.stage(spark, t.bills_head.where(F.year("calday") == 1996), tgt)
    LD.table_swap(spark, tgt, staged)
    return read_table(spark, tgt)


@register("insert_literals", O.with_tables("""
SELECT id, name FROM colors UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), 'none'), (-2, NULL)) v(id, name)""", "colors"))
def _insert_literals(spark, sf):
    """Literal rows appended to a table created empty with declared types and then loaded."""
    t, root = T(spark, sf), scratch_path(spark, "insert_literals")
    tgt = f"{root}/colors"
    create_table(spark, tgt, COLORS_SCHEMA)
    LD.load_filtered(t.colors, tgt)
    LD.insert_rows(spark, tgt, [(-1, "none"), (-2, None)], COLORS_SCHEMA)
    return read_table(spark, tgt)


_INV_ORACLE = O.with_tables("SELECT * FROM inventory_parts", "inventory_parts")


@register("csv_roundtrip_colon", _INV_ORACLE)
def _csv_colon(spark, sf):
    root = scratch_path(spark, "csv_colon")
    write_csv(T(spark, sf).inventory_parts, f"{root}/lineitem.csv", distribute_by="part_num", sep=":",
              header="false")
    return read_csv(spark, f"{root}/lineitem.csv", INVENTORY_SCHEMA, sep=":", header="false")


@register("csv_glob", _INV_ORACLE)
def _csv_glob(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "csv_glob")
    li = t.raw("lineitem")
    inv = t.inventory_parts.columns
    early = F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp")
    for i, cond in enumerate((early, ~early | F.col("l_shipdate").isNull()), 1):
        part = li.where(cond).select(
            F.col("l_suppkey").alias("inventory_id"), F.col("l_partkey").alias("part_num"),
            F.col("l_suppkey").alias("color_id"), F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_returnflag").alias("is_spare"))
        write_csv(part.select(*inv), f"{root}/lineitem{i}.csv", sep=":", header="false")
    return read_csv(spark, f"{root}/lineitem*.csv", INVENTORY_SCHEMA, sep=":", header="false")


@register("csv_reject_rows", _INV_ORACLE)
def _csv_reject(spark, sf):
    """Lines with a text for a number, and lines with a field too many, stand among the rows."""
    t, root = T(spark, sf), scratch_path(spark, "csv_reject")
    write_csv(t.inventory_parts, f"{root}/lineitem.csv", header="false")
    bad = t.raw("lineitem").where(F.col("l_linenumber") == 1).select(F.concat_ws(
        ";", "l_suppkey", "l_partkey", "l_suppkey",
        F.when(F.col("l_orderkey") % 2 == 0, F.lit("many")).otherwise(F.col("l_linenumber").cast("string")), "l_returnflag",
        F.when(F.col("l_orderkey") % 2 == 1, F.lit("surplus"))))
    bad.write.mode("append").text(f"{root}/lineitem.csv")
    n_bad = bad.count()
    source = read_source(spark, "csv", f"{root}/lineitem.csv", INVENTORY_SCHEMA, reject_limit=n_bad + 1, header="false")
    LD.load_full(source, f"{root}/inventory_parts")
    if source.check() != n_bad:
        raise AssertionError(f"{source.check()} of {n_bad} malformed rows were rejected")
    return read_table(spark, f"{root}/inventory_parts")


@register("csv_rejects_kept", """
SELECT l_suppkey || ';' || l_partkey || ';many' AS line, count(*) AS lines FROM lineitem WHERE l_linenumber = 2 GROUP BY 1""")
def _csv_rejects_kept(spark, sf):
    """The malformed lines of a load, as the table of rejects keeps them."""
    t, root = T(spark, sf), scratch_path(spark, "csv_rejects")
    li = t.raw("lineitem")
    good = li.where("l_linenumber <> 2").select(F.concat_ws(";", "l_suppkey", "l_partkey", F.col("l_linenumber").cast("string")).alias("value"))
    bad = li.where("l_linenumber = 2").select(F.concat_ws(";", "l_suppkey", "l_partkey", F.lit("many")).alias("value"))
    good.unionByName(bad).write.text(f"{root}/lines.csv")
    schema = _s(("supplier", L, True), ("part", L, True), ("line", I, True))
    n, rejected = LD.load_full_keeping_rejects(spark, f"{root}/lines.csv", schema, f"{root}/lines", f"{root}/rejects", None, header="false")
    if n != read_table(spark, f"{root}/lines").count():
        raise AssertionError(f"{n} rows loaded, {rejected} rejected")
    return read_table(spark, f"{root}/rejects").groupBy("line").agg(F.count(F.lit(1)).alias("lines"))


@register("csv_line_breaks", """
SELECT p_partkey, p_name || chr(10) || '"' || p_brand || '";' || chr(10) AS txt FROM part""")
def _csv_line_breaks(spark, sf):
    """Texts with line breaks, quotes and delimiters, written and read back."""
    t, root = T(spark, sf), scratch_path(spark, "csv_line_breaks")
    txt = F.concat(F.col("p_name"), F.lit("\n\""), F.col("p_brand"), F.lit('";\n'))
    write_csv(t.raw("part").select("p_partkey", txt.alias("txt")), f"{root}/part.csv", multi_line=True)
    return read_csv(spark, f"{root}/part.csv", _s(("p_partkey", L, True), ("txt", S, True)), multi_line=True)


@register("run_log", O.with_tables("""
SELECT 'INFO' AS log_type, 'Start load_full' AS log_msg, 'full load' AS log_location, false AS is_error
UNION ALL SELECT 'INFO', CAST(COUNT(*) AS VARCHAR) || ' rows inserted', 'full load', false FROM bills_head
UNION ALL SELECT 'INFO', 'End load_full', 'full load', false""", "bills_head"))
def _run_log(spark, sf):
    t, root = T(spark, sf), scratch_path(spark, "run_log")
    log = RunLog(spark, f"{root}/logs")
    log.write("info", "Start load_full", "Full Load")
    n = LD.load_full(t.bills_head, f"{root}/bills_head")
    log.write("INFO", f"{n} rows inserted", "Full Load")
    log.write("INFO", "End load_full", "FULL LOAD")
    return log.read().select("log_type", "log_msg", "log_location", "is_error")


# ---------------------------------------------------------------- streaming


@register("traffic_stream_reload", O.with_tables(
    f"SELECT *, {_PM.format(c='\"date\"')} FROM traffic", "traffic"))
def _traffic_stream(spark, sf):
    """Traffic extracts dropped as files are re-loaded month by month by a stream; the months
    are spread over two extracts, one file a batch."""
    t, root = T(spark, sf), scratch_path(spark, "traffic_stream")
    for i in range(2):
        write_csv(t.traffic_source.where(F.col("frame_id").cast("long") % 2 == i), f"{root}/drop/extract{i}")
    q = month_reload_stream(spark, f"{root}/drop/*", SCHEMAS["traffic_source"], f"{root}/traffic", "date",
                            f"{root}/checkpoint", convert=True, maxFilesPerTrigger=3)
    q.awaitTermination()
    return read_table(spark, f"{root}/traffic")


@register("partition_list", O.with_tables("""
SELECT DISTINCT CAST(date_trunc('month', calday) AS DATE) AS partition_start,
       CAST(date_trunc('month', calday) + INTERVAL 1 MONTH AS DATE) AS partition_end
FROM bills_head""", "bills_head"))
def _partition_list(spark, sf):
    """Load bill heads month-partitioned, then list the table's partitions from files."""
    t, root = T(spark, sf), scratch_path(spark, "partition_list")
    LD.load_full(t.bills_head, f"{root}/bills_head", "pmonth", "calday")
    return quality.table_partitions(spark, f"{root}/bills_head").select("partition_start", "partition_end")
