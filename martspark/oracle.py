"""Independent DuckDB SQL for the correctness gate.

The same stand-in tables as ``sources.standins`` written as DuckDB CTEs over the
driver's views, plus helpers for exact half-up decimal division: DuckDB turns DECIMAL
division into DOUBLE, so the oracle divides scaled HUGEINTs instead.
"""

from __future__ import annotations

STANDIN_SQL: dict[str, str] = {
    "stores": "SELECT CAST(n_nationkey AS VARCHAR) AS plant, n_name AS txt FROM nation",
    "bills_head": """SELECT o_orderkey AS billnum, CAST(c_nationkey AS VARCHAR) AS plant,
        CAST(o_orderdate AS DATE) AS calday
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "bills_item": """SELECT l_orderkey AS billnum, CAST(l_linenumber AS BIGINT) AS billitem,
        l_partkey AS material,
        CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(17,2)) AS netval,
        CAST(CAST(CAST(l_extendedprice AS DECIMAL(17,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(17,2))
             * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(17,2)) AS tax,
        CAST(l_quantity AS BIGINT) AS qty,
        CAST(l_extendedprice AS DECIMAL(17,2)) AS rpa_sat
        FROM lineitem""",
    "bills": """SELECT i.billnum, i.billitem, i.material, h.plant, h.calday,
        strftime(h.calday, '%Y%m') AS calmonth, i.rpa_sat, i.qty, i.netval, i.tax
        FROM bills_item i JOIN bills_head h ON i.billnum = h.billnum""",
    "coupons": """SELECT CAST(c_nationkey AS VARCHAR) AS plant, CAST(o_orderdate AS DATE) AS "date",
        CAST(l_orderkey AS VARCHAR) AS coupon_num, p_brand AS promo_id, l_partkey AS material,
        l_orderkey AS billnum
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
        WHERE l_discount >= 0.05""",
    "promos": """SELECT p_brand AS promo_id, p_name AS promo_name,
        CASE WHEN p_partkey % 2 = 0 THEN '001' ELSE '002' END AS promo_type,
        p_partkey AS material, CAST(p_size AS BIGINT) AS discount_amount FROM part""",
    "traffic": """SELECT CAST(user_id % 25 AS VARCHAR) AS plant,
        CAST(CAST(ts AS DATE) - INTERVAL 336 MONTH AS DATE) AS "date",
        strftime(ts, '%H%M%S') AS "time", CAST(event_id AS VARCHAR) AS frame_id,
        CAST(1 + event_id % 7 AS INTEGER) AS quantity FROM events""",
    "sales_base": """SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "sales": """SELECT CAST(o_orderdate AS DATE) AS "date", r_name AS region,
        CAST(l_partkey AS VARCHAR) AS material, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS distr_chan,
        CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderkey AS VARCHAR) AS check_nm,
        CAST(o_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS check_pos
        FROM sales_base""",
    "plan": """SELECT CAST(o_orderdate AS DATE) AS "date", r_name AS region, p_type AS matdirec,
        CAST(SUM(CAST(l_quantity AS INTEGER)) + 5 AS INTEGER) AS quantity,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS distr_chan
        FROM sales_base JOIN part ON l_partkey = p_partkey
        GROUP BY 1, 2, 3, 5""",
    "product": """SELECT CAST(p_partkey AS VARCHAR) AS material, substr(p_type, 1, 10) AS asgrp,
        p_brand AS brand, CAST(p_size AS VARCHAR) AS matcateg, p_size AS matdirec, p_name AS txt FROM part""",
    "price": """SELECT k.material, k.region, k.distr_chan, CAST(p_retailprice AS DECIMAL(8,2)) AS price
        FROM (SELECT DISTINCT material, region, distr_chan FROM sales) k
        JOIN part ON k.material = CAST(p_partkey AS VARCHAR)""",
    "region_dim": "SELECT r_name AS region, r_name AS txt FROM region",
    "chanel": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS distr_chan,
        o_orderpriority AS txtsh FROM orders""",
    "real_estate": """SELECT CAST(o_orderdate AS DATE) AS "date",
        CAST(o_totalprice AS DECIMAL(12,2)) AS sale_price FROM orders""",
    "inventory_parts": """SELECT l_suppkey AS inventory_id, l_partkey AS part_num, l_suppkey AS color_id,
        CAST(l_quantity AS INTEGER) AS quantity, l_returnflag AS is_spare FROM lineitem""",
    "colors": "SELECT s_suppkey AS id, s_name AS name FROM supplier",
}

STANDIN_DEPS: dict[str, tuple[str, ...]] = {
    "bills": ("bills_item", "bills_head"),
    "sales": ("sales_base",),
    "plan": ("sales_base",),
    "price": ("sales_base", "sales"),
}


def cte_head(*names: str) -> str:
    """``WITH <stand-ins needed>`` (no trailing query), for oracles that add more CTEs."""
    return with_tables("", *names).rstrip()


def with_tables(body: str, *names: str) -> str:
    """``WITH <stand-ins needed> <body>``; dependencies are pulled in first."""
    order: list[str] = []

    def add(n: str):
        for d in STANDIN_DEPS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({STANDIN_SQL[n]})" for n in order)
    return f"WITH {ctes}\n{body}" if ctes else body


def hi(expr: str, scale: int) -> str:
    """An exact decimal/integer expression as a HUGEINT count of 10^-scale units."""
    return f"CAST(({expr}) * {10 ** scale} AS HUGEINT)"


def round_div_units(num_units: str, den_units: str) -> str:
    """Half-away-from-zero integer division of two HUGEINT expressions."""
    return (f"(CASE WHEN ({num_units}) * ({den_units}) >= 0 THEN 1 ELSE -1 END) * "
            f"((2 * abs({num_units}) + abs({den_units})) // (2 * abs({den_units})))")


def units_to_decimal(units: str, scale: int, precision: int = 17) -> str:
    """HUGEINT units of 10^-scale back to DECIMAL(precision, scale), exactly."""
    if scale == 0:
        return f"CAST({units} AS DECIMAL({precision},0))"
    one = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({units} AS DECIMAL(38,0)) * CAST({one} AS DECIMAL({scale + 1},{scale})) AS DECIMAL({precision},{scale}))"


def exact_div(num: str, num_scale: int, den: str, den_scale: int, scale: int, precision: int = 17) -> str:
    """``num / den`` rounded half-up to DECIMAL(precision, scale); NULL if either is NULL."""
    n = f"{hi(num, num_scale)} * {10 ** (den_scale + scale)}"
    d = f"{hi(den, den_scale)} * {10 ** num_scale}"
    return units_to_decimal(round_div_units(n, d), scale, precision)


def windows_values(windows) -> str:
    rows = ", ".join(f"('{w.report_name}', DATE '{w.start}', DATE '{w.end}')" for w in windows)
    return f"SELECT * FROM (VALUES {rows}) AS v(report_name, ws, we)"


def report_sql(windows) -> str:
    """The store report computed per window by brute force: every fact row is joined to
    the windows containing its day, counted distinct where needed, and all money is
    carried as exact integer units (cents, or 1e-12 for coupon shares)."""
    share_units = ("CASE WHEN pr.promo_type = '001' THEN CAST(pr.discount_amount AS HUGEINT) * 1000000000000 "
                   "ELSE " + round_div_units(
                       "CAST(b.rpa_sat * 100 AS HUGEINT) * pr.discount_amount * 100000000",
                       "CAST(b.qty AS HUGEINT)") + " END")
    body = f"""
, w AS ({windows_values(windows)})
, coupon_lines AS (
    SELECT DISTINCT w.report_name, c.billnum, c.coupon_num, c.material, c.plant, pr.promo_type,
           pr.discount_amount, {share_units} AS share_u
    FROM coupons c
    JOIN promos pr USING (material, promo_id)
    JOIN bills b USING (billnum, material)
    JOIN w ON c."date" >= w.ws AND c."date" < w.we)
, store_disc AS (
    SELECT report_name, plant, SUM(share_u) AS share_u, COUNT(material) AS n_lines
    FROM coupon_lines GROUP BY ALL)
, store_visits AS (
    SELECT w.report_name, v.plant, SUM(v.quantity) AS visits
    FROM traffic v JOIN w ON v."date" >= w.ws AND v."date" < w.we GROUP BY ALL)
, store_sales AS (
    SELECT w.report_name, b.plant, SUM(b.rpa_sat) AS revenue, SUM(b.qty) AS units,
           COUNT(DISTINCT b.billnum) AS n_bills
    FROM bills b JOIN w ON b.calday >= w.ws AND b.calday < w.we GROUP BY ALL)
SELECT w.report_name, s.plant, s.txt,
  CAST(COALESCE({round_div_units(hi('ss.revenue', 2), '100')}, 0) AS BIGINT) AS turnover,
  CAST(COALESCE({units_to_decimal(round_div_units('sd.share_u', '10000000000'), 2)}, 0) AS DECIMAL(17,2)) AS coupon_discount,
  CAST(COALESCE({units_to_decimal(round_div_units(hi('ss.revenue', 12) + ' - sd.share_u', '10000000000'), 2)}, 0) AS DECIMAL(17,2)) AS turnover_with_discount,
  CAST(COALESCE(ss.units, 0) AS BIGINT) AS material_qty,
  CAST(COALESCE(ss.n_bills, 0) AS BIGINT) AS bills_qty,
  CAST(COALESCE(sv.visits, 0) AS BIGINT) AS traffic,
  CAST(COALESCE(sd.n_lines, 0) AS BIGINT) AS matdisc_qty,
  CAST(COALESCE({exact_div('sd.n_lines * 100', 0, 'ss.units', 0, 1)}, 0) AS DECIMAL(17,1)) AS matdisc_percent,
  CAST(COALESCE({exact_div('ss.units', 0, 'ss.n_bills', 0, 2)}, 0) AS DECIMAL(17,2)) AS avg_mat_qty,
  CAST(COALESCE({exact_div('ss.n_bills * 100', 0, 'sv.visits', 0, 2)}, 0) AS DECIMAL(17,2)) AS conversion_rate,
  CAST(COALESCE({exact_div('ss.revenue', 2, 'ss.n_bills', 0, 1)}, 0) AS DECIMAL(17,1)) AS avg_bill,
  CAST(COALESCE({exact_div('ss.revenue', 2, 'sv.visits', 0, 2)}, 0) AS DECIMAL(17,2)) AS avg_profit
FROM stores s CROSS JOIN w
LEFT JOIN store_sales ss ON ss.report_name = w.report_name AND ss.plant = s.plant
LEFT JOIN store_disc sd ON sd.report_name = w.report_name AND sd.plant = s.plant
LEFT JOIN store_visits sv ON sv.report_name = w.report_name AND sv.plant = ss.plant
"""
    return cte_head("stores", "bills", "coupons", "promos", "traffic") + body
