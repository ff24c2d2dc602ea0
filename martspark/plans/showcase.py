"""Scalar-function, predicate, ordering and string-aggregate usages of the warehouse
scripts, applied to whole tables (one scan each, JVM-side built-ins only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.functions import split_qualified_name, to_char_digits, unify_name


def predicates(sales: DataFrame) -> DataFrame:
    """Rows matching each predicate form, from ONE scan (conditional counts, then an
    unpivot of the single result row)."""
    preds = {
        "in_list": F.col("distr_chan").isin(1, 2),
        "not_in_list": ~F.col("distr_chan").isin(1, 2),
        "like_prefix": F.col("region").like("A%"),
        "is_null": F.col("material").isNull(),
        "is_not_null": F.col("material").isNotNull(),
        "is_true": F.coalesce(F.col("quantity") > 25, F.lit(False)),
        "any_array": F.array_contains(F.array(F.lit("1"), F.lit("5")), F.col("distr_chan").cast("string")),
        "and_or_not": ((F.col("distr_chan") == 1) | (F.col("distr_chan") == 2)) & ~(F.col("quantity") < 10),
        "between_incl": F.col("date").between(F.lit("1996-01-01").cast("date"), F.lit("1996-01-31").cast("date")),
    }
    row = sales.agg(*[F.count_if(c).alias(k) for k, c in preds.items()])
    stack = "stack({n}, {pairs}) as (predicate, rows)".format(
        n=len(preds), pairs=", ".join(f"'{k}', {k}" for k in preds))
    return row.selectExpr(stack)


def text_functions(part: DataFrame) -> DataFrame:
    n, b, t = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return part.select(
        "p_partkey",
        F.upper(n).alias("name_upper"),
        F.lower(t).alias("type_lower"),
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("name_trim"),
        F.translate(b, "#", "").alias("brand_translate"),
        F.replace(b, F.lit("Brand#"), F.lit("B-")).alias("brand_replace"),
        F.left(t, F.lit(3)).alias("type_left"),
        F.right(b, F.lit(2)).alias("brand_right"),
        F.instr(n, " ").alias("name_space_pos"),
        F.length(n).alias("name_length"),
        F.concat(b, F.lit("|"), t).alias("brand_type"),
        F.size(F.split(n, " ")).alias("name_words"),
        F.array_join(F.split(n, " "), ",").alias("name_words_joined"),
        F.element_at(F.split(n, " "), 1).alias("name_first_word"),
        to_char_digits("p_partkey", 9).alias("key_to_char"))


def unified_names(part: DataFrame) -> DataFrame:
    """Name hygiene (drop ; / ' , trim, lower) on a qualified text built per part."""
    raw = F.concat(F.lit(" "), F.col("p_brand"), F.lit("/;"), F.col("p_type"), F.lit("'. "), F.col("p_name"), F.lit(" "))
    return part.select("p_partkey", unify_name(raw).alias("unified_name"))


def qualified_names(part: DataFrame) -> DataFrame:
    """Split ``schema.table`` names (here ``type.name``) into their two parts."""
    q = F.lower(F.concat(F.col("p_type"), F.lit("."), F.translate(F.col("p_name"), " ", "_")))
    schema, table = split_qualified_name(q)
    return part.select("p_partkey", q.alias("qualified_name"), schema.alias("schema_name"),
                       table.alias("table_name"),
                       F.concat(F.lit("stg_"), schema, F.lit(".delta_"), table).alias("staging_name"))


def date_formats(orders: DataFrame) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    ymd = F.date_format(d, "yyyyMMdd")
    return orders.select(
        "o_orderkey",
        F.date_format(d, "yyyyMM").alias("yyyymm"),
        ymd.alias("yyyymmdd"),
        F.date_format(d, "dd.MM.yyyy").alias("ddmmyyyy"),
        F.to_date(ymd, "yyyyMMdd").alias("parsed"),
        F.trunc(d, "MM").alias("month_start"),
        F.trunc(d, "year").alias("year_start"),
        F.add_months(F.trunc(d, "MM"), 1).alias("next_month"),
        F.date_add(d, 4).alias("plus_4_days"),
        F.add_months(d, -3).alias("minus_3_months"),
        F.datediff(F.add_months(F.trunc(d, "MM"), 1), d).alias("days_to_month_end"),
        F.floor(F.months_between(F.lit("2002-01-01").cast("date"), F.trunc(d, "MM"))).cast("int").alias("months_to_2002"),
        to_char_digits(F.col("o_orderkey") - 7500, 9).alias("key_char9"))


def ordered_concat(nation: DataFrame, region: DataFrame) -> DataFrame:
    """``string_agg(n_name, ',' ORDER BY n_nationkey)`` per region (ordered listagg)."""
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return j.groupBy("r_name").agg(
        F.expr("listagg(n_name, ',') WITHIN GROUP (ORDER BY n_nationkey)").alias("nations"))


def limit_sorted(orders: DataFrame, n: int = 10) -> DataFrame:
    """Top-n orders by total price (ties broken by key): a per-partition top-k, not a sort."""
    return (orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
                  .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(n))


def join_one_key(sales: DataFrame, plan: DataFrame) -> DataFrame:
    """``SELECT s.date FROM sales s JOIN plan p ON p.date = s.date`` as the multiset of
    dates it returns: (date, pairs). Each side is counted per date first, so no pair is
    ever materialised."""
    sc = sales.groupBy("date").agg(F.count(F.lit(1)).alias("ns"))
    pc = plan.groupBy("date").agg(F.count(F.lit(1)).alias("np"))
    return sc.join(pc, "date").select("date", (F.col("ns") * F.col("np")).alias("pairs"))
