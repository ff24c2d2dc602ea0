import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martspark.functions import (add_months_py, bpchar, exact_div, months_between_whole,
                                 split_qualified_name, to_int8, unify_name)


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("num,den,scale,want", [
    (1, 8, 2, "0.13"), (35, 100, 1, "0.4"), (-25, 100, 1, "-0.3"), (2, 3, 2, "0.67"),
    (10, 4, 0, "3"), (1, 3, 1, "0.3")])
def test_exact_div_half_up(spark, num, den, scale, want):
    v = one(spark, exact_div(F.lit(num).cast("decimal(10,0)") if num % 1 == 0 else F.lit(num), F.lit(den), scale))
    assert v == Decimal(want)


def test_exact_div_cents(spark):
    # 0.35 / 1 must be 0.4, which a binary double would round to 0.3
    assert one(spark, exact_div(F.lit(Decimal("0.35")), F.lit(1), 1)) == Decimal("0.4")


def test_exact_div_null_and_zero(spark):
    assert one(spark, exact_div(F.lit(None).cast("bigint"), F.lit(3), 2)) is None
    with pytest.raises(Exception):
        one(spark, exact_div(F.lit(1), F.lit(0), 2))


@pytest.mark.parametrize("x,want", [("2.5", 3), ("-2.5", -3), ("2.49", 2), ("0.5", 1)])
def test_to_int8_rounds(spark, x, want):
    assert one(spark, to_int8(F.lit(Decimal(x)))) == want


def test_bpchar(spark):
    assert one(spark, bpchar(F.lit("abcdef"), 3)) == "abc"
    assert one(spark, bpchar(F.lit("ab  "), 4)) == "ab"


def test_unify_name(spark):
    assert one(spark, unify_name(F.lit(" My;Sch/ema'.T "))) == "myschema.t"


@pytest.mark.parametrize("name,schema,table", [("sch.tab", "sch", "tab"), ("a.b.c", "a", "b.c"), ("abc", "ab", "abc")])
def test_split_qualified_name(spark, name, schema, table):
    s, t = split_qualified_name(F.lit(name))
    r = spark.range(1).select(s.alias("s"), t.alias("t")).first()
    assert (r["s"], r["t"]) == (schema, table)


def test_month_arithmetic():
    assert add_months_py(dt.date(2021, 1, 31), 1) == dt.date(2021, 2, 28)
    assert add_months_py(dt.date(2020, 11, 1), 3) == dt.date(2021, 2, 1)
    assert months_between_whole(dt.date(2021, 3, 1), dt.date(2021, 1, 1)) == 2
    assert months_between_whole(dt.date(1996, 2, 29), dt.date(1996, 1, 1)) == 1


@pytest.mark.parametrize("n,want", [(123, "       123"), (-123, "      -123"), (123456789, " 123456789"),
                                    (-123456789, "-123456789"), (1234567890, " #########"), (0, "         0")])
def test_to_char_digits(spark, n, want):
    from martspark.functions import to_char_digits
    assert one(spark, to_char_digits(F.lit(n), 9)) == want


def test_date_window_and_month_pruning(spark):
    from martspark.functions import date_window, prune_months
    rows = [(dt.date(2021, 1, 31), dt.date(2021, 1, 2)), (dt.date(2021, 2, 1), dt.date(2021, 1, 2)),
            (dt.date(2021, 2, 15), dt.date(2021, 2, 2)), (dt.date(2021, 3, 1), dt.date(2021, 2, 2))]
    df = spark.createDataFrame(rows, "d date, pmonth date")
    got = df.where(date_window("d", "2021-02-01", "2021-03-01", "pmonth")).collect()
    assert sorted(str(r["d"]) for r in got) == ["2021-02-01", "2021-02-15"]
    pruned = prune_months(df, dt.date(2021, 2, 1), dt.date(2021, 2, 28)).collect()
    assert len(pruned) == 4                      # partitions from the 2nd may still hold February rows
    assert prune_months(df.drop("pmonth"), dt.date(2021, 2, 1), dt.date(2021, 2, 28)).count() == 4
