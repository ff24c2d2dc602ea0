"""Tables of the catalog: typed months, exchange by location, views read from another session."""

import datetime as dt

import pytest

from martspark.operators import catalog as K
from martspark.operators.tables import data_files
from martspark.session import scratch_path
from martspark.sources.schemas import D, I, S, _s

ROW = _s(("day", D, True), ("region", S, True), ("n", I, True))


@pytest.fixture()
def db(spark):
    root = scratch_path(spark, "tests/catalog")
    name = f"t_{root.rsplit('-', 1)[-1]}"
    K.create_database(spark, name, root)
    yield name, root
    spark.sql(f"DROP DATABASE {name} CASCADE")


def frame(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(a), b, c) for a, b, c in rows], ROW)


def rows_of(df):
    return sorted((str(r["day"]), r["region"], r["n"]) for r in df.collect())


def starts(spark, table):
    return [str(m) for m in K.registered_months(spark, table)]


def test_typed_table_with_registered_months(spark, db):
    name, root = db
    assert K.create_month_table(spark, f"{name}.t", ROW, f"{root}/t", "2021-01-02", "2021-04-02") == 3
    assert starts(spark, f"{name}.t") == ["2021-01-02", "2021-02-02", "2021-03-02"]
    t = spark.table(f"{name}.t")
    assert t.dtypes == [("day", "date"), ("region", "string"), ("n", "int"), ("pmonth", "date")] and t.count() == 0
    K.create_like(spark, f"{name}.u", f"{name}.t", f"{root}/u")
    assert spark.table(f"{name}.u").dtypes == t.dtypes


def test_missing_months_are_added_and_counted(spark, db):
    name, root = db
    t = f"{name}.t"
    K.create_month_table(spark, t, ROW, f"{root}/t", "2021-01-02", "2021-02-02")
    assert K.add_missing_months(spark, t, "2021-09-01") == 0                     # one partition only: none is added
    K.add_months(spark, t, [dt.date(2021, 2, 2)])
    assert K.add_missing_months(spark, t, "2021-03-01") == 0                     # lies in February's
    assert K.add_missing_months(spark, t, "2021-05-02") == 3
    assert K.add_missing_months(spark, t, "2021-05-02") == 0
    assert starts(spark, t) == [f"2021-0{m}-02" for m in range(1, 6)]
    ends = [str(r[1]) for r in K.month_partitions(spark, t).orderBy("partition_start").collect()]
    assert ends == [f"2021-0{m}-02" for m in range(2, 7)]


def test_months_are_exchanged_by_location(spark, db):
    name, root = db
    t = f"{name}.t"
    K.create_month_table(spark, t, ROW, f"{root}/t")
    rows = [("2021-01-05", "A", 1), ("2021-02-05", "B", 2), ("2021-03-05", "C", 3)]
    assert K.load_delta(spark, t, frame(spark, *rows, ("2021-04-01", "X", 9)), "day", "2021-01-10", "2021-03-10") == 3
    jan, feb = (K.month_location(spark, t, f"2021-0{m}-01") for m in (1, 2))
    assert K.exchange_month(spark, t, frame(spark, ("2021-02-09", "Z", 7)), "2021-02-11", "day") == 1
    assert K.month_location(spark, t, "2021-01-01") == jan and K.month_location(spark, t, "2021-02-01") != feb
    assert data_files(spark, feb) == []                                          # the old month's files are gone
    assert rows_of(spark.table(t)) == [rows[0], ("2021-02-09", "Z", 7), rows[2]]
    assert rows_of(spark.newSession().table(t).where("pmonth = DATE'2021-02-01'")) == [("2021-02-09", "Z", 7)]
    K.exchange_month(spark, t, frame(spark).limit(0), "2021-01-01", "day")       # an empty one empties the month, which stays
    assert rows_of(spark.table(t)) == [("2021-02-09", "Z", 7), rows[2]] and len(starts(spark, t)) == 3


def test_a_row_outside_ends_the_exchange_before_it(spark, db):
    name, root = db
    t = f"{name}.t"
    K.create_month_table(spark, t, ROW, f"{root}/t")
    K.load_delta(spark, t, frame(spark, ("2021-01-05", "A", 1)), "day", "2021-01-01", "2021-01-31")
    with pytest.raises(Exception, match="outside the partition window"):
        K.exchange_month(spark, t, frame(spark, ("2021-01-09", "Z", 7), ("2021-02-01", "Z", 8)), "2021-01-01", "day")
    assert rows_of(spark.table(t)) == [("2021-01-05", "A", 1)]
    with pytest.raises(ValueError, match="starts on"):
        K.load_delta(spark, t, frame(spark, ("2021-01-09", "Z", 7)), "day", "2021-01-05", "2021-01-20", anchor_day=2)


def test_table_exchange_and_view(spark, db):
    name, root = db
    from martspark.operators.loads import load_full
    load_full(frame(spark, ("2021-01-05", "A", 1), ("2021-02-05", "B", 2)), f"{root}/p", "pmonth", "day")
    load_full(frame(spark, ("2021-01-05", "A", 1)), f"{root}/q")
    K.register(spark, f"{name}.p", f"{root}/p", "pmonth")
    K.register(spark, f"{name}.q", f"{root}/q")
    assert starts(spark, f"{name}.p") == ["2021-01-01", "2021-02-01"]
    K.create_view(spark, f"{name}.v", f"SELECT p.n, q.region FROM {name}.p JOIN {name}.q ON p.region = q.region")
    assert spark.newSession().sql(f"SELECT * FROM {name}.v").collect() == [(1, "A")]
    assert K.exchange_table(spark, f"{name}.q", frame(spark, ("2021-01-05", "B", 1), ("2021-01-05", "C", 1))) == 2
    assert spark.newSession().sql(f"SELECT * FROM {name}.v").collect() == [(2, "B")]
