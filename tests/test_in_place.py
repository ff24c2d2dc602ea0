"""Tables changed in place: whole-table loads that can't lose it, key ranges, upserts by file,
months left alone."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martspark.operators import loads as LD
from martspark.operators.merge import upsert, upsert_table
from martspark.operators.ranges import in_ranges, key_ranges
from martspark.operators.tables import data_files, path_exists, read_table, replace_table, swap_files, write_observed
from martspark.session import scratch_path
from martspark.sources.files import read_csv
from martspark.sources.schemas import D, I, S, _s

ROW = _s(("day", D, True), ("region", S, True), ("n", I, True))


@pytest.fixture()
def target(spark):
    return f"{scratch_path(spark, 'tests/in_place')}/t"


def frame(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(a), b, c) for a, b, c in rows], ROW)


def rows_of(df):
    return sorted(((str(r["day"]), r["region"], r["n"]) for r in df.collect()), key=str)


GOOD = (("1996-01-05", "A", 1), ("1996-02-05", "B", 2))
LOADS = {
    "full": lambda df, t: LD.load_full(df, t),
    "full by month": lambda df, t: LD.load_full(df, t, "pmonth", "day"),
    "filtered": lambda df, t: LD.load_filtered(df, t, "n > 0", truncate=True),
    "single month": lambda df, t: LD.load_single_partition(df, t, "day", "1996-01-01"),
    "delta": lambda df, t: LD.load_delta_partitions(df.sparkSession, df, t, "day", "1996-01-01", "1996-02-28"),
}


@pytest.mark.parametrize("load", sorted(LOADS))
def test_a_bad_row_leaves_the_old_rows(spark, target, load):
    LD.load_full(frame(spark, *GOOD), target, "pmonth", "day")
    csv = scratch_path(spark, "tests/bad_csv")
    spark.createDataFrame([("day;region;n",), ("1996-01-07;C;3",), ("1996-01-08;C;many",)], "value string").coalesce(1).write.text(csv)
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILFAST"):
        LOADS[load](read_csv(spark, csv, ROW), target)
    assert rows_of(read_table(spark, target)) == sorted(GOOD)
    parent = target.rpartition("/")[0]
    assert [f for f in data_files(spark, parent) if "/t/" not in f] == []        # nothing is left beside it


@pytest.mark.parametrize("load", ["full by month", "single month"])
def test_whole_table_loads_in_a_session_with_dynamic_overwrite(spark, target, load):
    LD.load_full(frame(spark, *GOOD, ("1996-03-05", "C", 3)), target, "pmonth", "day")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        LOADS[load](frame(spark, ("1996-01-09", "Z", 9)), target)
        write_observed(LD.read_table(spark, target).select("*"), f"{target}_b", "overwrite", "pmonth")
        write_observed(frame(spark, GOOD[1]).withColumn("pmonth", F.lit("1996-02-01").cast("date")), f"{target}_b", "overwrite", "pmonth")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows_of(read_table(spark, target)) == [("1996-01-09", "Z", 9)]
    assert rows_of(read_table(spark, f"{target}_b")) == [GOOD[1]]


def test_a_table_can_be_replaced_by_rows_of_its_own(spark, target):
    LD.load_full(frame(spark, *GOOD), target)
    assert replace_table(read_table(spark, target).where("n > 1"), target) == 1
    assert rows_of(read_table(spark, target)) == [GOOD[1]]


def test_written_and_emptied_months_come_in_together(spark, target, monkeypatch):
    import martspark.operators.loads as L
    LD.load_full(frame(spark, *GOOD), target, "pmonth", "day")
    monkeypatch.setattr(L, "swap_in", lambda *a, **k: (_ for _ in ()).throw(OSError("no rename")))
    with pytest.raises(OSError):
        LD.load_delta_partitions(spark, frame(spark, ("1996-01-09", "Z", 9)), target, "day", "1996-01-01", "1996-02-28")
    assert rows_of(read_table(spark, target)) == sorted(GOOD)


def test_equal_months_are_left_alone(spark, target):
    rows = [(f"1996-0{m}-0{d}", "A", m * d) for m in (1, 2, 3) for d in (1, 1, 5)]
    LD.load_full(frame(spark, *rows), target, "pmonth", "day")
    before = data_files(spark, target)
    shuffled = frame(spark, *random.Random(1).sample(rows, len(rows))).repartition(3)
    assert LD.load_delta_partitions(spark, shuffled, target, "day", "1996-01-01", "1996-03-31", keep_equal=True) == 9
    assert data_files(spark, target) == before
    changed = [r for r in rows if r != ("1996-02-01", "A", 2)] + [("1996-02-01", "A", 2)]       # one of two equal rows less
    LD.load_delta_partitions(spark, frame(spark, *changed), target, "day", "1996-01-01", "1996-03-31", keep_equal=True)
    after = data_files(spark, target)
    assert {f for f in after if f in before} == {f for f in before if "pmonth=1996-02-01" not in f}
    assert rows_of(read_table(spark, target)) == sorted(changed)


# ---------------------------------------------------------------- key ranges


def brute_ranges(keys, k):
    keys = sorted(set(keys))
    gaps = sorted(((b - a, a, b) for a, b in zip(keys, keys[1:]) if b - a > 1), key=lambda g: (-g[0], g[1]))[:k - 1]
    out, begin = [], keys[0]
    for _, a, b in sorted(gaps, key=lambda g: g[1]):
        out.append((begin, a))
        begin = b
    return [*out, (begin, keys[-1])]


@pytest.mark.parametrize("k", [2, 5, 40])
def test_ranges_are_cut_at_the_largest_gaps(spark, k):
    r = random.Random(k)
    keys = [b + r.randrange(40) for b in r.sample(range(-10**6, 10**9, 1000), 12) for _ in range(30)] + [7] * 500 + [9 * 10**18]
    df = spark.createDataFrame([(x,) for x in keys] + [(None,)] * 5, "k long").repartition(6)
    assert key_ranges(df, "k", k) == brute_ranges(keys, k)


def test_ranges_of_dates_texts_and_nothing(spark):
    df = spark.createDataFrame([(dt.date(1996, 1, 1), "a", None), (dt.date(1996, 1, 2), "c", None), (dt.date(1999, 5, 1), "b", None)], "d date, s string, n long")
    assert key_ranges(df, "d", 3) == [(dt.date(1996, 1, 1), dt.date(1996, 1, 2)), (dt.date(1999, 5, 1), dt.date(1999, 5, 1))]
    assert key_ranges(df, "s", 3) == [("a", "c")] and key_ranges(df, "n", 3) == []
    assert df.where(in_ranges("n", [])).count() == 0 and df.where(in_ranges("n", [], nulls=True)).count() == 3
    assert df.where(in_ranges("s", [("a", "a"), ("c", "c")])).count() == 2


def scan_rows(df):
    """Rows that the executed plan's file scan handed on."""
    df.write.format("noop").mode("overwrite").save()
    todo = [df._jdf.queryExecution().executedPlan()]
    df.collect()
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan"):
            return int(p.metrics().apply("numOutputRows").value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]


def test_ranges_are_pushed_and_skip_row_groups(spark, target):
    spark.range(0, 400_000).select(F.col("id").alias("billnum"), F.rand(1).alias("x")).coalesce(1).sortWithinPartitions("billnum").write.option("parquet.block.size", 64 * 1024).parquet(target)
    heads = spark.createDataFrame([(i,) for i in [*range(100, 200), *range(200_000, 200_100), 399_999]], "billnum long")
    ranges = key_ranges(heads, "billnum", 3)
    assert ranges == [(100, 199), (200_000, 200_099), (399_999, 399_999)]
    hit = spark.read.parquet(target).where(in_ranges("billnum", ranges))
    pushed = next(ln for ln in hit._sc._jvm.PythonSQLUtils.explainString(hit._jdf.queryExecution(), "formatted").splitlines() if ln.startswith("PushedFilters"))
    assert pushed.count("GreaterThanOrEqual") == pushed.count("LessThanOrEqual") == 2 and "EqualTo(billnum,399999)" in pushed
    one = spark.read.parquet(target).where(F.col("billnum").between(100, 399_999))
    assert hit.count() == 201 and scan_rows(hit) < scan_rows(one) / 2


# ---------------------------------------------------------------- upsert by file


def items(spark, keys, v):
    return spark.createDataFrame([(k, v) for k in keys], "billnum long, v string")


def test_untouched_files_keep_their_names(spark, target):
    old = items(spark, [*range(1000), None], "old")
    old.repartitionByRange(5, "billnum").write.parquet(target)
    before = set(data_files(spark, target))
    src = items(spark, [3, 3, 5000], "new")
    assert upsert_table(spark, target, src, ["billnum"], order_by="billnum") == 3
    after = set(data_files(spark, target))
    assert len(before - after) == 1 and len(before & after) == len(before) - 1 >= 3
    want = sorted(map(str, upsert(old, src, ["billnum"]).collect()))
    assert sorted(map(str, read_table(spark, target).collect())) == want
    upsert_table(spark, target, items(spark, [7000], "new"), ["billnum"])         # replaces nothing: only a file more
    assert after < set(data_files(spark, target))
    upsert_table(spark, target, items(spark, [None], "null"), ["billnum"])        # NULL keys match
    assert [r["v"] for r in read_table(spark, target).where("billnum IS NULL").collect()] == ["null"]


def test_upsert_by_file_within_months(spark, target):
    rows = [(f"1996-0{m}-0{d}", "A", 10 * m + d) for m in (1, 2, 3) for d in (1, 2, 3)]
    LD.load_full(frame(spark, *rows), target, "pmonth", "day")
    write_observed(frame(spark, ("1996-02-09", "B", 99)).withColumn("pmonth", F.lit("1996-02-01").cast("date")), target, "append", "pmonth")
    before = set(data_files(spark, target))
    src = frame(spark, ("1996-03-07", "Z", 21), ("1996-01-08", "Z", 1000))
    upsert_table(spark, target, src, ["n"], date_key="day")
    after = set(data_files(spark, target))
    gone = before - after
    assert len(gone) == 1 and "pmonth=1996-02-01" in gone.pop()       # the file of n = 21; its neighbour stays
    assert rows_of(read_table(spark, target)) == sorted([r for r in rows if r[2] != 21] + [("1996-02-09", "B", 99), *rows_of(src)])


def test_a_failed_swap_of_files_puts_them_back(spark, target):
    write_observed(items(spark, range(10), "old"), target)
    write_observed(items(spark, range(2), "new"), f"{target}_new")
    before = sorted(data_files(spark, target))
    with pytest.raises(Exception, match="missing"):
        swap_files(spark, f"{target}_new", target, [*before, f"{before[0]}.missing"])
    assert sorted(data_files(spark, target)) == before and path_exists(spark, f"{target}_new")
