"""Loads that must not lose, double or misplace a row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martspark.operators import export
from martspark.operators import loads as LD
from martspark.operators.merge import rank_merge, upsert_table
from martspark.operators.tables import (create_table, drop_table, month_key, month_start, months_in, path_exists,
                                        read_table, table_partition_values)
from martspark.session import scratch_path, shared_root
from martspark.sources.dispatch import read_source
from martspark.sources.files import RejectLimitExceeded, read_csv, write_csv
from martspark.sources.schemas import D, I, S, _s

ROW = "day date, region string, n int"


def d(text):
    return text and dt.date.fromisoformat(text)


def frame(spark, *rows):
    return spark.createDataFrame([(d(a), b, c) for a, b, c in rows], ROW)


def rows_of(df):
    return sorted(((str(r["day"]), r["region"], r["n"]) for r in df.collect()), key=str)


def listing(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]


@pytest.fixture()
def target(spark):
    return f"{scratch_path(spark, 'tests/lossless')}/t"


UPSERTS = {
    "null date kept": ([("1996-01-05", "A", 1), (None, "B", 2), (None, "C", 3)], [(None, "B", 20), ("1996-01-06", "Z", 9)], ["region"]),
    "null date replaced by a date": ([("1996-01-05", "A", 1), (None, "B", 2), (None, "C", 3)], [("1996-02-01", "B", 20)], ["region"]),
    "only null dates": ([(None, "B", 2), (None, "C", 3)], [(None, "B", 20)], ["region"]),
    "null date as key": ([("1996-01-05", "A", 1), (None, "B", 2)], [(None, "Z", 20), ("1996-01-05", "Q", 1), ("1996-01-05", "Q", 1)], ["day"]),
    "null region as key": ([("1996-01-05", None, 1), ("1996-03-05", None, 2), ("1996-01-07", "B", 3)], [("1996-05-05", None, 7)], ["region"]),
}


@pytest.mark.parametrize("case", sorted(UPSERTS))
def test_upsert(spark, target, case):
    old, new, keys = UPSERTS[case]
    at = [("day", "region", "n").index(k) for k in keys]
    want = [r for r in old if not any(all(r[i] == s[i] for i in at) for s in new)] + new
    want = sorted(((str(d(a)), b, c) for a, b, c in want), key=str)
    LD.load_full(frame(spark, *old), target, "pmonth", "day")
    assert upsert_table(spark, target, frame(spark, *new), keys, date_key="day") == len(new)
    assert rows_of(read_table(spark, target)) == want
    assert rows_of(rank_merge(frame(spark, *old), frame(spark, *new), keys)) == want
    LD.load_full(frame(spark, *old), target + "2")
    upsert_table(spark, target + "2", frame(spark, *new), keys)
    assert rows_of(read_table(spark, target + "2")) == want
    # nothing staged is left, beside the table or in the shared folder
    assert sorted(listing(spark, target.rsplit("/", 1)[0])) == ["t", "t2"]
    staging = f"{shared_root(spark)}/martspark/staging"
    assert not path_exists(spark, staging) or not [x for x in listing(spark, staging) if x.startswith(("t_source", "t2_source"))]


def test_upsert_on_a_date_key_searches_the_months_of_the_source_only(spark, target, monkeypatch):
    import martspark.operators.merge as M
    seen = []
    real = M.touched_files
    monkeypatch.setattr(M, "touched_files", lambda s, p, t, *rest, **more: seen.append(t) or real(s, p, t, *rest, **more))
    LD.load_full(frame(spark, ("1996-01-05", "A", 1), ("1996-02-05", "B", 2), ("1996-03-05", "C", 3)), target, "pmonth", "day")
    upsert_table(spark, target, frame(spark, ("1996-02-05", "Z", 5)), ["day"], date_key="day")
    plan = seen[0]._jdf.queryExecution().toString()
    assert "1996-02-01" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("anchor", [1, 2, 29, 31])
def test_anchored_delta_replaces_its_own_rows(spark, target, anchor):
    rows = [(f"1996-{m:02d}-{x:02d}", "A", m * 100 + x) for m in (1, 2, 3, 4) for x in (1, 2, 15, 28)] + [("1996-01-31", "B", 1), ("1996-02-29", "B", 2)]
    df = frame(spark, *rows)
    LD.load_full(df, target, "pmonth", "day", anchor_day=anchor)
    LD.load_delta_partitions(spark, df, target, "day", "1996-02-03", "1996-03-05", anchor_day=anchor)
    assert rows_of(read_table(spark, target)) == rows_of(df)
    upsert_table(spark, target, df, ["day"], date_key="day", anchor_day=anchor)
    assert rows_of(read_table(spark, target)) == rows_of(df)


def test_other_anchor_is_refused(spark, target):
    df = frame(spark, ("1996-01-05", "A", 1))
    LD.load_full(df, target, "pmonth", "day", anchor_day=2)
    for load in (lambda: LD.load_delta_partitions(spark, df, target, "day", "1996-01-01", "1996-01-31"),
                 lambda: LD.partition_swap(spark, target, df, "1996-01-01", "day"),
                 lambda: upsert_table(spark, target, df, ["region"], date_key="day")):
        with pytest.raises(ValueError, match="1996-01-02"):
            load()
    assert rows_of(read_table(spark, target)) == rows_of(df)


@pytest.mark.parametrize("start", ["1996-01-29", "1996-01-30", "1996-01-31", "1996-02-29"])
def test_single_month_from_late_days(spark, target, start):
    df = frame(spark, *[(str(dt.date(1996, 1, 20) + dt.timedelta(days=k)), "A", k) for k in range(60)])
    LD.load_single_partition(df, target, "day", start)
    from martspark.functions import add_months_py
    end = add_months_py(d(start), 1)
    assert rows_of(read_table(spark, target)) == rows_of(df.where((F.col("day") >= d(start)) & (F.col("day") < end)))


@pytest.mark.parametrize("anchor", [1, 2, 29, 30, 31])
def test_month_key_is_the_python_form(spark, anchor):
    days = [dt.date(1995, 12, 1) + dt.timedelta(days=k) for k in range(500)]
    got = spark.createDataFrame([(x,) for x in days], "day date").select("day", month_key("day", anchor).alias("m")).collect()
    assert all(r["m"] == month_start(r["day"], anchor) for r in got)
    assert months_in(month_start(days[0], anchor), days[-1], anchor) == sorted({r["m"] for r in got if r["m"] < days[-1]})


SCHEMA = _s(("a", I, True), ("b", I, True))


def write_lines(spark, path, *lines):
    spark.createDataFrame([(x,) for x in ("a;b", *lines)], "v string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("line", ["2;oops", "3;7;extra", "4"])
def test_plain_read_ends_at_a_bad_line(spark, target, line):
    path = write_lines(spark, target, "1;2", line)
    uses = [lambda df: df.collect(), lambda df: df.select("a" if line != "2;oops" else "b").collect()]
    for use in uses:
        with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
            use(read_csv(spark, path, SCHEMA))


def test_reject_limit_leaves_the_target(spark, target):
    path = write_lines(spark, target + "_src", "1;2", "2;oops", "3;7;extra", "5;6")
    LD.load_full(spark.createDataFrame([(9, 9)], SCHEMA), target)
    for load in (LD.load_full, LD.load_filtered):
        with pytest.raises(RejectLimitExceeded):
            load(read_source(spark, "csv", path, SCHEMA, reject_limit=2), target)
        assert [tuple(r) for r in read_table(spark, target).collect()] == [(9, 9)]
    assert LD.load_full(read_source(spark, "csv", path, SCHEMA, reject_limit=3), target) == 2
    assert sorted(tuple(r) for r in read_table(spark, target).collect()) == [(1, 2), (5, 6)]


def test_texts_survive_a_round_trip(spark, target):
    schema = _s(("a", I, True), ("t", S, True))
    rows = [(1, "line one\nline two"), (2, ' a;"b" '), (3, "\r\nx\n")]
    df = spark.createDataFrame(rows, schema)
    with pytest.raises(Exception, match="a line break in t"):
        write_csv(df, target)
    write_csv(df, target + "2", multi_line=True)
    got = {r["a"]: r["t"] for r in read_csv(spark, target + "2", schema, multi_line=True).collect()}
    assert {k: v.replace("\r\n", "\n") for k, v in got.items()} == {k: v.replace("\r\n", "\n") for k, v in rows}


def test_export_files_are_sorted(spark, target):
    df = spark.range(400).select(F.concat(F.lit("r"), F.col("id") % 3).alias("report_name"), F.lpad((F.col("id") * 37 % 400).cast("string"), 4, "0").alias("plant"),
                                 F.col("id").cast("int").alias("plant_id"))
    export.publish_sharded(df, target, 4)
    files = read_table(spark, target).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"), "plant").collect()
    by = {}
    for r in sorted(files, key=lambda r: r["at"]):
        by.setdefault(r["f"], []).append(r["plant"])
    assert len(by) == 12 and sum(map(len, by.values())) == 400 and all(v == sorted(v) for v in by.values())


def test_plan_fact_export_refuses_negative_numbers(spark, target):
    cols = "region_code string, matdirec_code int, distr_chanel int, planned_quantity int, real_quantity int, complete_percent int, mosteff_material string"
    df = spark.createDataFrame([("r", 1, 1, 5, -1, 3, "m")], cols)
    with pytest.raises(Exception, match="real_quantity does not fit UInt32"):
        export.publish_plan_fact(df, target, 2)


def test_header_item_opens_only_its_months(spark, target):
    heads = spark.createDataFrame([(k, "p", dt.date(1996, 1 + k % 6, 3)) for k in range(60)], "billnum long, plant string, calday date")
    LD.load_full(heads, target, "pmonth", "calday")
    from martspark.functions import prune_months
    h = prune_months(read_table(spark, target), *LD.delta_window("1996-02-01", "1996-02-20"))
    plan = h._jdf.queryExecution().toString()
    assert "pmonth" in plan.split("PartitionFilters: [")[1].split("]")[0]
    items = spark.createDataFrame([(k, 1, k, 1, 1, 1, 1) for k in range(60)], "billnum long, billitem long, material long, rpa_sat int, qty int, netval int, tax int")
    n = LD.load_header_item(spark, items, read_table(spark, target), target + "_bills", "1996-02-01", "1996-02-20", key_range_pushdown=True)
    assert n == 10 and table_partition_values(spark, target + "_bills") == ["1996-02-01"]


def test_table_swap_renames(spark, target):
    LD.load_full(frame(spark, ("1996-01-05", "A", 1)), target)
    staged = LD.stage(spark, frame(spark, ("1996-01-06", "B", 2)), target)
    names = {x for x in listing(spark, staged) if x.startswith("part-")}
    assert LD.table_swap(spark, target, staged) == 1
    assert {x for x in listing(spark, target) if x.startswith("part-")} == names
    assert listing(spark, target.rsplit("/", 1)[0]) == ["t"]


def test_swap_puts_the_old_table_back(spark, target, monkeypatch):
    import martspark.operators.tables as T
    LD.load_full(frame(spark, ("1996-01-05", "A", 1)), target)
    staged = LD.stage(spark, frame(spark, ("1996-01-06", "B", 2)), target)
    real, calls = T._fs, []

    def failing(spark_, path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost")
        return real(spark_, path)

    monkeypatch.setattr(T, "_fs", failing)
    with pytest.raises(OSError, match="lost"):
        T.swap_in(spark, staged, target)
    monkeypatch.undo()
    assert rows_of(read_table(spark, target)) == [("1996-01-05", "A", 1)]


def test_create_and_drop_table(spark, target):
    create_table(spark, target, SCHEMA, "pmonth")
    empty = read_table(spark, target)
    assert empty.count() == 0 and [f.dataType.typeName() for f in empty.schema] == ["integer", "integer", "date"]
    assert drop_table(spark, target) and not drop_table(spark, target) and not path_exists(spark, target)


def test_scratch_folder_on_a_cluster():
    class Conf(dict):
        def get(self, k, default=None):
            return super().get(k, default)

    class Context:
        def __init__(self, master, root=None):
            self.master, self.root = master, root

        def getCheckpointDir(self):
            return self.root

        def setCheckpointDir(self, x):
            self.root = x

    class Session:
        def __init__(self, context, **conf):
            self.sparkContext, self.conf = context, Conf(conf)

    for root in (None, "/tmp/x", "file:/tmp/x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(Session(Context("spark://host:7077", root)))
    assert shared_root(Session(Context("spark://host:7077", "hdfs://a/b"))) == "hdfs://a/b"
    assert shared_root(Session(Context("local-cluster[2,1,1024]"), **{"spark.checkpoint.dir": "file:///shared/x"})) == "file:///shared/x"
    assert shared_root(Session(Context("local[4]")))


def test_malformed_lines_are_kept_and_counted_by_file(spark, target):
    root = scratch_path(spark, "tests/rejects")
    for i, bad in enumerate((2, 3)):
        lines = [f"1996-01-0{i + 1};A;{n}" for n in range(4)] + [f"1996-01-0{i + 1};A;x{n}" for n in range(bad)]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/src/f{i}")
    schema, rejects = _s(("day", D, True), ("region", S, True), ("n", I, True)), f"{root}/rejects"
    load = lambda limit: LD.load_full_keeping_rejects(spark, f"{root}/src/*", schema, target, rejects, limit, "pmonth", "day", header="false")
    assert load(4) == (8, 5)                      # five in all, three in the worst file
    kept = read_table(spark, rejects).collect()
    assert sorted((r["file"].split("/")[-2], r["line"]) for r in kept) == [(f"f{i}", f"1996-01-0{i + 1};A;x{n}") for i, k in enumerate((2, 3)) for n in range(k)]
    before = rows_of(read_table(spark, target))
    assert len(before) == 8
    with pytest.raises(RejectLimitExceeded, match="3 rejected rows in .*f1"):
        load(3)
    assert rows_of(read_table(spark, target)) == before and read_table(spark, rejects).count() == 5
    assert load(None) == (8, 5) and read_table(spark, rejects).count() == 10


def test_a_shard_is_read_by_key_and_a_report_replaced_alone(spark, target):
    from martspark.operators import catalog
    from martspark.operators.tables import data_files
    catalog.create_database(spark, "shards", target + "_db")
    rows = [(f"report_{r}", i, f"p{i}", r) for r in (1, 2) for i in range(40)]
    schema = "report_name string, plant_id int, plant string, v int"
    assert export.publish_shards(spark.createDataFrame(rows, schema), "shards.report", target, 4) == 80
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")     # else the plan doesn't say it
    one = spark.table("shards.report").where("plant_id = 7")
    text = spark._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in text and sorted(r["v"] for r in one.collect()) == [1, 2]
    before = {f for f in data_files(spark, target) if "report_1" in f}
    export.publish_shards(spark.createDataFrame([("report_2", 7, "p7", 9)], schema), "shards.report", target, 4)
    assert before <= set(data_files(spark, target))
    assert sorted((r["report_name"], r["v"]) for r in spark.table("shards.report").where("plant_id = 7").collect()) == [("report_1", 1), ("report_2", 9)]
