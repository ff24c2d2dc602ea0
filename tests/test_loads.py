import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martspark.operators import loads as LD
from martspark.operators.merge import rank_merge, upsert, upsert_table
from martspark.operators.tables import read_table
from martspark.sources.files import RejectLimitExceeded, read_csv_checked, write_csv
from martspark.sources.jdbc import monthly_predicates
from martspark.sources.dispatch import UnknownSource, read_source
from martspark.sources.schemas import _s, D, I, L, S

D_ = dt.date
HEADS = "billnum long, plant string, calday date"


def heads(spark, rows):
    return spark.createDataFrame(rows, HEADS)


def state(spark, path):
    return sorted((r["billnum"], str(r["calday"]), str(r["pmonth"])) for r in read_table(spark, path).collect())


def test_delta_load_empties_month_without_rows(spark, tmp_table):
    p = tmp_table("delta")
    LD.load_full(heads(spark, [(1, "A", D_(2021, 1, 5)), (2, "A", D_(2021, 2, 5)), (3, "A", D_(2021, 3, 5))]),
                 p, "pmonth", "calday")
    n = LD.load_delta_partitions(spark, heads(spark, [(10, "A", D_(2021, 1, 7))]), p, "calday",
                                 "2021-01-20", "2021-02-01")
    assert n == 1
    # January replaced, February emptied (swapped with an empty stage), March untouched
    assert state(spark, p) == [(3, "2021-03-05", "2021-03-01"), (10, "2021-01-07", "2021-01-01")]


def test_delta_load_text_dates_strict(spark, tmp_table):
    src = spark.createDataFrame([("x", "05.01.2021", 1), ("y", "31.02.2021", 2)], "plant string, date string, q int")
    with pytest.raises(Exception):
        LD.load_delta_partitions(spark, src, tmp_table("txt"), "date", "2021-01-01", "2021-02-28", convert=True)
    ok = spark.createDataFrame([("x", "05.01.2021", 1), ("y", "01.02.2021", 2)], "plant string, date string, q int")
    p = tmp_table("txt2")
    assert LD.load_delta_partitions(spark, ok, p, "date", "2021-01-01", "2021-01-31", convert=True) == 1
    assert [str(r["date"]) for r in read_table(spark, p).collect()] == ["2021-01-05"]


def test_single_partition_truncates_everything(spark, tmp_table):
    p = tmp_table("single")
    src = heads(spark, [(1, "A", D_(2021, 1, 1)), (2, "A", D_(2021, 1, 2)), (3, "A", D_(2021, 2, 1)),
                        (4, "A", D_(2021, 2, 2))])
    LD.load_full(src, p, "pmonth", "calday", anchor_day=2)
    assert LD.load_single_partition(src, p, "calday", "2021-01-02") == 2
    assert state(spark, p) == [(2, "2021-01-02", "2021-01-02"), (3, "2021-02-01", "2021-01-02")]


def test_partition_swap_validates(spark, tmp_table):
    p = tmp_table("swap")
    LD.load_full(heads(spark, [(1, "A", D_(2021, 1, 5)), (2, "A", D_(2021, 2, 5))]), p, "pmonth", "calday")
    with pytest.raises(Exception):
        LD.partition_swap(spark, p, heads(spark, [(9, "A", D_(2021, 3, 1))]), "2021-02-01", "calday")
    LD.partition_swap(spark, p, heads(spark, []), "2021-02-01", "calday")       # empty stage empties it
    assert state(spark, p) == [(1, "2021-01-05", "2021-01-01")]


def test_header_item_month_without_heads(spark, tmp_table):
    p = tmp_table("hi")
    items = spark.createDataFrame([(1, 1, 5, Decimal("1.00"), Decimal("0.10"), 2, Decimal("3.00"))],
                                  "billnum long, billitem long, material long, netval decimal(17,2), "
                                  "tax decimal(17,2), qty long, rpa_sat decimal(17,2)")
    h = heads(spark, [(1, "A", D_(2021, 1, 9))])
    assert LD.load_header_item(spark, items, h, p, "2021-01-01", "2021-02-15", key_range_pushdown=True) == 1
    r = read_table(spark, p).first()
    assert r["calmonth"] == "202101" and r["plant"] == "A"
    assert LD.load_header_item(spark, items, heads(spark, []), p, "2021-01-01", "2021-01-31",
                               key_range_pushdown=True) == 0


def test_missing_month_partitions(spark):
    ex = spark.createDataFrame([(D_(2021, 1, 1),), (D_(2021, 2, 1),)], "pmonth date")
    got = [(str(r[0]), str(r[1])) for r in LD.missing_month_partitions(ex, "pmonth", "2021-04-15").collect()]
    assert got == [("2021-03-01", "2021-04-01"), ("2021-04-01", "2021-05-01")]
    assert LD.missing_month_partitions(ex, "pmonth", "2021-02-20").count() == 0
    assert LD.missing_month_partitions(ex.limit(1), "pmonth", "2022-01-01").count() == 0


def _kv(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_upsert_null_safe_and_duplicates(spark):
    t = _kv(spark, [(1, "t1"), (None, "tn"), (2, "t2")])
    s = _kv(spark, [(None, "sn"), (3, "s3"), (3, "s3b")])
    want = [(1, "t1"), (2, "t2"), (3, "s3"), (3, "s3b"), (None, "sn")]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, upsert(t, s, ["k"]).collect()), key=key) == sorted(want, key=key)
    assert sorted(map(tuple, rank_merge(t, s, ["k"]).collect()), key=key) == sorted(want, key=key)


def test_upsert_table_rewrites_only_touched_months(spark, tmp_table):
    p = tmp_table("ups")
    LD.load_full(heads(spark, [(1, "A", D_(2021, 1, 5)), (2, "A", D_(2021, 2, 5)), (3, "B", D_(2021, 3, 5))]),
                 p, "pmonth", "calday")
    src = heads(spark, [(2, "Z", D_(2021, 4, 1))])       # moves bill 2 from February to April
    assert upsert_table(spark, p, src, ["billnum"], date_key="calday") == 1
    assert state(spark, p) == [(1, "2021-01-05", "2021-01-01"), (2, "2021-04-01", "2021-04-01"),
                               (3, "2021-03-05", "2021-03-01")]


def test_csv_reject_limit(spark, tmp_table):
    p = tmp_table("csv")
    lines = spark.createDataFrame([("1;a",), ("x;b",), ("3;c",), ("y;d",)], "value string")
    lines.coalesce(1).write.text(p)
    schema = _s(("id", I, True), ("name", S, True))
    r = read_csv_checked(spark, p, schema, reject_limit=3, header="false")
    tgt = tmp_table("csv_t")
    LD.load_full(r.good, tgt)
    assert r.check() == 2
    assert sorted(x["id"] for x in read_table(spark, tgt).collect()) == [1, 3]
    r2 = read_csv_checked(spark, p, schema, reject_limit=2, header="false")
    LD.load_full(r2.good, tmp_table("csv_t2"))
    with pytest.raises(RejectLimitExceeded):
        r2.check()


def test_csv_roundtrip_semicolon_nulls(spark, tmp_table):
    p = tmp_table("csvnull")
    df = spark.createDataFrame([(1, None, D_(2021, 1, 2)), (2, 'say "hi"; bye', None)], "a int, b string, c date")
    write_csv(df, p)
    back = read_source(spark, "csv", p, _s(("a", I, True), ("b", S, True), ("c", D, True)))
    assert sorted(map(tuple, back.collect())) == [(1, None, D_(2021, 1, 2)), (2, 'say "hi"; bye', None)]
    with pytest.raises(UnknownSource):
        read_source(spark, "ftp", p)


def test_monthly_predicates():
    preds = monthly_predicates("date", D_(2021, 1, 15), D_(2021, 3, 1))
    assert preds[0] == "date >= DATE '2021-01-15' AND date < DATE '2021-02-15'"
    assert len(preds) == 2          # [01-15, 02-15) and [02-15, 03-15) cover 03-01
    assert len(monthly_predicates("d", D_(2021, 1, 1), D_(2021, 1, 10), step_days=5)) == 2


def test_table_swap_and_filtered(spark, tmp_table):
    p = tmp_table("ts")
    src = heads(spark, [(1, "A", D_(2021, 1, 5)), (2, "A", D_(2022, 2, 5))])
    assert LD.load_filtered(src, p, "year(calday) = 2021", truncate=True) == 1
    assert LD.load_filtered(src, p, F.year("calday") == 2022) == 1
    assert read_table(spark, p).count() == 2
    staged = LD.stage(spark, src.where("billnum = 2"), p)
    LD.table_swap(spark, p, staged)
    assert [r["billnum"] for r in read_table(spark, p).collect()] == [2]


def test_insert_rows_appends(spark, tmp_table):
    p = tmp_table("ins")
    assert LD.insert_rows(spark, p, [(1, "A", D_(2021, 1, 1))], HEADS) == 1
    assert LD.insert_rows(spark, p, [(2, "B", None), (3, None, None)], HEADS) == 2
    assert sorted(r["billnum"] for r in read_table(spark, p).collect()) == [1, 2, 3]


def test_run_log_rules(spark, tmp_table):
    from martspark.operators.runlog import RunLog
    log = RunLog(spark, tmp_table("log"))
    with pytest.raises(ValueError):
        log.write("warning", "x", "Here")
    log.write("error", None, "Some PLACE")
    r = log.read().first()
    assert (r["log_type"], r["log_msg"], r["log_location"], r["is_error"]) == ("ERROR", "empty", "some place", True)
    assert r["log_id"] and r["log_timestamp"] is not None


def test_truncate_then_reload_is_idempotent(spark, tmp_table):
    p = tmp_table("trunc")
    src = heads(spark, [(1, "A", D_(2021, 1, 5)), (2, "B", D_(2021, 2, 5))])
    assert LD.load_full(src, p) == 2
    LD.truncate_table(spark, p, HEADS)
    assert read_table(spark, p).count() == 0 and read_table(spark, p).columns == ["billnum", "plant", "calday"]
    assert LD.load_full(src, p) == 2 and LD.load_full(src, p) == 2      # running twice: same table
    assert read_table(spark, p).count() == 2


@pytest.mark.parametrize("kind", ["delta", "header_item", "upsert", "swap"])
def test_loaders_are_idempotent(spark, tmp_table, kind):
    p = tmp_table(f"idem_{kind}")
    base = heads(spark, [(1, "A", D_(2021, 1, 5)), (2, "A", D_(2021, 2, 5)), (3, "B", D_(2021, 3, 5))])
    LD.load_full(base, p, "pmonth", "calday")
    src = heads(spark, [(2, "Z", D_(2021, 2, 9)), (4, "C", D_(2021, 2, 10))])
    items = spark.createDataFrame([(2, 1, 5, Decimal("1.00"), Decimal("0.10"), 2, Decimal("3.00"))],
                                  "billnum long, billitem long, material long, netval decimal(17,2), "
                                  "tax decimal(17,2), qty long, rpa_sat decimal(17,2)")

    def run():
        if kind == "delta":
            LD.load_delta_partitions(spark, src, p, "calday", "2021-02-01", "2021-02-28")
        elif kind == "header_item":
            LD.load_header_item(spark, items, src, p + "_bills", "2021-02-01", "2021-02-28")
        elif kind == "upsert":
            upsert_table(spark, p, src, ["billnum"], date_key="calday")
        else:
            LD.partition_swap(spark, p, src, "2021-02-01", "calday")
        path = p + "_bills" if kind == "header_item" else p
        return sorted(map(tuple, read_table(spark, path).collect()))

    first = run()
    assert run() == first


def test_tune_for_scale_respects_launch_settings(spark):
    from martspark.session import CLUSTER_SETTINGS, tune_for_scale
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = tune_for_scale(spark, {"spark.sql.files.maxPartitionBytes": "128m"})
    try:
        assert "spark.sql.shuffle.partitions" in applied or before == spark.conf.get("spark.sql.shuffle.partitions")
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "128m"
        assert set(applied) <= set(CLUSTER_SETTINGS) | {"spark.sql.files.maxPartitionBytes"}
    finally:
        for k in applied:
            spark.conf.unset(k)


def test_jdbc_calls_pass_ranges_and_options():
    """No database may run here: check the calls the JDBC helpers make instead."""
    from martspark.sources.jdbc import read_jdbc_ranges, write_jdbc
    calls = []

    class Reader:
        def jdbc(self, url, table, **kw):
            calls.append(("read", url, table, kw))
            return "df"

    class FakeSpark:
        read = Reader()

    out = read_jdbc_ranges(FakeSpark(), "jdbc:x://h/db", "src.traffic", "date", D_(2021, 1, 1), D_(2021, 2, 28),
                           properties={"user": "u"})
    assert out == "df"
    _, url, table, kw = calls[0]
    assert (url, table) == ("jdbc:x://h/db", "src.traffic")
    assert kw["properties"] == {"fetchsize": "10000", "user": "u"}
    assert kw["predicates"] == ["date >= DATE '2021-01-01' AND date < DATE '2021-02-01'",
                                "date >= DATE '2021-02-01' AND date < DATE '2021-03-01'"]

    class Writer:
        def jdbc(self, url, table, mode, properties):
            calls.append(("write", url, table, mode, properties))

    class FakeDF:
        write = Writer()

    write_jdbc(FakeDF(), "jdbc:x://h/db", "dst.t", {"user": "u"})
    assert calls[1] == ("write", "jdbc:x://h/db", "dst.t", "append", {"batchsize": "10000", "user": "u"})
