"""Dictionary lookups (defaults for missing keys, one row per key) and segment counts."""

from martspark.operators import quality
from martspark.operators.lookup import dict_get, dictionary


def test_dictionary_one_row_per_key_and_defaults(spark):
    dim = spark.createDataFrame([("m1", "g1", "b2", 5), ("m1", "g0", "b9", 7), ("m2", "g2", "b2", 1),
                                 (None, "gx", "bx", 9)], "material string, asgrp string, brand string, size int")
    d = dictionary(dim, "material", ["asgrp", "brand", "size"])
    assert sorted(map(tuple, d.collect())) == [("m1", "g0", "b9", 7), ("m2", "g2", "b2", 1)]
    keys = spark.createDataFrame([("m1",), ("m3",), (None,)], "k string")
    got = {r["k"]: (r["asgrp"], r["brand"], r["size"]) for r in
           dict_get(keys, "k", d, "material", ["asgrp", "brand", "size"]).collect()}
    assert got == {"m1": ("g0", "b9", 7), "m3": ("", "", 0), None: ("", "", 0)}


def test_rows_per_segment_forms(spark):
    df = spark.createDataFrame([(i, f"k{i % 3}") for i in range(30)], "id long, s string")
    by_key = {r["segment"]: r["rows"] for r in quality.rows_per_segment(df, "id", 4).collect()}
    assert by_key == {0: 8, 1: 8, 2: 7, 3: 7}
    by_hash = quality.rows_per_segment(df, "s", 4).collect()
    assert sum(r["rows"] for r in by_hash) == 30 and all(0 <= r["segment"] < 4 for r in by_hash)
    by_part = quality.rows_per_segment(df.repartition(3), None, 0).collect()
    assert sum(r["rows"] for r in by_part) == 30
    skew = quality.skew_coefficient(quality.rows_per_segment(df, "id", 4)).first()
    assert skew["segments"] == 4 and skew["rows"] == 30 and float(skew["skew_pct"]) > 0


def _formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_bounds_come_from_footers(spark):
    from martspark.operators import loads as LD
    from martspark.session import scratch_path
    path = f"{scratch_path(spark, 'tests/footers')}/t"
    days = spark.range(200).selectExpr("id", "date_add(DATE'2020-01-15', cast(id as int)) AS day")
    LD.load_full(days.unionByName(days.limit(1).selectExpr("-1L AS id", "CAST(NULL AS DATE) AS day")), path, "pmonth", "day")
    one, months = quality.stored_date_bounds(spark, path, "day"), quality.stored_partition_bounds(spark, path, "day")
    for df in (one, months):
        assert "PushedAggregation: [" in _formatted(df).replace("PushedAggregation: []", "")
    df = spark.read.parquet(path)
    assert one.collect() == quality.date_bounds(df, "day").collect()
    assert sorted(map(str, months.collect())) == sorted(map(str, quality.partition_bounds(df, "day").collect()))
    df.where("day IS NULL").write.mode("append").parquet(f"{path}_flat")
    df.where("id < 9").write.mode("append").parquet(f"{path}_flat")
    flat = quality.stored_date_bounds(spark, f"{path}_flat", "day")          # a file of NULLs: read instead
    assert flat.collect() == quality.date_bounds(spark.read.parquet(f"{path}_flat"), "day").collect()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"        # the caller's session is as it was


def test_heavy_keys(spark):
    import random
    from collections import Counter
    r = random.Random(2)
    keys = [r.choice(["hot"] * 30 + [None] * 12 + ["warm"] * 6 + [f"k{r.randrange(3000)}" for _ in range(52)]) for _ in range(20000)]
    df = spark.createDataFrame([(k, 1) for k in keys], "`a.b` string, rows int").repartition(7)
    count = Counter(keys)
    for share in (.5, .1, .05, .001):
        got = {x["a.b"]: x["rows"] for x in quality.heavy_keys(df, "a.b", share).collect()}
        assert got == {k: n for k, n in count.items() if n >= share * len(keys)}
    assert quality.heavy_keys(df.limit(0), "a.b", .1).count() == 0
