import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from martspark.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Every part against every entry, in Python's whole numbers."""
    rows = [r for r in rows if r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    if not rows:
        return []
    w = len(rows[0][1]) // parts
    ints = [[math.floor(256 * x) for x in r[1]] for r in rows]
    cut = [[tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for v in ints]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = [near(v[p], books[p])[1] for v in cut]
            for e in range(len(books[p])):
                mine = [v[p] for v, g in zip(cut, got) if g == e]
                if mine:
                    books[p][e] = tuple(sum(c) // len(mine) for c in zip(*mine))
    out, by_label = [], {}
    for r, v in zip(rows, cut):
        found = [near(v[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[r[2]] = by_label.get(r[2], 0) + error
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), error, r[2]))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((a, b, c, by_label[x], sha) for a, b, c, x in out), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def f32(xs):
    return [None if x is None else float(np.float32(x)) for x in xs]


def test_equals_brute_force(spark):
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(32)] for _ in range(9)]
    rows = [(i, f32([c + r.gauss(0, .2) for c in r.choice(centres)]), r.choice([None, 1, 2, 3])) for i in r.sample(range(2000), 400)]
    rows += [(5000 + i, rows[7][1], 1) for i in range(150)] + [rows[8], rows[8], (None, rows[9][1], None)]           # a hot vector, repeats
    rows += [(-1, None, 1), (-2, [], 1), (-3, f32([float("nan")] * 32), 1), (-4, f32([float("inf")] + [0.] * 31), 2), (-5, [None] * 32, 1), (9000, f32([1.0] * 16), 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("error", F.lit("x")).withColumn("a.b", F.lit(2)).repartition(5)
    want = brute([x for x in rows if x[0] != 9000])
    assert got(V.compressed(df)) == want


def test_ties_few_rows_and_coarse_numbers(spark):
    r = random.Random(4)
    coarse = [(i, [float(r.randrange(-2, 3)) / 256 for _ in range(16)], 0) for i in range(300)]
    assert got(V.compressed(spark.createDataFrame(coarse, SCHEMA))) == brute(coarse)
    few = [(i, [float(i + j) for j in range(16)], i % 2) for i in range(5)]
    assert got(V.compressed(spark.createDataFrame(few, SCHEMA))) == brute(few)
    one = [(3, [0.0] * 48, None)]
    assert got(V.compressed(spark.createDataFrame(one, SCHEMA))) == brute(one)


def test_components_of_any_size(spark):
    r = random.Random(6)
    rows = [(i, [r.uniform(-1, 1) * 10 ** r.randrange(0, 7) for _ in range(16)], i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(V.compressed(df)) == brute(rows)
    huge = [(i, [r.uniform(-1, 1) * 1e300 for _ in range(16)], i % 3) for i in range(70)] + [(99, [1.0] * 16, 7)]
    out = {x["vec_id"]: x for x in V.compressed(spark.createDataFrame(huge, "vec_id long, embedding array<double>, label int")).collect()}
    want = {x[0]: x for x in brute(huge)}
    assert {k: (x["code"], x["codebooks_sha256"]) for k, x in out.items()} == {k: (x[1], x[4]) for k, x in want.items()}
    assert all(x["error"] == (want[k][2] if want[k][2] < 2 ** 63 else None) for k, x in out.items())


def test_bounds_save_work_and_never_decide():
    """Bounded assignment over several moves against comparing everything, and how much it compares."""
    r = np.random.default_rng(1)
    centres = r.normal(0, 300, (40, 2, 4))
    x = np.floor(centres[r.integers(0, 40, 3000)] + r.normal(0, 40, (3000, 2, 4))).astype(np.int64)
    book = V.Book(x[:64].transpose(1, 0, 2).copy())
    b = 16
    _, near, bounds, _, _ = V.assign(x, book, b)
    compared = []
    for step in range(5):
        sums = V._Sums(book)
        sums.add(x, near)
        book = book.update({(i // 64, i % 64): (int(n), sums.total[i].tolist()) for i, n in enumerate(sums.n) if n})
        d, near, bounds, used, full = V.assign(x, book, b, near, V._down(bounds).astype(np.float64))
        e = ((x[:, :, None] - book.entries[None]) ** 2).sum(-1).reshape(-1, 64)
        assert (near[:, 0] == e.argmin(1)).all() and (d == e.min(1)).all()
        inside = np.take_along_axis(e, near.astype(int), 1)
        assert (bounds[:, :b] <= np.sqrt(inside) + 1e-9).all()
        rest = e.copy()
        np.put_along_axis(rest, near.astype(int), 1 << 60, 1)
        assert (bounds[:, b] <= np.sqrt(rest.min(1)) + 1e-9).all()
        compared.append(full / len(d))
        old, b = b, min(b, max(8, used))
        if b < old:
            bounds = np.concatenate([bounds[:, :b], bounds[:, b:].min(1, keepdims=True)], 1)
            near = near[:, :b]
    assert compared[-1] < .2


def test_empty(spark):
    assert V.compressed(spark.createDataFrame([], SCHEMA)).count() == 0
    assert V.compressed(spark.createDataFrame([(1, None, 1), (2, [1.0], 1)], SCHEMA)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
