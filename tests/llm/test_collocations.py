import random
import re
from collections import Counter

import numpy as np
import pytest

from martspark.llm import collocations as K
from tests.llm.helpers import LONG, empty, frame

FOLD = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=10, share=50, top=2000):
    """Every phrase counted in a dictionary."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                c.update(zip(*(w[i:] for i in range(k))))
    out = []
    for lang, c in f.items():
        cand = [p for p, a in c.items() if len(p) > 1 and a >= least]
        longer = {}
        for p in cand:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer.get(q, 0), c[p])
        rows = []
        for p in cand:
            a = c[p]
            if 100 * longer.get(p, 0) >= share * a and p in longer:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, ph.decode(), -a, left, right, n[lang], -s) for i, (s, a, ph, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def got(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def corpus(seed=1, n=160):
    r = random.Random(seed)
    vocab = ["the", "of", "new", "york", "city", "été", "A", "a", "ÉTÉ", "x" * 40, "🙂", "|", "don't"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = [r.choice(vocab[:13] if r.random() < .7 else vocab) + r.choice(["", "", "", ".", ",", "\n", "\t", "  ", "; ", "\x0b"]) for _ in range(r.randrange(120))]
        rows.append((i, " ".join(words), r.choice(["en", "en", "de", None, "und", "", "a b"]), "s"))
    rows += [(900 + i, "the the the the the", "en", "hot") for i in range(40)] + [(i, t, "en", "s") for i, t in ((950, None), (951, ""), (952, " .,;\n"), (953, "one"), (None, "new york city"))]
    return rows


@pytest.mark.parametrize("budget, least, top", [(1 << 21, 10, 2000), (40, 10, 2000), (7, 3, 25)])
def test_equals_brute_force(spark, monkeypatch, budget, least, top):
    monkeypatch.setattr(K, "BLOCK_WORDS", 400)
    rows = corpus()
    df = frame(spark, rows).repartition(3)
    assert got(K.collocations(df, least=least, top=top, budget=budget)) == brute([(t, lang) for _, t, lang, _ in rows], least, top=top)


def test_long_text_is_read_in_slices(spark):
    rows = [(1, LONG, "en", "s"), (2, "b a " * 40, "en", "s"), (3, "a, b. " * 900_000, "en", "s"), (4, "p q " * 1_100_000, "fr", "s")]
    assert got(K.collocations(frame(spark, rows))) == brute([(t, lang) for _, t, lang, _ in rows])


def test_empty(spark):
    out = K.collocations(empty(spark))
    assert out.count() == 0 and out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_019, 3_000_000_021, 3_000_000_033
    df = spark.createDataFrame([(a, left, right), (10 ** 13, 10 ** 13, 10 ** 13 + 1)], "a long, l long, r long")
    assert [r[0] for r in df.select(K._score(df.a, df.l, df.r)).collect()] == [10 ** 6 * a * a // (left * right), 999_999]


def test_groups_keep_to_the_budget():
    n = np.sort(np.random.default_rng(2).integers(1, 100, 500))[::-1]
    g = K.packed_groups(n, 100)
    assert np.bincount(g, n).max() <= 100 and (np.diff(g) >= 0).all()


def test_leaves_by_code_and_by_columns(monkeypatch):
    r = np.random.default_rng(3)
    w, n = r.integers(0, 6, (3, 900)), r.integers(1, 9, 900)
    for counts in (None, n):
        a = K.leaves(*w, counts)
        monkeypatch.setattr(K, "BITS", 1)
        b = K.leaves(*w, counts)
        monkeypatch.undo()
        want = Counter()
        for i, t in enumerate(zip(*w.tolist())):
            want[t] += 1 if counts is None else int(n[i])
        assert dict(zip(zip(*(x.tolist() for x in a[:3])), a[3].tolist())) == want
        assert all((x == y).all() for x, y in zip(a, b))


def test_slices_end_with_pieces(monkeypatch):
    monkeypatch.setattr(K.C, "CHUNK_BYTES", 10)
    data = np.frombuffer(b"ab cd. ef gh, ij kl mn op qr st\n uvxy", np.uint8)
    offs, text = K.slices(np.array([0, 0, 35, 37, 37]), data)
    assert offs.tolist() == [0, 0, 13, 32, 35, 37, 37] and text[np.diff(offs) > 0].tolist() == [1, 1, 1, 2]
