import random
import re

from martspark.llm import license_join as J
from martspark.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def brute(text, templates=J.TEMPLATES):
    stride = max(J.STRIDE, *(len(t.split()) for _, t, _ in templates))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base, more, score = [], set(), set(), 0.0
    for phrase, label in J.PHRASES:
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
                score = 1.0
    for i in range(0, max(1, len(words) - stride), stride):
        here = words[i:i + 2 * stride]
        for label, t, anchor in templates:
            a, share = anchor.split(), len(set(here) & set(t.split())) / len(set(t.split()))
            if share >= J.THRESHOLD and any(here[j:j + len(a)] == a for j in range(len(here))):
                more.add(label)
                score = max(score, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), round(score, 12))


def check(df, templates=J.TEMPLATES):
    want = sorted(((r["doc_id"], *brute(r["text"], templates)) for r in df.select("doc_id", "text").collect()), key=str)
    got = sorted(((*r[:7], round(r[7], 12)) for r in map(tuple, J.scan(df, templates).collect())), key=str)
    assert got == want


def test_tables(spark):
    check(table(spark, SF, "documents"))


def test_odd_texts(spark):
    check(H.odd(spark))


def test_pieces_of_templates(spark):
    """Templates cut, thinned, shuffled and set into prose at any place, some across blocks."""
    rng = random.Random(5)
    rows = []
    for k in range(300):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += [rng.choice(["the", "of", "a", "under", "license", "Été", "x1", "cc", "BY", "by"]) for _ in range(rng.randint(0, 90))]
            piece = rng.choice(J.TEMPLATES)[1].split()
            words += [w for w in piece if rng.random() < rng.choice([0.7, 0.85, 1])]
        rows.append((k, rng.choice([" ", ", ", "\n"]).join(words)))
    check(H.frame(spark, rows))


def test_a_label_needs_its_license_named(spark):
    lines = {"Licensed under CC BY 4.0": "cc-by", "Released under the BSD license": "bsd", "Licensed under the Mozilla license version 2.0": "mpl",
             "The mit group was released last year and the license for driving under age was denied": "", "Released under the MIT license.": "mit",
             "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc", "Licensed under the Apache License, Version 2.0": "apache", "version 2 0 of the apache, licensed under a license": ""}
    got = {r["text"]: r["labels"] for r in J.scan(H.frame(spark, list(enumerate(lines)))).join(H.frame(spark, list(enumerate(lines))).select("doc_id", "text"), "doc_id").collect()}
    assert got == lines


def test_templates_of_any_length(spark):
    rng = random.Random(8)
    long = [f"term{i}" for i in range(150)]
    templates = (("long", " ".join(long), "term70 term71"), ("short", "released under the x license", ""), J.TEMPLATES[0])
    rows = [(k, " ".join(["the"] * rng.randrange(400) + [w for w in long if rng.random() < rng.choice([.75, .9, 1])] + ["released", "under", "the", "x", "license"])) for k in range(60)]
    df = H.frame(spark, rows)
    want = {i: {"short"} | ({"long"} if any(sum(w in set(ws[a:a + 300]) for w in long) >= 120 and any(ws[a:a + 300][j:j + 2] == ["term70", "term71"] for j in range(300)) for a in range(0, max(1, len(ws) - 150), 150)) else set())
            for i, ws in ((i, t.split()) for i, t in rows)}
    assert {r["doc_id"]: set(r["labels"].split(",")) for r in J.scan(df, templates).collect()} == want
    assert any("long" in x for x in want.values()) and not all("long" in x for x in want.values())


def test_empty(spark):
    assert J.scan(H.empty(spark)).count() == 0
