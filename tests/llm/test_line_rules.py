import re
from collections import Counter, defaultdict

from martspark.llm import line_rules as L
from martspark.llm.common import table
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit))


def norm(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()


def brute(rows, doc_limit, min_share, min_left):
    rows = [(i, t or "", h) for i, t, h in rows]
    lines = [[(norm(x), len(WORD.findall(x))) for x in t.split("\n") if WORD.search(x)] for _, t, _ in rows]
    signs, count = defaultdict(set), Counter()
    for (_, t, h), ls in zip(rows, lines):
        for x in {x for x, _ in ls}:
            signs[h, x].add(t)
            count[h, x] += 1
    out = []
    for (i, t, h), ls in zip(rows, lines):
        b = base(t)
        left = b[0] - sum(w for x, w in ls if len(signs[h, x]) > doc_limit and len(signs[h, x]) >= min_share * count[h, x])
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        out.append((i, *b, failed, not failed and left >= min_left * b[0], left))
    return sorted(out, key=str)


def check(df, **limits):
    rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    got = L.judged(df, **limits).select("doc_id", *L.STATS, "base_failed", "kept", "words_left").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, **limits)


def test_tables(spark):
    check(table(spark, SF, "documents"), doc_limit=1, min_share=0.2, min_left=0.9)


def test_odd_texts(spark):
    check(H.odd(spark), doc_limit=1, min_share=0.2, min_left=0.5)


def test_empty(spark):
    assert L.judged(H.empty(spark)).count() == 0


def texts_with_boilerplate():
    word = lambda k: "".join(chr(97 + (k * 7 + j * 11) % 26) for j in range(6)) + str(k)
    own = lambda k: " ".join(word(100 * k + j) for j in range(15))
    rows = [(k, f"Subscribe to our news letter today\n{own(k)}") for k in range(30)]
    rows += [(100 + k, "\n".join(["Subscribe to our  NEWS letter today"] * 1 + ["Home page about us contact privacy terms and more"])) for k in range(25)]
    rows += [(200 + k, "\n".join([own(999), own(998), own(997 if k else 5)])) for k in range(40)]       # near copies
    return rows


def test_boilerplate_goes_and_copies_stay(spark):
    df = H.frame(spark, texts_with_boilerplate())
    kept = {r["doc_id"]: r for r in L.judged(df).collect()}
    assert kept[0]["kept"] and kept[0]["words_left"] == 15
    assert all(kept[200 + k]["kept"] and kept[200 + k]["words_left"] == 45 for k in range(40))
    out = {r["doc_id"]: r for r in L.clean(df).collect()}
    assert "letter" not in out[0]["text"] and out[0]["n_chars"] == len(out[0]["text"])
    assert set(out[0].asDict()) == set(df.columns)
    assert L.clean(df).columns == df.columns


def test_line_that_sorts_first_goes_too(spark):
    word = lambda k: f"w{k * 7919 % 100003}"
    own = lambda k: " ".join(word(100 * k + j) for j in range(15))
    rows = [(k, f"- menu - of this site\n{own(k)}\nzz all about our site") for k in range(30)]
    rows += [(100 + k, "- a notice\n" + own(500)) for k in range(30)]                             # copies count once
    kept = {r["doc_id"]: r for r in L.judged(H.frame(spark, rows)).collect()}
    assert all(kept[k]["kept"] and kept[k]["words_left"] == 15 for k in range(30))
    assert all(kept[100 + k]["kept"] and kept[100 + k]["words_left"] == 18 for k in range(30))
