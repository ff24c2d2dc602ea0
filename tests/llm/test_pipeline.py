import hashlib
from collections import Counter

import corpus_pipeline as P
from martspark.llm import pii
from martspark.llm.common import staged, table
from martspark.llm.queries import tokenizer_path
from tests.llm import helpers as H
from tests.llm import test_line_rules as L
from tests.llm import test_pii as I
from tests.llm import test_simhash as S
from tests.llm.test_bpe import expected

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = [docs]
    for name, stage in P.STAGES:
        out.append(staged(stage(spark, out[-1], SF), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_against_brute_force(spark):
    import numpy as np
    docs, ruled, single, masked, mixed, tokens = stages(spark, table(spark, SF, "documents"))
    for df in (ruled, single, masked, mixed):
        assert df.columns == docs.columns
    judged = {r[0]: r for r in L.brute([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], 20, 0.0, 0.3)}
    assert set(texts(ruled)) == {i for i, r in judged.items() if r[7]}
    prints = {i: S.brute_print(t) for i, t in texts(ruled).items()}
    group = S.brute_groups(prints.values())
    first = {}
    for i in sorted(prints):
        first.setdefault(group[prints[i]], i)
    assert set(texts(single)) == set(first.values())
    before, after = texts(single), texts(masked)
    assert set(before) == set(after)
    field = pii.train(pii.labelled_table(spark))
    for i, t in before.items():
        data = np.frombuffer(t.encode(), np.uint8)
        _, base, more = pii.all_spans(field, data, np.array([0, len(data)]))[0]
        assert pii.joined(base) == pii.joined(I.brute_base(t)) and after[i] == pii.masked(t, base + more)
    rows = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    assert set(rows) <= set(after.items()) and max(Counter(rows).values()) <= 2
    import base64
    import public_tokenizers as T
    import tiktoken
    with open(tokenizer_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert sorted((tuple(r) for r in tokens.collect()), key=str) == expected(enc, rows)


def test_run_gives_the_stages_rows(spark):
    want = stages(spark, table(spark, SF, "documents"))[-1]
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, want.collect()))


def test_clean_documents_stay_and_decisions_take_effect(spark):
    rows = [(i, f"{' '.join(f'word{i * 31 + k}' for k in range(40))}\nwrite to a{i}.b@mail.example.com now") for i in range(30)]
    rows += [(100 + k, rows[3][1]) for k in range(5)] + [(200, "too short"), (201, None)]
    _, ruled, single, masked, mixed, tokens = stages(spark, H.frame(spark, rows))
    assert set(texts(ruled)) == set(range(30)) | set(range(100, 105))
    assert set(texts(single)) == set(range(30))
    assert all("[email]" in t and "@" not in t for t in texts(masked).values())
    assert tokens.count() == mixed.count()
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect())


def test_odd_and_empty(spark):
    odd = H.odd(spark)
    for name, stage in P.STAGES:
        got = stage(spark, odd, SF)
        assert got.count() <= 2 * len(H.ODD) and (name == "tokens" or got.columns == odd.columns)
    assert stages(spark, H.empty(spark))[-1].count() == 0


def test_columns_of_any_name(spark):
    from pyspark.sql import functions as F
    odd = H.odd(spark)
    for i, name in enumerate(("a.b", "back`quote", "carry", "th", "nth", "k_doc_id", "tie", "copies", "two words", "carry.text")):
        odd = odd.withColumn(name if "`" not in name and "." not in name else f"x{i}", F.lit(name))
        if name not in odd.columns:
            odd = odd.withColumnRenamed(f"x{i}", name)
    out = odd
    for name, stage in P.STAGES[:-1]:
        out = staged(stage(spark, out, SF), name)
        assert out.columns == odd.columns
        for r in out.collect():
            assert all(r[c] == c for c in odd.columns[-10:])
    assert P.STAGES[-1][1](spark, out, SF).count() == out.count()


def test_hash_is_of_decoded_text(spark):
    *_, mixed, tokens = stages(spark, table(spark, SF, "documents"))
    assert {r["decoded_sha256"] for r in tokens.collect()} == {hashlib.sha256(r["text"].encode()).hexdigest() for r in mixed.collect()}
