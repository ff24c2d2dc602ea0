import base64
import hashlib

import numpy as np
import pytest

from martspark.llm import bpe
from martspark.llm.common import table
from martspark.llm.queries import tokenizer_path
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken
    with open(tokenizer_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(enc, rows):
    out = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def check(df, enc):
    want = expected(enc, [(r[0], r[1]) for r in df.select("doc_id", "text").collect()])
    got = sorted((tuple(r) for r in bpe.encode_decode(df, tokenizer_path()).collect()), key=str)
    assert got == want


def test_tables(spark, library):
    check(table(spark, SF, "documents"), library)


def test_odd_texts(spark, library):
    check(H.odd(spark), library)


def test_empty(spark, library):
    check(H.empty(spark), library)


def test_real_outputs(spark):
    row = bpe.encode_decode(H.frame(spark, [(1, "it's été")]), tokenizer_path(), keep=True).first()
    assert bytes(row["decoded"]).decode() == "it's été" and len(row["ids"]) == row["n_tokens"]
