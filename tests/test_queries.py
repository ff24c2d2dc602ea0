"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 25
    assert df.columns[:3] == ["report_name", "plant", "txt"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name not in ORACLES:         # compared with brute force in the tests of its operator; here: whole, and typed
        ids = con.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()
        rows = [r["doc_id"] for r in df.select("doc_id").collect()]
        assert dict(df.dtypes)["doc_id"] == "bigint" and all(t != "void" for _, t in df.dtypes)
        if name == "pipeline":
            assert rows and set(rows) <= {i for i, in ids}
        else:
            assert sorted(rows) == [i for i, in ids]
        return
    ok, msg = compare(df, ORACLES[name], con)
    assert ok, msg
