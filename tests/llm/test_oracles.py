import pytest

from martspark.llm import queries as Q
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, name):
    ok, why = compare(Q.QUERIES[name](spark, SF), Q.ORACLES[name], duck(SF))
    assert ok, why
