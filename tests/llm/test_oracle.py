"""The queries that SQL can express against DuckDB, on the whole tables of sf0.01."""

import pytest

from strata.llm.queries import ORACLE, QUERIES
from tests.conftest import SF01
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert r["status"] == "match" and r["spark_rows"] > 0, r
