"""Every catalogue query against its DuckDB oracle at sf0.01 (rows, schema, values)."""

import pytest

import __spark_entry__ as entry
from strata.plans.catalog import QUERIES
from strata.plans.oracle import ORACLE
from tests.conftest import SF01
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF01)
    assert r["status"] in ("match", "rows-only"), r
    assert r["spark_rows"] > 0


def test_every_query_has_sql_and_is_registered():
    # learned models: tests/test_recommend.py compares them with brute force
    assert set(QUERIES) - set(ORACLE) == {"als_recommend", "als_rated_scores"} and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs_on_sf0001(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns == ["dep", "total_accidents", "accidents_graves", "taux_graves", "rang_dep"]
