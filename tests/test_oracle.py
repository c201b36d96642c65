"""Every registered query against its DuckDB oracle, on the small fixture."""

import pytest

import __spark_entry__ as E
from stagewise.plans import registry
from conftest import SF_SMALL
from oracle_harness import compare, duck

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, E.queries()[key], E.oracle_sql().get(key), SF_SMALL, con)
    assert r["ok"] in (True, None), r
    assert r["rows"] >= 0


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())


def test_no_check_compares_nothing(spark, con):
    """Empty results would agree with anything; only the two lists of negative
    curves may be empty."""
    empty = [k for k in KEYS if not con.execute(f"SELECT count(*) FROM ({registry.oracle_sql()[k]}) t").fetchone()[0]]
    assert set(empty) <= {"n10_not_recovered"}


def test_entry_schema_stable(spark):
    a = E.entry(spark)
    b = E.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
    assert a.columns == ["channel", "stage", "applications", "median_hours", "p90_hours"]
