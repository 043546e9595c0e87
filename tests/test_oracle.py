"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from conftest import SMALL_SF

import __spark_entry__ as E

_Q = E.queries()
_O = E.oracle_sql()
_FAST = os.environ.get("LEXIFLOW_ORACLE_ALL", "1") == "1"


@pytest.fixture(scope="module")
def duck():
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    from oracle_check import duck as make
    return make(SMALL_SF)


@pytest.mark.parametrize("name", sorted(_O))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import check
    line, ok = check(spark, duck, SMALL_SF, name, _Q[name], _O[name])
    assert ok, line


@pytest.mark.parametrize("name", sorted(set(_Q) - set(_O)))
def test_rows_only_queries_run(spark, name):
    df = _Q[name](spark, SMALL_SF)
    assert df.count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "xpostag" in df.columns and df.count() > 0
