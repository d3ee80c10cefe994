"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from reelscope.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.harness import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert info["ok"], info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
