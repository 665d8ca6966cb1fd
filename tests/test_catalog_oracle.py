"""Tier 1: every catalog query equals its DuckDB SQL on the supplied tables."""

import pytest

from conftest import SF_ORACLE
from ledgerline.plans.catalog import oracle_sql, queries
from oracle import compare, duck

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(queries()[name](spark, SF_ORACLE), con, oracle_sql()[name])
    assert res["spark_rows"] > 0, res
    assert res["columns_match"], res
    assert res["spark_rows"] == res["duck_rows"], res
    assert res["match"], res
