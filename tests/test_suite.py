"""Registered queries against DuckDB. A spread of them by default, all with SUITE=all."""

import os

import pytest

from payloom.suite import ORACLES, QUERIES

from compare import compare, oracle

NAMES = sorted(ORACLES)
CHOSEN = NAMES if os.environ.get("SUITE") == "all" else NAMES[::9]


@pytest.fixture(scope="module")
def con(sf):
    pytest.importorskip("duckdb")
    return oracle(sf)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_gives_the_rows_of_its_sql(spark, con, sf, name):
    assert compare(spark, con, sf, name, QUERIES[name], ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 200
