"""Every registered query against its DuckDB oracle at sf0.001, plus the
driver's smoke entry."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck_connection

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    ok, n, _, _, detail = compare(spark, name, queries()[name], ORACLES[name], SF_SMALL, duck)
    assert ok, detail


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert queries()[name](spark, SF_SMALL).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["dependent", "referenced"]
    assert df.count() == 95
