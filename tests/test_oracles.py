"""Every registered query equals its DuckDB oracle (sf0.001 here; the
driver and scripts/check_oracle.py run the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tabulae.catalog.all import CATALOG

from conftest import SF001
from oracle_compare import compare, duck

SQL = {n: s for n, s in E.oracle_sql().items() if n in CATALOG}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF001), con, SQL[name])
    assert ok, msg
