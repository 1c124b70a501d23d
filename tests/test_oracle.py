"""A few registered queries against their check SQL; tests/run_oracle.py runs them all."""

import pytest
from oracle_check import connect, differences

from catalog.queries import QUERIES
from oracle.queries import ORACLE

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(BASE)


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", [
    "sales_monthly", "order_items", "classify_rules", "media_reconciliation",
    "budget_recommendation", "brief_points",
])
def test_against_duckdb(spark, duck, name):
    assert differences(QUERIES[name](spark, BASE), duck, ORACLE[name]) is None
