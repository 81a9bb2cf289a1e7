"""Registered queries against their SQL; ALL_QUERIES=1 runs every one of them."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tools.check import connect, difference

from tests.conftest import SMALL

QUICK = ["headline_kpis", "rfm", "cohort_retention", "category_pareto", "mtd_qtd_ytd"]
CHOSEN = list(contract.queries()) if os.environ.get("ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_names_match():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SMALL)
    sql = contract.oracle_sql().get(name)
    assert (difference(df, con, sql) if sql else "") == ""
