from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from oracle_check import compare, connect

from salesmart.plans.tables import BRONZE_KEYS
from salesmart.registry import checks
from salesmart.registry import queries as registry
from salesmart.registry.fixtures import BUDGET_YEARS

QUERIES = registry.queries()
SQL = checks.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SMALL) is None


def test_entry_points_have_all_of_them():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_profiles_report_every_source(spark):
    for name in ("profile_shape_all", "profile_nulls_all", "key_candidates_all"):
        assert {r.source for r in QUERIES[name](spark, SMALL).select("source").distinct().collect()} == set(BRONZE_KEYS)
    found = {(r.source, r.column_name) for r in QUERIES["key_candidates_all"](spark, SMALL).collect()}
    assert {(source, key) for source, keys in BRONZE_KEYS.items() for key in keys} <= found


def test_budget_sheet_has_every_year(spark):
    out = QUERIES["budget_sheet_repair"](spark, SMALL)
    assert out.columns == ["sheet", "row_no", "office", "employee_id", *BUDGET_YEARS]
    assert out.count() == 25


def test_entry(spark):
    assert entry_points.entry(spark).columns[:2] == ["order_id", "line_no"]
