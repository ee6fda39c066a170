from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.operators import integrity, keys, profile, reconcile
from salesmart.operators.dedup import keep_latest
from salesmart.operators.integrity import ForeignKey

LINES = [(1, 1, "a", 5), (1, 1, "b", 5), (1, 2, "a", 7), (2, 1, "a", 1), (2, 1, "b", 2), (None, 1, "a", 3)]
SCHEMA = "order_id int, line_no int, file string, shipper int"
KEY = ["order_id", "line_no"]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(LINES, SCHEMA)


def test_duplicates(lines):
    assert rows(keys.duplicate_keys(lines, KEY)) == [(1, 1, 2), (2, 1, 2)]
    assert rows(keys.duplicate_rows(lines, KEY).select(SCHEMA_COLUMNS)) == [
        (1, 1, "a", 5), (1, 1, "b", 5), (2, 1, "a", 1), (2, 1, "b", 2),
    ]
    assert rows(keys.duplicate_summary(lines, KEY)) == [(6, 4, 2)]


SCHEMA_COLUMNS = ["order_id", "line_no", "file", "shipper"]


def test_conflicts_are_keys_with_different_values(lines):
    assert rows(keys.conflicting_keys(lines, KEY, "shipper")) == [(2, 1, 2)]
    assert rows(keys.conflicting_rows(lines, KEY, "shipper").select(SCHEMA_COLUMNS)) == [
        (2, 1, "a", 1), (2, 1, "b", 2),
    ]


def test_validate_key(spark, lines):
    assert rows(keys.validate_key(lines, KEY, "t")) == [("t", 6, 1, 2, "REVIEW NEEDED")]
    assert rows(keys.validate_key(lines.limit(1), KEY, "t")) == [("t", 1, 0, 0, "CLEAN")]
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(keys.validate_key(empty, KEY, "t")) == [("t", 0, 0, 0, "CLEAN")]


def test_require_unique_fails_when_run(spark, lines):
    checked = keys.require_unique(lines, KEY, "lines")
    with pytest.raises(Exception, match="lines: 2 repeated key"):
        checked.collect()
    unique = lines.where("file = 'a'")
    assert rows(keys.require_unique(unique, KEY, "lines")) == rows(unique)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from(["f1", "f2", None]), st.one_of(st.none(), st.integers(0, 2))),
    min_size=1, max_size=25,
))
def test_survivor_does_not_depend_on_partitioning(spark, data):
    df = spark.createDataFrame(data, "k int, file string, v int")
    best = {}
    for k, file, v in data:
        rank = (file or "", -1 if v is None else v)
        best[k] = max(best.get(k, rank), rank)
    expected = sorted(((k, f or None, None if v == -1 else v) for k, (f, v) in best.items()), key=repr)
    for parts in (1, 3):
        assert rows(keep_latest(df.repartition(parts), ["k"], ["file"])) == expected


def test_profile(spark):
    df = spark.createDataFrame([(1, "", None), (2, None, None), (2, "x", None)], "id int, code string, gap int")
    assert rows(profile.profile_shape(df, "s")) == [("s", 3, 3)]
    assert rows(profile.profile_nulls(df, "s")) == [
        ("s", "code", 2, 66.6667, False), ("s", "gap", 3, 100.0, True), ("s", "id", 0, 0.0, False),
    ]
    assert rows(profile.key_candidates(df, "s")) == [
        ("s", "code", 3, 3, 0, True), ("s", "id", 3, 2, 1, False),
    ]
    with pytest.raises(ValueError, match="no column"):
        profile.key_candidates(df.select("gap"), "s")


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "id int")
    assert rows(profile.profile_nulls(df, "s")) == [("s", "id", 0, None, False)]
    assert rows(profile.key_candidates(df, "s")) == [("s", "id", 0, 0, 0, True)]


def test_integrity_compares_text_with_numbers(spark):
    tables = {
        "orders": spark.createDataFrame([(1,), (4,), (4,), (None,)], "employee_id int"),
        "employees": spark.createDataFrame([(" 1",), ("2",), (None,)], "emp_id string"),
        "sales": spark.createDataFrame([(1,), (9,)], "employee_id bigint"),
    }
    links = [
        ForeignKey("orders", "employee_id", "employees", "emp_id"),
        ForeignKey("sales", "employee_id", "orders", "employee_id"),
    ]
    assert rows(integrity.orphans(tables, links)) == [
        ("orders", "employee_id", "employees", "4"), ("sales", "employee_id", "orders", "9"),
    ]
    assert rows(integrity.integrity_counts(tables, links)) == [
        ("orders", "employee_id", "employees", 2, 2, 1), ("sales", "employee_id", "orders", 2, 2, 1),
    ]


def test_reconcile(spark):
    expected = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3)], "table_name string, expected_rows bigint")
    actual = spark.createDataFrame([("a", 2), ("b", 9), ("d", 1)], "table_name string, actual_rows bigint")
    assert rows(reconcile.reconcile_counts(expected, actual)) == [
        ("a", 2, 2, True), ("b", 1, 9, False), ("c", 3, None, False), ("d", None, 1, False),
    ]
    counted = reconcile.table_counts({"a": expected, "b": actual.limit(1)}, "n")
    assert rows(counted) == [("a", 3), ("b", 1)]


def test_column_profile_is_one_scan_of_everything(spark):
    df = spark.createDataFrame([(1, "", None, 5), (2, None, None, 5), (2, "x", None, 5), (None, "x", None, 5)], "id int, code string, gap int, office int")
    assert rows(profile.column_profile(df, "s", keys=["office"])) == [
        ("s", "code", 4, 4, 2, 50.0, 3, False), ("s", "gap", 4, 4, 4, 100.0, None, None), ("s", "id", 4, 4, 1, 25.0, 3, False), ("s", "office", 4, 4, 0, 0.0, 1, False)]
    assert rows(profile.column_profile(df.limit(0), "s").select("column_name", "row_count", "null_pct", "is_key")) == [
        ("code", 0, None, True), ("gap", 0, None, None), ("id", 0, None, True), ("office", 0, None, None)]


def test_survivor_of_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (3, None, "c"), (3, None, "d"), (4, 1, "e")], "k int, r int, v string")
    assert rows(keep_latest(df, ["k"], ["r"])) == [(3, None, "d"), (4, 1, "e"), (None, 2, "b")]


def test_key_values_with_many_roles(spark):
    """One value as parent key, as two foreign keys of one table and as a foreign key of another."""
    tables = {
        "p": spark.createDataFrame([(1,), (2,)], "id int"), "a": spark.createDataFrame([(1, 3), (3, 3)], "x long, y int"), "b": spark.createDataFrame([("1 ",), ("9",)], "x string")}
    links = [ForeignKey("a", "x", "p", "id"), ForeignKey("a", "y", "p", "id"), ForeignKey("b", "x", "p", "id")]
    assert rows(integrity.orphans(tables, links)) == [("a", "x", "p", "3"), ("a", "y", "p", "3"), ("b", "x", "p", "9")]
    assert rows(integrity.integrity_counts(tables, links)) == [("a", "x", "p", 2, 2, 1), ("a", "y", "p", 1, 2, 1), ("b", "x", "p", 2, 2, 1)]
