from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions import values
from salesmart.functions.audit import lineage_from_bronze, normalize_schema, stamp
from salesmart.functions.fingerprint import row_fingerprint
from salesmart.functions.naming import digit_columns, snake_case, snake_case_columns

RUN_TS = datetime(2024, 1, 1)


@pytest.mark.parametrize("name, expected", [
    ("CategoryID", "category_id"),
    ("  Employee ID ", "employee_id"),
    ("order-id", "order_id"),
    ("Unit:Price\\Net/Gross", "unit_price_net_gross"),
    ("XMLFile", "xmlfile"),
    ("Total (EUR)", "total_eur"),
    ("a__b", "a_b"),
    ("_edge_", "_edge_"),
    ("2017", "2017"),
    ("LineNo2Value", "line_no2_value"),
])
def test_snake_case(name, expected):
    assert snake_case(name) == expected


@given(st.text(alphabet="abcXYZ019 _-/:\\%", max_size=20))
def test_snake_case_is_stable(name):
    once = snake_case(name)
    assert snake_case(once) == once
    assert once == once.lower() and "__" not in once


def test_colliding_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`Order ID` int, OrderID int")
    with pytest.raises(ValueError, match="collide"):
        snake_case_columns(df)


def test_normalize_schema_adds_four_audit_columns(spark):
    df = normalize_schema(spark.createDataFrame([(1,)], "OrderID int"), RUN_TS, "Orders.csv", "FILES")
    assert df.columns == ["order_id", "created_at", "updated_at", "source_file_name", "source_system"]
    assert df.first() == (1, RUN_TS, RUN_TS, "Orders.csv", "FILES")


def test_lineage_rename_takes_what_is_there(spark):
    df = stamp(spark.createDataFrame([(1, "h")], "id int, row_hash string"), RUN_TS, "f", "s")
    assert lineage_from_bronze(df).columns == [
        "id", "bronze_created_at", "bronze_updated_at", "bronze_source_file_name", "bronze_source_system",
    ]
    assert lineage_from_bronze(spark.createDataFrame([(1,)], "id int")).columns == ["id"]


def test_digit_columns(spark):
    assert digit_columns(spark.createDataFrame([(1, 2, 3)], "office int, `2017` int, y2018 int")) == ["2017"]


def test_casts_turn_bad_text_into_null(spark):
    df = spark.createDataFrame([("2.0",), ("7",), ("x",), (None,), ("",)], "v string")
    assert [r[0] for r in df.select(values.as_int("v")).collect()] == [2, 7, None, None, None]


def test_dates(spark):
    df = spark.createDataFrame([("4/19/2016",), ("12/31/2020",), ("31/12/2020",), (None,)], "d string")
    assert [r[0] for r in df.select(values.parse_date("d")).collect()] == [
        date(2016, 4, 19), date(2020, 12, 31), None, None,
    ]


def test_shift_is_leap_safe(spark):
    df = spark.createDataFrame([(date(2012, 2, 29),), (date(2010, 5, 1),), (None,)], "d date")
    assert [r[0] for r in df.select(values.shift_months("d")).collect()] == [
        date(2021, 2, 28), date(2019, 5, 1), None,
    ]


def test_null_label_keeps_empty_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("TX",)], "s string")
    assert [r[0] for r in df.select(values.null_to("s", "N/A")).collect()] == ["N/A", "", "TX"]


def test_line_measures_are_exact(spark):
    df = spark.createDataFrame([(3, "1.005", "0.00", "0.50"), (1, "10.00", "0.25", None)],
                               "quantity int, unit_price string, discount string, unit_cost string").select(
        "quantity", *[F.col(c).cast("decimal(12,3)").alias(c) for c in ("unit_price", "discount", "unit_cost")])
    amounts = df.select(values.extended_amount().cast("string"), values.margin().cast("string")).collect()
    # only the result is rounded: 3 * 1.005 is 3.015
    assert [tuple(r) for r in amounts] == [("3.02", "1.52"), ("7.50", None)]


def test_line_measures_keep_decimals_and_never_fail(spark):
    rows = [("1.5", "10", "0", "0"), ("2", "10", "0.125", "0"), ("100", "0.0149", "0", "0"), ("2", "10", "1500", "1"), ("n/a", "10", "0", "1"), ("99999999999", "1", "0", "1")]
    df = spark.createDataFrame(rows, "quantity string, unit_price string, discount string, unit_cost string")
    amounts = [r[0] for r in df.select(values.extended_amount().cast("string")).collect()]
    assert amounts == ["15.00", "17.50", "1.49", "-29980.00", None, None]


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(values.percent(F.col("a"), F.col("b"))).collect()] == [33.3333, None]


def _hashes(spark, data, schema):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(row_fingerprint(df, ["k"])).collect()]


def test_fingerprint_tells_null_from_empty_and_shifted_separators(spark):
    distinct = [
        (1, None, "x"), (1, "", "x"), (1, "~", "x"), (1, "a|b=1:x", ""), (1, "a", "|b=1:x"), (1, "a||b", "c"),
        (1, "a", "b||c"),
    ]
    hashes = _hashes(spark, distinct, "k int, a string, b string")
    assert len(set(hashes)) == len(distinct)


def test_fingerprint_ignores_keys_and_lineage(spark):
    schema = "k int, a string, bronze_updated_at string, source_file_name string"
    first, second, third = _hashes(
        spark, [(1, "v", "t1", "f1"), (2, "v", "t2", "f2"), (1, "w", "t1", "f1")], schema)
    assert first == second != third


def test_fingerprint_covers_every_type(spark, conf):
    schema = ("k int, i int, l long, d double, m decimal(10,2), t timestamp, dt date, b boolean, "
              "arr array<int>, s struct<x:int>, bin binary")
    row = (1, 1, 2, 1.5, None, datetime(2024, 1, 1), date(2024, 1, 1), True, [1, 2], (3,), b"\x01")
    other = (1, 1, 2, 1.5, None, datetime(2024, 1, 1), date(2024, 1, 1), True, [2, 1], (3,), b"\x01")
    utc = _hashes(spark, [row, other], schema)
    assert utc[0] != utc[1]
    frame = spark.createDataFrame([row], schema)
    conf("spark.sql.session.timeZone", "America/New_York")
    assert frame.select(row_fingerprint(frame, ["k"])).first()[0] == utc[0]


def test_reassign_key(spark):
    df = spark.createDataFrame([(2, "North"), (2, "Central"), (3, "Central")], "id int, name string")
    out = df.withColumn("id", values.reassign_key("id", (F.col("id") == 2) & (F.col("name") == "Central"), 6))
    assert rows(out) == [(2, "North"), (3, "Central"), (6, "Central")]


def test_dropped_digits_are_told(spark):
    df = spark.createDataFrame([("1.2345",), ("1.23456",), ("1.23450000",), ("x",), ("123456",), (None,), ("-0.00001",)], "v string")
    assert rows(df.select("v", values.exactly("v", values.DISCOUNT).isNotNull())) == sorted([
        ("1.2345", True), ("1.23456", False), ("1.23450000", True), ("x", False), ("123456", False), (None, False), ("-0.00001", False)], key=repr)


def test_rounded_line_values_are_parse_failures(spark):
    from salesmart.operators.rules import parse_failures
    from salesmart.plans import silver

    lines = spark.createDataFrame([(1, "1", "2.5", "1.23456"), (2, "1.5", "10.00", "0.1")], "order_id int, quantity string, unit_price string, discount string")
    record, parsed = silver.parsed_columns()["order_details"]
    assert rows(parse_failures(lines, "order_details", record, parsed)) == [("order_details", "discount", "1", "1.23456")]
