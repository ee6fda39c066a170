from __future__ import annotations

import csv
import io
from datetime import date

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.operators.fill import forward_fill
from salesmart.operators.unions import labeled_union, union_by_name
from salesmart.sources.calendar import calendar, calendar_attributes, calendar_years
from salesmart.sources.files import (
    count_csv_records,
    count_xml_records,
    read_csv,
    read_matching_csv,
    read_source,
)
from salesmart.sources.grid import header_names, repair_budget_grid
from salesmart.sources.members import add_members
from salesmart.sources.tables import stringify

CUSTOMERS = 'CustomerID,CompanyName,Address\n1,México,"Street 1\nBack yard"\n2,Luleå,"He said ""hi"""\n3,Plain,Road\n'


def _write(path, text, encoding="cp850"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_code_page_and_quoted_line_breaks(spark, tmp_path):
    df = read_source(spark, _write(tmp_path / "Customers.csv", CUSTOMERS), "csv")
    # quotes are doubled in the export; Spark's default escape keeps them
    assert [(r[0], r[1]) for r in df.orderBy("CustomerID").collect()] == [(1, "México"), (2, "Luleå"), (3, "Plain")]
    assert df.where("CustomerID = 1").first()["Address"] == "Street 1\nBack yard"


def test_csv_code_page_needs_the_setting(spark, tmp_path, conf):
    conf("spark.sql.legacy.javaCharsets", "false")
    with pytest.raises(ValueError, match="javaCharsets"):
        read_csv(spark, _write(tmp_path / "c.csv", CUSTOMERS))


def test_csv_with_given_schema(spark, tmp_path):
    df = read_csv(spark, _write(tmp_path / "c.csv", CUSTOMERS), schema="id string, name string, address string")
    assert df.dtypes == [("id", "string"), ("name", "string"), ("address", "string")] and df.count() == 3


def test_unknown_file_type(spark):
    with pytest.raises(ValueError, match="unsupported file type 'xlsx'"):
        read_source(spark, "Budget.xlsx", "xlsx")


def test_xml_rows(spark, tmp_path):
    text = ("<root>\n<_empty_><SupplierID>1</SupplierID><Name>A</Name></_empty_>\n"
            "<_empty_>\n<SupplierID>2</SupplierID></_empty_><_empty_ x='1'><SupplierID>3</SupplierID></_empty_></root>")
    path = _write(tmp_path / "Suppliers.xml", text, "utf-8")
    df = read_source(spark, path, "xml")
    assert sorted(r["SupplierID"] for r in df.collect()) == [1, 2, 3]
    assert rows(count_xml_records(spark, path)) == [("Suppliers.xml", 3)]


def test_matching_files_are_one_labelled_scan(spark, tmp_path):
    for n, extra in (("01", ""), ("02", "2,1\n"), ("03", "2,1\n3,1\n")):
        _write(tmp_path / f"Shipments{n}.csv", "OrderID,LineNo\n1,1\n" + extra)
    _write(tmp_path / "Orders.csv", "OrderID\n9\n")
    df = read_matching_csv(spark, str(tmp_path), "Shipments*.csv")
    assert rows(df.groupBy("source_file").count()) == [
        ("Shipments01.csv", 1), ("Shipments02.csv", 2), ("Shipments03.csv", 3),
    ]
    assert rows(count_csv_records(spark, str(tmp_path), "Shipments*.csv")) == [
        ("Shipments01.csv", 1), ("Shipments02.csv", 2), ("Shipments03.csv", 3),
    ]


def test_files_are_matched_by_column_name(spark, tmp_path):
    _write(tmp_path / "Shipments01.csv", "OrderID,LineNo,ShipperID\n1,1,7\n")
    _write(tmp_path / "Shipments02.csv", "ShipperID,OrderID,LineNo\n5,2,1\n")
    df = read_matching_csv(spark, str(tmp_path), "Shipments*.csv", quoted_breaks=False)
    assert rows(df.select("OrderID", "LineNo", "ShipperID", "source_file")) == [
        (1, 1, 7, "Shipments01.csv"), (2, 1, 5, "Shipments02.csv")]
    _write(tmp_path / "Shipments03.csv", "OrderID,LineNo,ShipperID,Extra\n3,1,2,x\n")
    with pytest.raises(ValueError, match="Extra"):
        read_matching_csv(spark, str(tmp_path), "Shipments*.csv")
    df = read_matching_csv(spark, str(tmp_path), "Shipments*.csv", allow_missing=True)
    assert rows(df.select("OrderID", "Extra")) == [(1, None), (2, None), (3, "x")]


def test_no_matching_file_is_an_error(spark, tmp_path):
    _write(tmp_path / "Orders.csv", "OrderID\n9\n")
    with pytest.raises(Exception):  # noqa: B017 - Spark's inference error or ours, depending on the reader
        read_matching_csv(spark, str(tmp_path), "Shipments*.csv").count()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 99), st.text(alphabet='ab",\n ', max_size=12)), min_size=1, max_size=40))
def test_record_count_equals_a_csv_parser(spark, tmp_path_factory, records):
    """Tiny splits, so that records and quotes straddle them."""
    folder = tmp_path_factory.mktemp("csv")
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\n", quoting=csv.QUOTE_ALL)
    writer.writerows([("id", "text"), *records])
    (folder / "f.csv").write_text(text.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "37")
    try:
        assert rows(count_csv_records(spark, str(folder))) == [("f.csv", len(records))]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_independent_count_agrees_with_the_reader(spark, tmp_path):
    path = _write(tmp_path / "Customers.csv", CUSTOMERS)
    assert rows(count_csv_records(spark, path)) == [("Customers.csv", read_csv(spark, path).count())]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    assert rows(union_by_name([a, b])) == [(1, "x"), (2, "y")]
    assert rows(labeled_union({"f1": a, "f2": b})) == [(1, "x", "f1"), (2, "y", "f2")]


def test_stringify_keeps_null(spark):
    out = stringify(spark.createDataFrame([(1, None), (None, 2.5)], "a int, b double"))
    assert out.dtypes == [("a", "string"), ("b", "string")]
    assert rows(out) == [("1", None), (None, "2.5")]


def test_add_members_fills_the_rest_with_null(spark):
    df = spark.createDataFrame([(1, "A", 5)], "id int, name string, x int")
    assert rows(add_members(df, [{"id": -1, "name": "Unknown"}])) == [(-1, "Unknown", None), (1, "A", 5)]
    with pytest.raises(ValueError, match="unknown columns"):
        add_members(df, [{"nope": 1}])


def test_calendar_covers_whole_years(spark):
    df = spark.createDataFrame([("2019-03-05",), ("2020-11-30",), (None,)], "d string")
    days = calendar_attributes(calendar_years(df, "d"))
    assert days.count() == 365 + 366
    leap = days.where("date_key = 20200229").first()
    assert tuple(leap) == (20200229, date(2020, 2, 29), 2020, 1, 2, "February", 29, 7, "Saturday", 9, 60)
    assert days.agg({"day_of_year": "max"}).first()[0] == 366


def test_budget_sheet(spark):
    grid = spark.createDataFrame([
        ("b", 0, "Title", None, None), ("b", 1, "Office", "EmployeeID", "2017"), ("b", 2, "1.0", "7", "10"),
        ("b", 3, None, "8", None), ("b", 4, "2.0", "9", "30"), ("b", 5, None, None, None), ("b", 6, None, "10", "40"),
    ], "sheet string, row_no int, c0 string, c1 string, c2 string")
    assert header_names(grid, 1) == ["Office", "EmployeeID", "2017"]
    out = repair_budget_grid(grid, ["office", "employee_id", "2017"])
    assert rows(out.drop("sheet")) == [
        (2, "1", "7", "10"), (3, "1", "8", None), (4, "2", "9", "30"), (6, "2", "10", "40"),
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 5))), max_size=40),
       st.integers(1, 7))
def test_forward_fill_equals_a_loop(spark, cells, block_rows):
    data = [(sheet, i, value) for i, (sheet, value) in enumerate(cells)]
    last, expected = {}, []
    for sheet, i, value in data:
        last[sheet] = value if value is not None else last.get(sheet)
        expected.append((sheet, i, last[sheet]))
    df = spark.createDataFrame(data, "sheet string, row_no int, v int").repartition(3)
    assert rows(forward_fill(df, "v", ["sheet"], "row_no", block_rows)) == sorted(expected, key=repr)


def test_calendar_between_two_days(spark):
    assert calendar(spark, "2016-01-01", date(2021, 12, 31)).count() == 2192
    assert rows(calendar(spark, "2020-02-28", "2020-03-01")) == [(date(2020, 2, 28),), (date(2020, 2, 29),), (date(2020, 3, 1),)]
    assert calendar(spark, "2020-02-28", "2020-02-27").count() == 0


def test_calendar_covers_several_sources(spark):
    one = spark.createDataFrame([("2019-12-31",)], "d string")
    two = spark.createDataFrame([(2022,), (None,)], "year int")
    none = spark.createDataFrame([], "d string")
    days = calendar_years(one, "d", (two, F.make_date("year", F.lit(1), F.lit(1))), (none, "d"))
    assert days.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()[:] == (date(2019, 1, 1), date(2022, 12, 31), 1461)
    assert calendar_years(none, "d").count() == 0


def test_a_sheet_without_header_row(spark):
    with pytest.raises(ValueError, match="no row 3"):
        header_names(spark.createDataFrame([("s", 0, "x")], "sheet string, row_no int, c0 string"), 3)


@pytest.mark.parametrize("step", [1, 1_000_003, 5_000_000_000_123])
def test_forward_fill_whatever_the_gaps(spark, step):
    """Rows far apart, also before zero, and a group without a name."""
    data = [(None if i % 2 else "s", (i - 30) * step, i if i % 7 == 0 else None) for i in range(60)]
    last, expected = {}, []
    for sheet, at, value in data:
        last[sheet] = value if value is not None else last.get(sheet)
        expected.append((sheet, at, last[sheet]))
    df = spark.createDataFrame(data, "sheet string, row_no long, v int").repartition(4)
    assert rows(forward_fill(df, "v", ["sheet"], "row_no")) == sorted(expected, key=repr)
