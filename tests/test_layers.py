from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from salesmart.plans import analysis, gold, quality, silver
from salesmart.registry.fixtures import SalesSources


def test_employees_get_types_and_the_unknown_member(spark):
    bronze = spark.createDataFrame(
        [("3.0", "L", "F", "Sales", "2010-01-15", "2", "101", None, "bad")],
        "emp_id string, last_name string, first_name string, title string, hire_date string, office string, "
        "extension string, reports_to string, year_salary string",
    )
    assert rows(silver.employee(bronze)) == [
        (-1, "Unknown", "Employee", None, None, None, None, None, None),
        (3, "L", "F", "Sales", date(2010, 1, 15), 2, 101, None, None),
    ]


def test_orders_drop_the_total_and_name_the_unknown_employee(spark):
    bronze = spark.createDataFrame(
        [(1, "4/19/2016", "7.0", 0, "h"), (2, None, None, 0, "h")],
        "order_id int, order_date string, employee_id string, total_order int, row_hash string",
    )
    assert rows(silver.orders(bronze)) == [(1, date(2016, 4, 19), 7), (2, None, -1)]


def test_shipments_one_row_per_line_last_file_wins(spark):
    bronze = spark.createDataFrame(
        [(1, 1, 5, "2/29/2012", "S02"), (1, 1, 1, "2/29/2012", "S03"), (1, 2, 1, "x", "S01")],
        "order_id int, line_no int, shipper_id int, shipment_date string, source_file string",
    )
    assert rows(silver.shipments(bronze).select(
        "order_id", "line_no", "shipper_id", "shipment_date_original", "shipment_date")) == [
        (1, 1, 1, date(2012, 2, 29), date(2021, 2, 28)), (1, 2, 1, None, None),
    ]


def test_budget_unpivot_with_an_all_null_year(spark):
    bronze = spark.createDataFrame([("1", "7", "10.5", None), ("2", "8", None, None)],
                                   "office string, employee_id string, `2017` string, `2018` string")
    assert rows(silver.budget(bronze)) == [(1, 7, 2017, 10.5)]
    mixed = spark.createDataFrame([(1, 7, 10, "3.5")], "office int, employee_id int, `2017` int, `2018` string")
    assert rows(silver.budget(mixed)) == [(1, 7, 2017, 10.0), (1, 7, 2018, 3.5)]


def test_unpivot_then_pivot_is_the_identity(spark):
    wide = [("1", "7", "1", "2"), ("2", "8", "3", None)]
    bronze = spark.createDataFrame(wide, "office string, employee_id string, `2017` string, `2018` string")
    back = silver.budget(bronze).groupBy("office", "employee_id").pivot("year", [2017, 2018]).sum("budget_amount")
    assert rows(back) == [(1, 7, 1.0, 2.0), (2, 8, 3.0, None)]


@pytest.fixture
def star(spark):
    lines = spark.createDataFrame(
        [(1, 1, 10, 2, Decimal("100.00"), Decimal("0.25")), (1, 2, 99, 1, Decimal("5.00"), Decimal("0.00")),
         (2, 1, 10, 0, Decimal("-1.00"), Decimal("1.50"))],
        "order_id int, line_no int, product_id int, quantity int, unit_price decimal(12,2), discount decimal(5,2)")
    orders = spark.createDataFrame(
        [(1, date(2020, 1, 5), 500, 3, 4), (3, None, 1, -1, 1)],
        "order_id int, order_date date, customer_id int, employee_id int, shipper_id int")
    shipments = spark.createDataFrame(
        [(1, 1, 4, date(2020, 1, 1), 2), (1, 2, 1, date(2020, 1, 9), 3)],
        "order_id int, line_no int, shipper_id int, shipment_date date, employee_id int")
    products = spark.createDataFrame([(10, "P", Decimal("90.00"))],
                                     "product_id int, product_name string, unit_cost decimal(12,2)")
    return lines, orders, shipments, products


def test_fact_sales_keeps_every_line(star):
    out = gold.fact_sales(*star)
    assert out.columns == gold.SALES_COLUMNS
    picked = out.select("order_id", "line_no", "customer_id", "shipper_id", "extended_amount", "margin")
    assert rows(picked) == [
        (1, 1, 500, 4, Decimal("150.00"), Decimal("-30.00")),
        (1, 2, 500, 1, Decimal("5.00"), None),
        (2, 1, None, None, Decimal("0.00"), Decimal("0.00")),
    ]


def test_quality_rules(star, spark):
    lines, orders, shipments, products = star
    names = lambda df: sorted((r["order_id"], r["rule_failed"], r["severity"]) for r in df.collect())
    assert names(quality.dq_order_details(lines, products)) == [
        (1, "NEGATIVE_MARGIN", "WARNING"), (1, "ORPHAN_PRODUCT_ID", "ERROR"), (2, "DISCOUNT_OUT_OF_RANGE", "ERROR"),
        (2, "NON_POSITIVE_QUANTITY", "ERROR"), (2, "NON_POSITIVE_UNIT_PRICE", "ERROR"),
    ]
    customers = spark.createDataFrame([(500,), (500,)], "customer_id int")  # a repeated parent is still one parent
    employees = spark.createDataFrame([(3,), (-1,)], "emp_id int")
    shippers = spark.createDataFrame([(1,)], "shipper_id int")
    assert names(quality.dq_orders(orders, customers, employees, shippers)) == [
        (1, "ORPHAN_SHIPPER_ID", "ERROR"), (3, "MISSING_ORDER_DATE", "ERROR"), (3, "ORPHAN_CUSTOMER_ID", "ERROR"),
    ]
    assert names(quality.dq_shipments(shipments, orders, shippers)) == [
        (1, "EMPLOYEE_ID_DEFAULT_PATTERN", "WARNING"), (1, "ORPHAN_SHIPPER_ID", "ERROR"),
        (1, "SHIPMENT_BEFORE_ORDER", "ERROR"),
    ]
    details = {r["rule_failed"]: r["detail"] for r in quality.dq_shipments(shipments, orders, shippers).collect()}
    assert details["SHIPMENT_BEFORE_ORDER"] == "shipment_date 2020-01-01 is earlier than order_date 2020-01-05"
    assert details["EMPLOYEE_ID_DEFAULT_PATTERN"].startswith(
        "shipment_employee_id 2 differs from order_employee_id 3 -- this employee_id accounts for 100.0% of all 1 ")


def test_default_pattern_needs_more_than_half(spark):
    pairs = lambda ids: spark.createDataFrame([(e,) for e in ids], "shipment_employee_id int")
    assert rows(quality.employee_default_pattern(pairs([1, 1, 2, 2]))) == []
    assert rows(quality.employee_default_pattern(pairs([1, 1, 2]))) == [(1, 2, 3, 66.6667)]
    assert rows(quality.employee_default_pattern(pairs([]))) == []
    with pytest.raises(ValueError, match="share"):
        quality.employee_default_pattern(pairs([1]), share=0)


def test_placeholders_close_the_shipper_gap(spark):
    s = SalesSources(spark, SMALL)
    found = quality.dq_orders(s.fact("fact_orders"), s.customers(), s.fact("dim_employee"), s.fact("dim_shipper"))
    assert found.where("rule_failed = 'ORPHAN_SHIPPER_ID'").count() == 0
    raw = quality.dq_orders(s.fact("fact_orders"), s.customers(), s.fact("dim_employee"), s.shippers())
    assert raw.where("rule_failed = 'ORPHAN_SHIPPER_ID'").count() > 0


def test_gate_is_empty_when_all_is_well(star):
    lines, *_ = star
    clean = lines.where("order_id = 1 AND line_no = 1").withColumn("discount", F.lit("0.00").cast("decimal(5,2)"))
    products = lines.select("product_id", F.lit(1).cast("decimal(12,2)").alias("unit_cost")).distinct()
    assert rows(quality.dq_gate({"v": quality.dq_order_details(clean, products)})) == []


def test_anomaly_verdicts(spark):
    frame = lambda days: spark.createDataFrame([(d,) for d in days], "days_to_ship int")
    scope = lambda days: tuple(analysis.date_anomaly_scope(frame(days)).first())
    assert scope([-1, -2]) == (2, 0, 2, 100.0, "all")
    assert scope([-1, 2, None]) == (1, 1, 3, 33.3333, "partial")
    assert scope([0]) == (0, 1, 1, 0.0, "none")


def test_year_to_date_skips_missing_years(spark):
    sales = spark.createDataFrame(
        [(date(2018, 1, 1), 1, 1), (date(2019, 2, 1), 10, 2), (date(2019, 12, 1), 99, 9), (date(2021, 1, 1), 5, 5),
         (None, 7, 7)],
        "order_date date, extended_amount int, margin int")
    assert rows(analysis.year_to_date(sales, 60)) == [
        (2018, 1, 1, None, None), (2019, 10, 2, 1, 1), (2021, 5, 5, None, None),
    ]


def test_top_and_worst_break_ties_by_key(spark):
    sales = spark.createDataFrame(
        [(o, 1, p, 1, 1, "0.10", m) for o, p, m in [(2, 1, -5), (1, 2, -5), (3, 1, -1), (4, 3, 9)]],
        "order_id int, line_no int, product_id int, quantity int, unit_price int, discount string, margin int")
    products = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "product_id int, product_name string")
    top = analysis.top_loss_products(sales, products, 2).collect()
    assert [(r["product_id"], r["total_loss"]) for r in top] == [(1, -6), (2, -5)]
    worst = analysis.worst_lines_at(sales, products, "0.10", 2).collect()
    assert [r["order_id"] for r in worst] == [1, 2]
