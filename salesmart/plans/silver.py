"""Silver tables: typed, repaired, with the lineage of the layer below."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.audit import lineage_from_bronze
from salesmart.functions.naming import digit_columns
from salesmart.functions.values import (
    ISO_DATE,
    LINE_TYPES,
    NO_STATE_LABEL,
    UNKNOWN_KEY,
    as_int,
    exactly,
    foreign_key_or_unknown,
    null_to,
    parse_date,
    reassign_key,
    shift_months,
)
from salesmart.operators.dedup import keep_latest
from salesmart.sources.members import add_members

# The business decisions of the silver layer.
REPEATED_DIVISION = 2
MOVED_DIVISION_NAME = "Central America"
MOVED_DIVISION_KEY = 6
SHIPPERS_WITHOUT_RECORD = (4, 5)
UNKNOWN_SHIPPER_NAME = "Unknown Shipper — Pending Confirmation"
UNKNOWN_EMPLOYEE = {"emp_id": UNKNOWN_KEY, "last_name": "Unknown", "first_name": "Employee"}

EMPLOYEE_NUMBERS = ("emp_id", "office", "extension", "reports_to", "year_salary")


def as_is(bronze: DataFrame) -> DataFrame:
    """Categories, products and suppliers need no repair."""
    return lineage_from_bronze(bronze)


def division(bronze: DataFrame) -> DataFrame:
    moved = (F.col("division_id") == REPEATED_DIVISION) & (F.col("division_name") == MOVED_DIVISION_NAME)
    return lineage_from_bronze(bronze).withColumn("division_id", reassign_key("division_id", moved, MOVED_DIVISION_KEY))


def customer(bronze: DataFrame) -> DataFrame:
    return lineage_from_bronze(bronze).withColumns({
        "birth_date": parse_date("birth_date"),
        "state_province": null_to("state_province", NO_STATE_LABEL),
    })


def shipper(bronze: DataFrame) -> DataFrame:
    return add_members(
        lineage_from_bronze(bronze),
        [{"shipper_id": key, "company_name": UNKNOWN_SHIPPER_NAME} for key in SHIPPERS_WITHOUT_RECORD],
    )


def conform_employee(df: DataFrame) -> DataFrame:
    return df.withColumns({
        **{name: as_int(name) for name in EMPLOYEE_NUMBERS},
        "hire_date": parse_date("hire_date", ISO_DATE),
    })


def employee(bronze: DataFrame) -> DataFrame:
    return add_members(conform_employee(lineage_from_bronze(bronze)), [UNKNOWN_EMPLOYEE])


def office(bronze: DataFrame) -> DataFrame:
    return lineage_from_bronze(bronze).withColumn("office", as_int("office"))


def orders(bronze: DataFrame) -> DataFrame:
    """The all-zero order total is dropped; the value of an order comes from its lines."""
    return lineage_from_bronze(bronze).drop("total_order").withColumns({
        "order_date": parse_date("order_date"),
        "employee_id": foreign_key_or_unknown("employee_id"),
    })


def order_lines(bronze: DataFrame) -> DataFrame:
    """Typed once here: what cannot be read becomes NULL, what has more digits than its type is rounded, and both become a row of the
    parse-failure rule."""
    return lineage_from_bronze(bronze).withColumns({c: F.col(c).try_cast(t) for c, t in LINE_TYPES.items()})


def correct_shipment_date(df: DataFrame) -> DataFrame:
    """Parse, keep the exported date, and put the corrected one in its place."""
    parsed = parse_date("shipment_date")
    return df.withColumns({"shipment_date_original": parsed, "shipment_date": shift_months(parsed)})


def one_shipment_per_line(df: DataFrame) -> DataFrame:
    """Overlapping exports repeat lines; the row from the last file wins."""
    return keep_latest(df, ["order_id", "line_no"], ["source_file"])


def shipments(bronze: DataFrame) -> DataFrame:
    return correct_shipment_date(one_shipment_per_line(lineage_from_bronze(bronze)))


def budget(bronze: DataFrame) -> DataFrame:
    """One row per office, employee and year; a year without an amount is no row.

    The year columns are made text first, so an all-NULL column cannot break the common type.
    """
    df = lineage_from_bronze(bronze)
    years = digit_columns(df)
    carried = [c for c in df.columns if c not in years]
    lineage = [c for c in carried if c not in ("office", "employee_id")]
    long = df.select(*carried, *[F.col(f"`{y}`").cast("string").alias(y) for y in years]).unpivot(
        carried, years, "year", "budget_amount"
    )
    return long.where(F.col("budget_amount").isNotNull()).select(
        as_int("office").alias("office"),
        as_int("employee_id").alias("employee_id"),
        F.col("year").try_cast("int").alias("year"),
        F.col("budget_amount").try_cast("double").alias("budget_amount"),
        *lineage,
    )


# Builder of each silver table and the bronze table it reads.
BUILDERS = {
    "dim_category": ("categories", as_is),
    "dim_product": ("products", as_is),
    "dim_customer": ("customers", customer),
    "dim_supplier": ("suppliers", as_is),
    "dim_division": ("divisions", division),
    "dim_employee": ("employees", employee),
    "dim_office": ("offices", office),
    "dim_shipper": ("shippers", shipper),
    "fact_orders": ("orders", orders),
    "fact_order_details": ("order_details", order_lines),
    "fact_shipments": ("shipments", shipments),
    "fact_budget": ("budget", budget),
}


def parsed_columns() -> dict[str, tuple[str, dict]]:
    """What this layer reads out of text, by bronze table: the record's key and the typed form of each column."""
    return {
        "employees": ("emp_id", {
            **{name: as_int(name) for name in EMPLOYEE_NUMBERS}, "hire_date": parse_date("hire_date", ISO_DATE)}),
        "offices": ("office", {"office": as_int("office")}),
        "customers": ("customer_id", {"birth_date": parse_date("birth_date")}),
        "orders": ("order_id", {"order_date": parse_date("order_date"), "employee_id": as_int("employee_id")}),
        "order_details": ("order_id", {c: exactly(c, t) for c, t in LINE_TYPES.items()}),
        "shipments": ("order_id", {"shipment_date": parse_date("shipment_date")}),
    }
