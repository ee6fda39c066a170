"""The star schema: dimensions flattened once, facts at line grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.values import extended_amount, margin
from salesmart.operators.joins import splittable_join
from salesmart.sources.calendar import calendar_attributes, calendar_years

# Output columns.
CUSTOMER_COLUMNS = [
    "customer_id", "company_name", "contact_name", "city", "country", "state_province", "division_id",
    "division_name", "address", "phone", "fax", "postal_code", "birth_date", "bronze_source_system",
]
PRODUCT_COLUMNS = [
    "product_id", "product_name", "category_id", "category_name", "category_description", "supplier_id",
    "quantity_per_unit", "unit_cost", "unit_price", "units_in_stock", "units_on_order", "bronze_source_system",
]
EMPLOYEE_COLUMNS = [
    "emp_id", "last_name", "first_name", "title", "hire_date", "office", "office_city", "office_state_province",
    "office_country", "reports_to", "year_salary", "bronze_source_system",
]
SALES_COLUMNS = [
    "order_id", "line_no", "order_date", "shipment_date", "customer_id", "employee_id", "product_id", "shipper_id",
    "quantity", "unit_price", "discount", "extended_amount", "margin",
]
# Load metadata of the layers below; the audit log holds it, the star schema keeps the source system only.
LOAD_METADATA = [
    "created_at", "updated_at", "row_hash", "bronze_created_at", "bronze_updated_at", "bronze_source_file_name",
]

LINE_KEY = ["order_id", "line_no"]


def dim_date(orders: DataFrame, shipments: DataFrame, budget: DataFrame) -> DataFrame:
    """Every day of the years in which something was ordered, shipped or budgeted, and of the years between."""
    budgeted = F.make_date("year", F.lit(1), F.lit(1))
    return calendar_attributes(calendar_years(orders, "order_date", (shipments, "shipment_date"), (budget, budgeted)))


def dim_customer(customers: DataFrame, divisions: DataFrame) -> DataFrame:
    return customers.join(divisions.select("division_id", "division_name"), "division_id", "left").select(
        CUSTOMER_COLUMNS
    )


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    category = categories.select("category_id", "category_name", "description")
    return (
        products.join(category, "category_id", "left")
        .withColumnRenamed("description", "category_description")
        .select(PRODUCT_COLUMNS)
    )


def dim_employee(employees: DataFrame, offices: DataFrame) -> DataFrame:
    office = offices.select("office", "office_city", "office_state_province", "office_country")
    return employees.join(office, "office", "left").select(EMPLOYEE_COLUMNS)


def passthrough(silver: DataFrame) -> DataFrame:
    """Suppliers, shippers, divisions and budgets: business columns as they are, load metadata off."""
    return silver.drop(*LOAD_METADATA)


def with_order(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(orders.select("order_id", "order_date", "customer_id", "employee_id"), "order_id", "left")


def with_shipment(lines: DataFrame, shipments: DataFrame, by_order: bool = False) -> DataFrame:
    """Shipper and corrected date of the line; the other shipment columns would be a second truth.

    Shipments are as many as the lines, so they are never a side to broadcast, whatever their files' size says. With
    ``by_order`` the rows of an order meet by the order alone, as they are stored, and the line numbers are compared among
    them; that is for orders of few lines.
    """
    shipped = shipments.select(*LINE_KEY, "shipper_id", "shipment_date")
    if not by_order:
        return splittable_join(lines, shipped.hint("merge"), LINE_KEY, "left")
    ours, theirs = lines.alias("l"), shipped.alias("s").hint("merge")
    # two comparisons, as an equality would become part of the key that rows are shuffled by
    same_line = (F.col("l.line_no") <= F.col("s.line_no")) & (F.col("l.line_no") >= F.col("s.line_no"))
    joined = ours.join(theirs, (F.col("l.order_id") == F.col("s.order_id")) & same_line, "left")
    return joined.select("l.*", "s.shipper_id", "s.shipment_date")


def with_measures(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and margin per line, computed once here rather than in every report."""
    return lines.join(products.select("product_id", "unit_cost"), "product_id", "left").withColumns({
        "extended_amount": extended_amount(),
        "margin": margin(),
    })


def fact_sales(lines: DataFrame, orders: DataFrame, shipments: DataFrame, products: DataFrame, by_order: bool = False) -> DataFrame:
    """Lines with their order, shipment and measures.

    All joins are left joins, so a line never drops out; the right-hand keys are unique by construction or
    checked at load time. Reports that need only some of the columns compose the same steps without the rest.
    ``by_order``: the three facts are stored clustered by the order, and are joined as they lie there, without a shuffle;
    the products, if too many to broadcast, come last.
    """
    if by_order:
        placed = with_shipment(with_order(lines, orders.hint("merge")), shipments, by_order=True)
        return with_measures(placed, products).select(SALES_COLUMNS)
    return with_shipment(with_order(with_measures(lines, products), orders), shipments).select(SALES_COLUMNS)
