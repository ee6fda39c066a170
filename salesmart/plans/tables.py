"""Names, keys and relations of the tables of each layer."""

from __future__ import annotations

from salesmart.operators.integrity import ForeignKey
from salesmart.sources.tables import Clustering

# Table names and keys are the contract between the layers.
BRONZE_KEYS = {
    "categories": ["category_id"],
    "products": ["product_id"],
    "customers": ["customer_id"],
    "suppliers": ["supplier_id"],
    "divisions": ["division_id"],
    "employees": ["emp_id"],
    "offices": ["office"],
    "shippers": ["shipper_id"],
    "orders": ["order_id"],
    "order_details": ["order_id", "line_no"],
    "shipments": ["order_id", "line_no"],
    "budget": ["office", "employee_id"],
}

# Exports that repeat a business key: what tells their bronze rows apart, so that a re-load finds each of them again.
BRONZE_ROW_KEYS = {
    "divisions": ["division_id", "division_name"],
    "shipments": ["order_id", "line_no", "source_file"],
}

SILVER_KEYS = {
    "dim_category": ["category_id"],
    "dim_product": ["product_id"],
    "dim_customer": ["customer_id"],
    "dim_supplier": ["supplier_id"],
    "dim_division": ["division_id"],
    "dim_employee": ["emp_id"],
    "dim_office": ["office"],
    "dim_shipper": ["shipper_id"],
    "fact_orders": ["order_id"],
    "fact_order_details": ["order_id", "line_no"],
    "fact_shipments": ["order_id", "line_no"],
    "fact_budget": ["office", "employee_id", "year"],
}

GOLD_KEYS = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "dim_employee": ["emp_id"],
    "dim_supplier": ["supplier_id"],
    "dim_shipper": ["shipper_id"],
    "dim_division": ["division_id"],
    "fact_sales": ["order_id", "line_no"],
    "fact_budget": ["office", "employee_id", "year"],
}

FOREIGN_KEYS = [
    ForeignKey("orders", "shipper_id", "shippers", "shipper_id"),
    ForeignKey("shipments", "shipper_id", "shippers", "shipper_id"),
    ForeignKey("orders", "customer_id", "customers", "customer_id"),
    ForeignKey("orders", "employee_id", "employees", "emp_id"),
    ForeignKey("order_details", "order_id", "orders", "order_id"),
    ForeignKey("order_details", "product_id", "products", "product_id"),
    ForeignKey("products", "supplier_id", "suppliers", "supplier_id"),
    ForeignKey("products", "category_id", "categories", "category_id"),
    ForeignKey("customers", "division_id", "divisions", "division_id"),
    ForeignKey("employees", "office", "offices", "office"),
]

# Tables by order are stored in partitions of so many order numbers, so that a load replaces what it touches, and are dealt to files
# by the order, so that they join without a shuffle.
ORDER_BUCKET = "try_cast(order_id AS BIGINT) DIV 10000000"
BY_ORDER = Clustering(("order_id",), 32)
# Orders of more lines than this are not joined by the order alone.
MOST_LINES = 1000
