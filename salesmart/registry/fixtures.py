"""Sales sources derived from the given tables, with seeded defects.

Every source is a row-local projection of a whole table (plus, where stated, extra copies); nothing is filtered
away, so the work of each query grows with the tables. The same rules are written in SQL in ``oracle/fixtures.sql``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.audit import stamp
from salesmart.functions.values import extended_amount
from salesmart.plans import gold, silver
from salesmart.sources.members import literal_rows

RUN_TS = datetime(2024, 1, 1)
SOURCE_SYSTEM = "SALES_FILES"
BUDGET_YEARS = [str(year) for year in range(1995, 2002)]


# The given line numbers repeat within an order; part and quantity tell the lines apart.
LINE_NO = "l_partkey * 1000 + CAST(l_quantity AS BIGINT) * 10 + l_linenumber AS line_no"


class SalesSources:
    """The raw sources ``fx_*`` over one data directory, and the layers built on them (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A lazy scan; files and schema of a table are listed once per query, however often it is used."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # -- raw sources ------------------------------------------------------------------------------------

    def divisions(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey + 1 AS division_id",
            "explode(if(r_regionkey = 1, array(r_name, 'Central America'), array(r_name))) AS division_name",
        )

    def customers(self) -> DataFrame:
        return self.table("customer").join(self.table("nation"), F.expr("c_nationkey = n_nationkey")).selectExpr(
            "c_custkey AS customer_id",
            "c_name AS company_name",
            "concat('Contact ', c_custkey) AS contact_name",
            "concat('City ', c_nationkey) AS city",
            "n_name AS country",
            "CASE WHEN c_nationkey % 5 = 1 THEN concat('ST-', c_nationkey) END AS state_province",
            "c_nationkey % 5 + 1 AS division_id",
            "concat(c_custkey, ' Main Street') AS address",
            "concat('555-', c_custkey) AS phone",
            "CASE WHEN c_custkey % 3 = 0 THEN concat('556-', c_custkey) END AS fax",
            "CAST(c_custkey % 90000 + 10000 AS STRING) AS postal_code",
            "concat_ws('/', c_custkey % 12 + 1, c_custkey % 28 + 1, c_custkey % 50 + 1950) AS birth_date",
        )

    def categories(self) -> DataFrame:
        return self.table("part").selectExpr(
            "CAST(substring(p_brand, 7) AS INT) AS category_id",
            "p_brand AS category_name",
            "concat('All ', p_brand) AS description",
        ).distinct()

    def products(self) -> DataFrame:
        """Every 97th part sits under another key, which leaves its order lines without a product."""
        return self.table("part").selectExpr(
            "CASE WHEN p_partkey % 97 = 0 THEN -1 - p_partkey ELSE p_partkey END AS product_id",
            "p_name AS product_name",
            "CAST(substring(p_brand, 7) AS INT) AS category_id",
            "p_partkey % 10 + 1 AS supplier_id",
            "concat(p_size, ' units') AS quantity_per_unit",
            "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 50 AS DECIMAL(12,2)) AS unit_cost",
            "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 60 AS DECIMAL(12,2)) AS unit_price",
            "p_size AS units_in_stock",
            "CAST(p_partkey % 20 AS INT) AS units_on_order",
        )

    def suppliers(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey + 1 AS supplier_id", "s_name AS company_name")

    def shippers(self) -> DataFrame:
        """Shippers 4 and 5 have no record under their own number."""
        return self.table("supplier").selectExpr(
            "CASE WHEN s_suppkey + 1 IN (4, 5) THEN -(s_suppkey + 1) ELSE s_suppkey + 1 END AS shipper_id",
            "s_name AS company_name",
        )

    def offices(self) -> DataFrame:
        return self.table("region").selectExpr(
            "CAST(r_regionkey + 1 AS STRING) AS office",
            "concat('City ', r_name) AS office_city",
            "CAST(NULL AS STRING) AS office_state_province",
            "r_name AS office_country",
        )

    def employees(self) -> DataFrame:
        """All text, numbers partly with a spreadsheet's trailing .0."""
        return self.table("nation").selectExpr(
            "concat(n_nationkey + 1, '.0') AS emp_id",
            "concat('Last', n_nationkey) AS last_name",
            "n_name AS first_name",
            "if(n_nationkey = 1, 'President', 'Sales') AS title",
            "concat('2010-0', n_nationkey % 9 + 1, '-15') AS hire_date",
            "CAST(n_nationkey % 5 + 1 AS STRING) AS office",
            "CAST(n_nationkey + 100 AS STRING) AS extension",
            "CASE WHEN n_nationkey <> 1 THEN '2.0' END AS reports_to",
            "CAST(n_nationkey * 1000 + 30000 AS STRING) AS year_salary",
        )

    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "CASE WHEN o_orderkey % 500 = 7 THEN -1 - o_custkey ELSE o_custkey END AS customer_id",
            "CASE WHEN o_orderkey % 300 <> 0 THEN CAST(o_orderkey % 25 + 1 AS INT) END AS employee_id",
            "o_orderkey % 5 + 1 AS shipper_id",
            "CASE WHEN o_orderkey % 701 <> 5"
            " THEN concat_ws('/', month(o_orderdate), day(o_orderdate), year(o_orderdate)) END AS order_date",
            "0 AS total_order",
        )

    def order_details(self) -> DataFrame:
        """All text, as in a file with unreadable cells; some quantities, prices and discounts have more decimals."""
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            LINE_NO,
            "l_partkey AS product_id",
            "CASE WHEN l_orderkey % 400 = 3 THEN '0' WHEN l_orderkey % 997 = 12 THEN 'n/a'"
            " WHEN l_orderkey % 350 = 9 THEN concat(CAST(l_quantity AS INT), '.5') ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity",
            "CASE WHEN l_orderkey % 450 = 4 THEN '0' ELSE concat(CAST(l_extendedprice AS DECIMAL(12,2)), if(l_orderkey % 310 = 6, '49', '')) END AS unit_price",
            "CASE WHEN l_orderkey % 600 = 11 THEN '1.5' WHEN l_orderkey % 5003 = 37 THEN '1500'"
            " ELSE concat(CAST(l_discount AS DECIMAL(5,2)), if(l_orderkey % 330 = 8, '4', '')) END AS discount",
        )

    def shipments(self) -> DataFrame:
        """Three export files. Orders with id % 120 = 1 are exported twice, some of them with another shipper."""
        exported = self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            LINE_NO,
            "CAST(CASE WHEN l_orderkey % 15 = 0 THEN 2 WHEN l_orderkey % 97 = 1 THEN (l_orderkey + 1) % 25 + 1"
            " ELSE l_orderkey % 25 + 1 END AS INT) AS employee_id",
            "l_suppkey % 5 + 1 AS shipper",
            "add_months(CAST(l_shipdate AS DATE), -108) AS day",
            "explode(if(l_orderkey % 120 = 1, array(false, true), array(false))) AS again",
        )
        return exported.selectExpr(
            "order_id",
            "line_no",
            "if(again AND order_id % 360 = 1, shipper % 5 + 1, shipper) AS shipper_id",
            "employee_id",
            "concat_ws('/', month(day), day(day), year(day)) AS shipment_date",
            "if(again, 'Shipments03.csv', concat('Shipments0', order_id % 3 + 1, '.csv')) AS source_file",
        )

    def budget(self) -> DataFrame:
        """Wide budget, one text column per year; two cells stay empty."""
        amounts = self.table("orders").selectExpr(
            "CAST(o_orderkey % 25 + 1 AS INT) AS e",
            "year(o_orderdate) AS y",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
        )
        empty = {"1999": 4, "2001": 3}
        sums = [F.expr(f"CASE WHEN e <> {empty.get(y, 0)} THEN CAST(sum(CASE WHEN y = {y} THEN amount END) AS STRING) END").alias(y) for y in BUDGET_YEARS]
        return amounts.groupBy("e").agg(*sums).selectExpr(
            "CAST(e % 5 + 1 AS STRING) AS office", "CAST(e AS STRING) AS employee_id", *[f"`{y}`" for y in BUDGET_YEARS]
        )

    def budget_grid(self, years: Sequence[str] = BUDGET_YEARS) -> DataFrame:
        """The budget as a report sheet: title row, header row, office only on its first row, a blank tail row."""
        cells = self.budget().selectExpr(
            "'Budget' AS sheet",
            "CAST(office AS INT) * 100 + CAST(employee_id AS INT) AS row_no",
            "CASE WHEN CAST(employee_id AS INT) <= 5 THEN concat(office, '.0') END AS c0",
            "employee_id AS c1",
            *[f"`{year}` AS c{k}" for k, year in enumerate(years, 2)],
        )
        frame = [
            {"sheet": "Budget", "row_no": 0, "c0": "Budget"},
            {"sheet": "Budget", "row_no": 1, "c0": "Office", "c1": "EmployeeID"} | {f"c{k}": year for k, year in enumerate(years, 2)},
            {"sheet": "Budget", "row_no": 9999},
        ]
        return cells.unionByName(literal_rows(self.spark, frame, cells.schema))

    def report_grid(self) -> DataFrame:
        """One sheet per order year; the label stands on every seventh row only."""
        return self.table("orders").selectExpr(
            "CAST(year(o_orderdate) AS STRING) AS sheet",
            "o_orderkey AS row_no",
            "CASE WHEN o_orderkey % 7 = 0 THEN concat('Customer ', o_custkey) END AS label",
            "o_totalprice AS amount",
        )

    def raw_orders(self) -> DataFrame:
        """Orders under the headers of an export."""
        return self.table("orders").selectExpr(
            "o_orderkey AS OrderID", "CAST(o_orderdate AS DATE) AS OrderDate", "o_custkey AS CustomerID",
            "o_orderstatus AS `Order Status`",
        )

    def merge_target(self) -> DataFrame:
        """Every tenth order is stored under a key the batch does not have."""
        return self.table("orders").selectExpr(
            "CASE WHEN o_orderkey % 10 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS order_id",
            "o_custkey AS customer_id",
            "CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DECIMAL(18,2)) AS amount",
        )

    def merge_source(self) -> DataFrame:
        """All orders; every sixth has a changed amount."""
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CAST(CAST(o_totalprice AS DECIMAL(17,2)) + if(o_orderkey % 6 = 0, 1, 0) AS DECIMAL(18,2)) AS amount",
        )

    def raw(self, name: str) -> DataFrame:
        return getattr(self, name)()

    # -- layers -----------------------------------------------------------------------------------------

    def bronze(self, name: str) -> DataFrame:
        return stamp(self.raw(name), RUN_TS, name, SOURCE_SYSTEM)

    def silver(self, name: str, lineage: bool = True) -> DataFrame:
        """``lineage=False`` leaves the load columns out from the start, for facts that drop them anyway."""
        source, build = silver.BUILDERS[name]
        return build(self.bronze(source) if lineage else self.raw(source))

    def fact(self, name: str) -> DataFrame:
        return self.silver(name, lineage=False)

    def gold(self, name: str) -> DataFrame:
        s = self.silver
        return {
            "dim_date": lambda: gold.dim_date(
                self.fact("fact_orders"), silver.correct_shipment_date(self.shipments()), self.fact("fact_budget")),
            "dim_customer": lambda: gold.dim_customer(s("dim_customer"), s("dim_division")),
            "dim_product": lambda: gold.dim_product(s("dim_product"), s("dim_category")),
            "dim_employee": lambda: gold.dim_employee(s("dim_employee"), s("dim_office")),
            "dim_supplier": lambda: gold.passthrough(s("dim_supplier")),
            "dim_shipper": lambda: gold.passthrough(s("dim_shipper")),
            "dim_division": lambda: gold.passthrough(s("dim_division")),
            "fact_sales": lambda: gold.fact_sales(
                *map(self.fact, ("fact_order_details", "fact_orders", "fact_shipments", "dim_product"))
            ),
            "fact_budget": lambda: gold.passthrough(s("fact_budget")),
        }[name]()

    def measured_lines(self) -> DataFrame:
        """The part of the sales fact that margin reports read: no order, no shipment."""
        return gold.with_measures(self.fact("fact_order_details"), self.fact("dim_product"))

    def shipped_lines(self) -> DataFrame:
        """The part of the sales fact that shipper reports read: no product, as neither amount nor shipper needs one."""
        lines = self.fact("fact_order_details").withColumn("extended_amount", extended_amount())
        return gold.with_shipment(lines, self.fact("fact_shipments"))

    def dated_lines(self) -> DataFrame:
        """The part of the sales fact that employee and calendar reports read."""
        return gold.with_order(self.measured_lines(), self.fact("fact_orders"))
