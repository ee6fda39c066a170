"""Raw files through bronze, silver and gold with stored tables, twice."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows

from salesmart.plans import layers, quality, views
from salesmart.plans.loads import run_loads
from salesmart.plans.tables import GOLD_KEYS

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)

CSV = {
    "Categories.csv": "CategoryID,CategoryName,Description\n1,Tools,All tools\n",
    "Products.csv": "ProductID,ProductName,CategoryID,SupplierID,QuantityPerUnit,UnitCost,UnitPrice,UnitsInStock,"
                    "UnitsOnOrder\n10,Saw,1,1,1 piece,6.00,10.00,5,0\n11,Axe,1,1,1 piece,9.50,10.00,5,0\n",
    "Customers.csv": "CustomerID,CompanyName,ContactName,City,Country,StateProvince,DivisionID,Address,Phone,Fax,"
                     'PostalCode,BirthDate\n1,Süd,A,Wien,Austria,,1,"Ring 1\nHof",1,,1010,1/31/1970\n'
                     "2,North,B,Dallas,USA,TX,2,Main,2,,75001,2/1/1980\n",
    "Divisions.csv": "DivisionID,DivisionName\n1,Europe\n2,North America\n2,Central America\n",
    "Shippers.csv": "ShipperID,CompanyName\n1,Fast\n2,Slow\n3,Safe\n",
    "Orders.csv": "OrderID,OrderDate,CustomerID,EmployeeID,ShipperID,TotalOrder\n1,4/19/2020,1,1,1,0\n"
                  "2,5/1/2020,2,,4,0\n3,6/1/2020,9,1,1,0\n",
    "Order_Details.csv": "OrderID,LineNo,ProductID,Quantity,UnitPrice,Discount\n1,1,10,2,10.00,0.00\n"
                         "1,2,11,1,10.00,0.25\n2,1,10,1,10.00,0.10\n3,1,11,3,10.00,0.00\n",
    "Shipments01.csv": "OrderID,LineNo,ShipmentDate,ShipperID,EmployeeID\n1,1,4/20/2011,1,2\n1,2,4/20/2011,1,2\n",
    "Shipments02.csv": "OrderID,LineNo,ShipmentDate,ShipperID,EmployeeID\n2,1,5/2/2011,5,1\n3,1,6/2/2011,1,1\n",
    "Shipments03.csv": "OrderID,LineNo,ShipmentDate,ShipperID,EmployeeID\n2,1,5/2/2011,1,1\n3,1,6/2/2011,1,1\n",
}
SUPPLIERS = "<s><_empty_><SupplierID>1</SupplierID><CompanyName>Iron</CompanyName></_empty_></s>"
GRIDS = {
    "employees": [["EmpID", "LastName", "FirstName", "Title", "HireDate", "Office", "Extension", "ReportsTo",
                   "YearSalary"],
                  ["1.0", "Lee", "Ann", "Sales", "2010-01-15", "1", "101", "2.0", "30000"],
                  ["2.0", "Poe", "Max", "President", "2009-01-15", "1", "100", None, "90000"]],
    "offices": [["Office", "OfficeCity", "OfficeStateProvince", "OfficeCountry"], ["1", "Wien", None, "Austria"]],
    "budget": [["Budget", None, None], ["Office", "EmployeeID", "2020"], ["1.0", "1", "100"], [None, "2", None],
               [None, None, None]],
}


@pytest.fixture
def sources(spark, tmp_path):
    for name, text in CSV.items():
        (tmp_path / name).write_bytes(text.encode("cp850"))
    (tmp_path / "Suppliers.xml").write_text(SUPPLIERS)
    folder = str(tmp_path)

    def grid(name):
        width = max(map(len, GRIDS[name]))
        cells = ", ".join(f"c{i} string" for i in range(width))
        return lambda: spark.createDataFrame(
            [(name, i, *row) for i, row in enumerate(GRIDS[name])], f"sheet string, row_no int, {cells}")

    plain = {"categories": "Categories", "products": "Products", "customers": "Customers", "divisions": "Divisions",
             "shippers": "Shippers", "orders": "Orders", "order_details": "Order_Details"}
    return [
        *(layers.csv_file(spark, folder, table, f"{name}.csv") for table, name in plain.items()),
        layers.csv_files(spark, folder, "shipments", "Shipments*.csv"),
        layers.xml_file(spark, folder, "suppliers", "Suppliers.xml"),
        layers.sheet("employees", "Employees.xlsx", grid("employees")),
        layers.sheet("offices", "Employees.xlsx", grid("offices")),
        layers.budget_sheet("Budget.xlsx", grid("budget")),
    ]


def test_files_to_star_schema(spark, sources, conf):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    for name in ("e2e_bronze", "e2e_silver", "e2e_gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")

    def run(ts):
        steps = [
            (layers.bronze_specs(sources, "e2e_bronze", ts, "FILES"), 3),
            (layers.silver_specs(spark, "e2e_bronze", "e2e_silver", ts), 3),
            (layers.gold_specs(spark, "e2e_silver", "e2e_gold", ts), 8),
        ]
        results = [r for specs, parallel in steps
                   for r in run_loads(spark, specs, str(ts), ts, "e2e_gold.audit", parallel)]
        assert {r.status for r in results} == {"SUCCESS"}, [(r.table, r.status, r.error) for r in results]
        return {r.table: r for r in results}

    first = run(T1)
    assert first["e2e_bronze.bronze_customers"].rows_read == 2  # one address has a line break
    assert first["e2e_bronze.bronze_shipments"].duplicate_keys == 2
    assert first["e2e_bronze.bronze_divisions"].duplicate_keys == 1
    assert first["e2e_silver.fact_shipments"].duplicate_keys == 0

    sales = spark.table("e2e_gold.fact_sales")
    assert rows(sales.selectExpr("order_id", "line_no", "CAST(shipment_date AS STRING)", "employee_id", "shipper_id",
                                 "CAST(extended_amount AS DOUBLE)", "CAST(margin AS DOUBLE)")) == [
        (1, 1, "2020-04-20", 1, 1, 20.0, 8.0), (1, 2, "2020-04-20", 1, 1, 7.5, -2.0),
        (2, 1, "2020-05-02", -1, 1, 9.0, 3.0), (3, 1, "2020-06-02", 1, 1, 30.0, 1.5),
    ]
    assert rows(spark.table("e2e_gold.dim_division").select("division_id", "division_name")) == [
        (1, "Europe"), (2, "North America"), (6, "Central America"),
    ]
    assert spark.table("e2e_gold.dim_customer").where("state_province = 'N/A (International)'").count() == 1
    assert spark.table("e2e_gold.dim_date").count() == 366
    assert rows(spark.table("e2e_gold.fact_budget").select("office", "employee_id", "year", "budget_amount")) == [
        (1, 1, 2020, 100.0),
    ]
    summary = quality.validation_summary({name: spark.table(f"e2e_gold.{name}") for name in GOLD_KEYS})
    assert {r["status"] for r in summary.collect()} == {"CLEAN"}

    t = lambda name: spark.table(f"e2e_{name}")
    orders, shipments = t("silver.fact_orders"), t("silver.fact_shipments")
    quality.publish_views({
        "dq_orders": quality.dq_orders(orders, t("gold.dim_customer"), t("gold.dim_employee"), t("gold.dim_shipper")),
        "dq_order_details": quality.dq_order_details(t("silver.fact_order_details"), t("gold.dim_product")),
        "dq_shipments": quality.dq_shipments(shipments, orders, t("gold.dim_shipper")),
    })
    found = spark.sql("""SELECT rule_failed, order_id FROM dq_orders UNION ALL
                         SELECT rule_failed, order_id FROM dq_order_details UNION ALL
                         SELECT rule_failed, order_id FROM dq_shipments""")
    assert rows(found) == [
        ("EMPLOYEE_ID_DEFAULT_PATTERN", 1), ("EMPLOYEE_ID_DEFAULT_PATTERN", 1), ("NEGATIVE_MARGIN", 1),
        ("ORPHAN_CUSTOMER_ID", 3),
    ]

    in_code = {view: rows(spark.table(view)) for view in ("dq_orders", "dq_order_details", "dq_shipments")}
    for view in in_code:
        spark.catalog.dropTempView(view)

    # the same views in the catalog, read by another session
    views.create_views(spark, "e2e_silver", "e2e_gold", "e2e_gold")
    other = spark.newSession()
    for view, found in in_code.items():
        assert rows(other.table(f"e2e_gold.{view}")) == found, view
    assert rows(other.sql("SELECT source_view, count(*) FROM e2e_gold.dq_summary GROUP BY source_view")) == [
        (view, len(found)) for view, found in sorted(in_code.items()) if found]

    second = run(T2)
    changed = {t: r.counts for t, r in second.items() if r.counts.rows_inserted or r.counts.rows_updated}
    assert changed == {}
