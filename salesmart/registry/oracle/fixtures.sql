-- Sales sources derived from the given tables. Each oracle statement starts with these.
fx_divisions AS (
  SELECT r_regionkey + 1 AS division_id, r_name AS division_name FROM region
  UNION ALL SELECT r_regionkey + 1, 'Central America' FROM region WHERE r_regionkey = 1
),
fx_customers AS (
  SELECT c_custkey AS customer_id, c_name AS company_name,
         'Contact ' || CAST(c_custkey AS VARCHAR) AS contact_name,
         'City ' || CAST(c_nationkey AS VARCHAR) AS city, n_name AS country,
         CASE WHEN c_nationkey % 5 = 1 THEN 'ST-' || CAST(c_nationkey AS VARCHAR) END AS state_province,
         c_nationkey % 5 + 1 AS division_id,
         CAST(c_custkey AS VARCHAR) || ' Main Street' AS address,
         '555-' || CAST(c_custkey AS VARCHAR) AS phone,
         CASE WHEN c_custkey % 3 = 0 THEN '556-' || CAST(c_custkey AS VARCHAR) END AS fax,
         CAST(c_custkey % 90000 + 10000 AS VARCHAR) AS postal_code,
         CAST(c_custkey % 12 + 1 AS VARCHAR) || '/' || CAST(c_custkey % 28 + 1 AS VARCHAR) || '/'
           || CAST(c_custkey % 50 + 1950 AS VARCHAR) AS birth_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
fx_categories AS (
  SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS category_id, p_brand AS category_name,
         'All ' || p_brand AS description
  FROM part
),
fx_products AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN -1 - p_partkey ELSE p_partkey END AS product_id, p_name AS product_name,
         CAST(substr(p_brand, 7) AS INTEGER) AS category_id, p_partkey % 10 + 1 AS supplier_id,
         CAST(p_size AS VARCHAR) || ' units' AS quantity_per_unit,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 50 AS DECIMAL(12,2)) AS unit_cost,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 60 AS DECIMAL(12,2)) AS unit_price,
         p_size AS units_in_stock, CAST(p_partkey % 20 AS INTEGER) AS units_on_order
  FROM part
),
fx_suppliers AS (SELECT s_suppkey + 1 AS supplier_id, s_name AS company_name FROM supplier),
fx_shippers AS (
  SELECT CASE WHEN s_suppkey + 1 IN (4, 5) THEN -(s_suppkey + 1) ELSE s_suppkey + 1 END AS shipper_id,
         s_name AS company_name
  FROM supplier
),
fx_offices AS (
  SELECT CAST(r_regionkey + 1 AS VARCHAR) AS office, 'City ' || r_name AS office_city,
         CAST(NULL AS VARCHAR) AS office_state_province, r_name AS office_country
  FROM region
),
fx_employees AS (
  SELECT CAST(n_nationkey + 1 AS VARCHAR) || '.0' AS emp_id, 'Last' || CAST(n_nationkey AS VARCHAR) AS last_name,
         n_name AS first_name, CASE WHEN n_nationkey = 1 THEN 'President' ELSE 'Sales' END AS title,
         '2010-0' || CAST(n_nationkey % 9 + 1 AS VARCHAR) || '-15' AS hire_date,
         CAST(n_nationkey % 5 + 1 AS VARCHAR) AS office, CAST(n_nationkey + 100 AS VARCHAR) AS extension,
         CASE WHEN n_nationkey <> 1 THEN '2.0' END AS reports_to,
         CAST(n_nationkey * 1000 + 30000 AS VARCHAR) AS year_salary
  FROM nation
),
fx_orders AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 500 = 7 THEN -1 - o_custkey ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 300 <> 0 THEN CAST(o_orderkey % 25 + 1 AS INTEGER) END AS employee_id,
         o_orderkey % 5 + 1 AS shipper_id,
         CASE WHEN o_orderkey % 701 <> 5 THEN CAST(month(o_orderdate) AS VARCHAR) || '/'
              || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) END AS order_date,
         0 AS total_order
  FROM orders
),
fx_lines AS (
  SELECT *, CAST(l_partkey * 1000 + CAST(l_quantity AS BIGINT) * 10 + l_linenumber AS BIGINT) AS line_no FROM lineitem
),
fx_order_details AS (
  SELECT l_orderkey AS order_id, line_no, l_partkey AS product_id,
         CASE WHEN l_orderkey % 400 = 3 THEN '0' WHEN l_orderkey % 997 = 12 THEN 'n/a'
              WHEN l_orderkey % 350 = 9 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE WHEN l_orderkey % 450 = 4 THEN '0'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
                   || CASE WHEN l_orderkey % 310 = 6 THEN '49' ELSE '' END END AS unit_price,
         CASE WHEN l_orderkey % 600 = 11 THEN '1.5' WHEN l_orderkey % 5003 = 37 THEN '1500'
              ELSE CAST(CAST(l_discount AS DECIMAL(5,2)) AS VARCHAR)
                   || CASE WHEN l_orderkey % 330 = 8 THEN '4' ELSE '' END END AS discount
  FROM fx_lines
),
fx_shipments_base AS (
  SELECT l_orderkey AS order_id, line_no, l_suppkey % 5 + 1 AS shipper_id,
         CAST(CASE WHEN l_orderkey % 15 = 0 THEN 2 WHEN l_orderkey % 97 = 1 THEN (l_orderkey + 1) % 25 + 1
                   ELSE l_orderkey % 25 + 1 END AS INTEGER) AS employee_id,
         CAST(CAST(l_shipdate AS DATE) - INTERVAL 108 MONTH AS DATE) AS d
  FROM fx_lines
),
fx_shipments_all AS (
  SELECT order_id, line_no, shipper_id, employee_id, d,
         'Shipments0' || CAST(order_id % 3 + 1 AS VARCHAR) || '.csv' AS source_file
  FROM fx_shipments_base
  UNION ALL
  SELECT order_id, line_no, CASE WHEN order_id % 360 = 1 THEN shipper_id % 5 + 1 ELSE shipper_id END,
         employee_id, d, 'Shipments03.csv'
  FROM fx_shipments_base WHERE order_id % 120 = 1
),
fx_shipments AS (
  SELECT order_id, line_no, shipper_id, employee_id,
         CAST(month(d) AS VARCHAR) || '/' || CAST(day(d) AS VARCHAR) || '/' || CAST(year(d) AS VARCHAR)
           AS shipment_date,
         source_file
  FROM fx_shipments_all
),
fx_budget AS (
  SELECT CAST(e % 5 + 1 AS VARCHAR) AS office, CAST(e AS VARCHAR) AS employee_id,
         CAST(sum(CASE WHEN y = 1995 THEN p END) AS VARCHAR) AS "1995",
         CAST(sum(CASE WHEN y = 1996 THEN p END) AS VARCHAR) AS "1996",
         CAST(sum(CASE WHEN y = 1997 THEN p END) AS VARCHAR) AS "1997",
         CAST(sum(CASE WHEN y = 1998 THEN p END) AS VARCHAR) AS "1998",
         CAST(sum(CASE WHEN y = 1999 AND e <> 4 THEN p END) AS VARCHAR) AS "1999",
         CAST(sum(CASE WHEN y = 2000 THEN p END) AS VARCHAR) AS "2000",
         CAST(sum(CASE WHEN y = 2001 AND e <> 3 THEN p END) AS VARCHAR) AS "2001"
  FROM (SELECT CAST(o_orderkey % 25 + 1 AS INTEGER) AS e, year(o_orderdate) AS y,
               CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders) t
  GROUP BY e
),
fx_report_grid AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS sheet, o_orderkey AS row_no,
         CASE WHEN o_orderkey % 7 = 0 THEN 'Customer ' || CAST(o_custkey AS VARCHAR) END AS label,
         o_totalprice AS amount
  FROM orders
),
fx_merge_target AS (
  SELECT CASE WHEN o_orderkey % 10 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS order_id, o_custkey AS customer_id,
         CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS DECIMAL(18,2)) AS amount
  FROM orders
),
fx_merge_source AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(CAST(o_totalprice AS DECIMAL(17,2)) + CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2))
           AS amount
  FROM orders
)
