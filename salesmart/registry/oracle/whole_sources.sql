-- The profiles over all twelve sources and the budget sheet with all its years; a statement may have several names.
-- name: profile_shape profile_shape_all
SELECT 'categories' AS source, count(*) AS row_count, CAST(3 AS BIGINT) AS column_count FROM fx_categories
UNION ALL SELECT 'products', count(*), 9 FROM fx_products
UNION ALL SELECT 'customers', count(*), 12 FROM fx_customers
UNION ALL SELECT 'suppliers', count(*), 2 FROM fx_suppliers
UNION ALL SELECT 'divisions', count(*), 2 FROM fx_divisions
UNION ALL SELECT 'employees', count(*), 9 FROM fx_employees
UNION ALL SELECT 'offices', count(*), 4 FROM fx_offices
UNION ALL SELECT 'shippers', count(*), 2 FROM fx_shippers
UNION ALL SELECT 'orders', count(*), 6 FROM fx_orders
UNION ALL SELECT 'order_details', count(*), 6 FROM fx_order_details
UNION ALL SELECT 'shipments', count(*), 6 FROM fx_shipments
UNION ALL SELECT 'budget', count(*), 9 FROM fx_budget
-- name: profile_nulls profile_nulls_all
SELECT source, column_name, null_count, round(CAST(null_count AS DOUBLE) * 100 / CAST(n AS DOUBLE), 4) AS null_pct,
       null_count = n AS all_null
FROM (
  SELECT 'categories' AS source, column_name, count(*) AS n, count(*) FILTER (WHERE v IS NULL OR v = '') AS null_count
  FROM (SELECT unnest(['category_id', 'category_name', 'description']) AS column_name,
               unnest([CAST(category_id AS VARCHAR), category_name, description]) AS v
        FROM fx_categories) t GROUP BY column_name
  UNION ALL
  SELECT 'products', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['product_id', 'product_name', 'category_id', 'supplier_id', 'quantity_per_unit', 'unit_cost', 'unit_price', 'units_in_stock', 'units_on_order']) AS column_name,
               unnest([CAST(product_id AS VARCHAR), product_name, CAST(category_id AS VARCHAR), CAST(supplier_id AS VARCHAR), quantity_per_unit, CAST(unit_cost AS VARCHAR), CAST(unit_price AS VARCHAR), CAST(units_in_stock AS VARCHAR), CAST(units_on_order AS VARCHAR)]) AS v
        FROM fx_products) t GROUP BY column_name
  UNION ALL
  SELECT 'customers', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['customer_id', 'company_name', 'contact_name', 'city', 'country', 'state_province', 'division_id', 'address', 'phone', 'fax', 'postal_code', 'birth_date']) AS column_name,
               unnest([CAST(customer_id AS VARCHAR), company_name, contact_name, city, country, state_province, CAST(division_id AS VARCHAR), address, phone, fax, postal_code, birth_date]) AS v
        FROM fx_customers) t GROUP BY column_name
  UNION ALL
  SELECT 'suppliers', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['supplier_id', 'company_name']) AS column_name,
               unnest([CAST(supplier_id AS VARCHAR), company_name]) AS v
        FROM fx_suppliers) t GROUP BY column_name
  UNION ALL
  SELECT 'divisions', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['division_id', 'division_name']) AS column_name,
               unnest([CAST(division_id AS VARCHAR), division_name]) AS v
        FROM fx_divisions) t GROUP BY column_name
  UNION ALL
  SELECT 'employees', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['emp_id', 'last_name', 'first_name', 'title', 'hire_date', 'office', 'extension', 'reports_to', 'year_salary']) AS column_name,
               unnest([emp_id, last_name, first_name, title, hire_date, office, extension, reports_to, year_salary]) AS v
        FROM fx_employees) t GROUP BY column_name
  UNION ALL
  SELECT 'offices', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['office', 'office_city', 'office_state_province', 'office_country']) AS column_name,
               unnest([office, office_city, office_state_province, office_country]) AS v
        FROM fx_offices) t GROUP BY column_name
  UNION ALL
  SELECT 'shippers', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['shipper_id', 'company_name']) AS column_name,
               unnest([CAST(shipper_id AS VARCHAR), company_name]) AS v
        FROM fx_shippers) t GROUP BY column_name
  UNION ALL
  SELECT 'orders', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['order_id', 'customer_id', 'employee_id', 'shipper_id', 'order_date', 'total_order']) AS column_name,
               unnest([CAST(order_id AS VARCHAR), CAST(customer_id AS VARCHAR), CAST(employee_id AS VARCHAR), CAST(shipper_id AS VARCHAR), order_date, CAST(total_order AS VARCHAR)]) AS v
        FROM fx_orders) t GROUP BY column_name
  UNION ALL
  SELECT 'order_details', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['order_id', 'line_no', 'product_id', 'quantity', 'unit_price', 'discount']) AS column_name,
               unnest([CAST(order_id AS VARCHAR), CAST(line_no AS VARCHAR), CAST(product_id AS VARCHAR), quantity, unit_price, discount]) AS v
        FROM fx_order_details) t GROUP BY column_name
  UNION ALL
  SELECT 'shipments', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['order_id', 'line_no', 'shipper_id', 'employee_id', 'shipment_date', 'source_file']) AS column_name,
               unnest([CAST(order_id AS VARCHAR), CAST(line_no AS VARCHAR), CAST(shipper_id AS VARCHAR), CAST(employee_id AS VARCHAR), shipment_date, source_file]) AS v
        FROM fx_shipments) t GROUP BY column_name
  UNION ALL
  SELECT 'budget', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = '')
  FROM (SELECT unnest(['office', 'employee_id', '1995', '1996', '1997', '1998', '1999', '2000', '2001']) AS column_name,
               unnest([office, employee_id, "1995", "1996", "1997", "1998", "1999", "2000", "2001"]) AS v
        FROM fx_budget) t GROUP BY column_name
) counted
-- name: key_candidates key_candidates_all
SELECT source, column_name, total_rows, distinct_count, total_rows - distinct_count AS duplicates,
       total_rows = distinct_count AS is_key
FROM (
  SELECT 'categories' AS source, 'category_id' AS column_name, count(*) AS total_rows,
         count(DISTINCT category_id) + max(CASE WHEN category_id IS NULL THEN 1 ELSE 0 END) AS distinct_count FROM fx_categories
  UNION ALL SELECT 'products', 'product_id', count(*), count(DISTINCT product_id) + max(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END) FROM fx_products
  UNION ALL SELECT 'products', 'category_id', count(*), count(DISTINCT category_id) + max(CASE WHEN category_id IS NULL THEN 1 ELSE 0 END) FROM fx_products
  UNION ALL SELECT 'products', 'supplier_id', count(*), count(DISTINCT supplier_id) + max(CASE WHEN supplier_id IS NULL THEN 1 ELSE 0 END) FROM fx_products
  UNION ALL SELECT 'customers', 'customer_id', count(*), count(DISTINCT customer_id) + max(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) FROM fx_customers
  UNION ALL SELECT 'customers', 'division_id', count(*), count(DISTINCT division_id) + max(CASE WHEN division_id IS NULL THEN 1 ELSE 0 END) FROM fx_customers
  UNION ALL SELECT 'customers', 'postal_code', count(*), count(DISTINCT postal_code) + max(CASE WHEN postal_code IS NULL THEN 1 ELSE 0 END) FROM fx_customers
  UNION ALL SELECT 'suppliers', 'supplier_id', count(*), count(DISTINCT supplier_id) + max(CASE WHEN supplier_id IS NULL THEN 1 ELSE 0 END) FROM fx_suppliers
  UNION ALL SELECT 'divisions', 'division_id', count(*), count(DISTINCT division_id) + max(CASE WHEN division_id IS NULL THEN 1 ELSE 0 END) FROM fx_divisions
  UNION ALL SELECT 'employees', 'emp_id', count(*), count(DISTINCT emp_id) + max(CASE WHEN emp_id IS NULL THEN 1 ELSE 0 END) FROM fx_employees
  UNION ALL SELECT 'offices', 'office', count(*), count(DISTINCT office) + max(CASE WHEN office IS NULL THEN 1 ELSE 0 END) FROM fx_offices
  UNION ALL SELECT 'shippers', 'shipper_id', count(*), count(DISTINCT shipper_id) + max(CASE WHEN shipper_id IS NULL THEN 1 ELSE 0 END) FROM fx_shippers
  UNION ALL SELECT 'orders', 'order_id', count(*), count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) FROM fx_orders
  UNION ALL SELECT 'orders', 'customer_id', count(*), count(DISTINCT customer_id) + max(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) FROM fx_orders
  UNION ALL SELECT 'orders', 'employee_id', count(*), count(DISTINCT employee_id) + max(CASE WHEN employee_id IS NULL THEN 1 ELSE 0 END) FROM fx_orders
  UNION ALL SELECT 'orders', 'shipper_id', count(*), count(DISTINCT shipper_id) + max(CASE WHEN shipper_id IS NULL THEN 1 ELSE 0 END) FROM fx_orders
  UNION ALL SELECT 'order_details', 'order_id', count(*), count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) FROM fx_order_details
  UNION ALL SELECT 'order_details', 'line_no', count(*), count(DISTINCT line_no) + max(CASE WHEN line_no IS NULL THEN 1 ELSE 0 END) FROM fx_order_details
  UNION ALL SELECT 'order_details', 'product_id', count(*), count(DISTINCT product_id) + max(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END) FROM fx_order_details
  UNION ALL SELECT 'shipments', 'order_id', count(*), count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) FROM fx_shipments
  UNION ALL SELECT 'shipments', 'line_no', count(*), count(DISTINCT line_no) + max(CASE WHEN line_no IS NULL THEN 1 ELSE 0 END) FROM fx_shipments
  UNION ALL SELECT 'shipments', 'shipper_id', count(*), count(DISTINCT shipper_id) + max(CASE WHEN shipper_id IS NULL THEN 1 ELSE 0 END) FROM fx_shipments
  UNION ALL SELECT 'shipments', 'employee_id', count(*), count(DISTINCT employee_id) + max(CASE WHEN employee_id IS NULL THEN 1 ELSE 0 END) FROM fx_shipments
  UNION ALL SELECT 'budget', 'office', count(*), count(DISTINCT office) + max(CASE WHEN office IS NULL THEN 1 ELSE 0 END) FROM fx_budget
  UNION ALL SELECT 'budget', 'employee_id', count(*), count(DISTINCT employee_id) + max(CASE WHEN employee_id IS NULL THEN 1 ELSE 0 END) FROM fx_budget
) counted
-- name: budget_grid_repair budget_sheet_repair
SELECT sheet, row_no, regexp_replace(last_value(c0 IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_no
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '\.0+$', '') AS office, c1 AS employee_id,
       "1995", "1996", "1997", "1998", "1999", "2000", "2001"
FROM (
  SELECT 'Budget' AS sheet, CAST(office AS INTEGER) * 100 + CAST(employee_id AS INTEGER) AS row_no,
         CASE WHEN CAST(employee_id AS INTEGER) <= 5 THEN office || '.0' END AS c0, employee_id AS c1,
         "1995", "1996", "1997", "1998", "1999", "2000", "2001"
  FROM fx_budget
  UNION ALL SELECT 'Budget', 0, 'Budget', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  UNION ALL SELECT 'Budget', 1, 'Office', 'EmployeeID', '1995', '1996', '1997', '1998', '1999', '2000', '2001'
  UNION ALL SELECT 'Budget', 9999, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
) sheet_rows
WHERE row_no > 1 AND NOT (c0 IS NULL AND c1 IS NULL AND "1995" IS NULL AND "1996" IS NULL AND "1997" IS NULL AND "1998" IS NULL AND "1999" IS NULL AND "2000" IS NULL AND "2001" IS NULL)

-- name: column_profile
SELECT source, column_name, CAST(column_count AS BIGINT) AS column_count, n AS row_count, null_count,
       round(CAST(null_count AS DOUBLE) * 100 / CAST(n AS DOUBLE), 4) AS null_pct,
       CASE WHEN key_like THEN values_n END AS distinct_count, CASE WHEN key_like THEN values_n = n END AS is_key
FROM (
  SELECT *, contains(column_name, 'id') OR contains(column_name, 'code') OR contains(column_name, 'number') OR contains(column_name, 'key')
         OR column_name = 'line_no' OR (column_name = 'office' AND source IN ('offices', 'budget')) AS key_like
  FROM (
  SELECT 'categories' AS source, column_name, count(*) AS n, count(*) FILTER (WHERE v IS NULL OR v = '') AS null_count, count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS values_n, 3 AS column_count
  FROM (SELECT unnest(['category_id', 'category_name', 'description']) AS column_name,
               unnest([CAST(category_id AS VARCHAR), category_name, description]) AS v
        FROM fx_categories) t GROUP BY column_name
  UNION ALL
  SELECT 'products', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 9
  FROM (SELECT unnest(['product_id', 'product_name', 'category_id', 'supplier_id', 'quantity_per_unit', 'unit_cost', 'unit_price', 'units_in_stock', 'units_on_order']) AS column_name,
               unnest([CAST(product_id AS VARCHAR), product_name, CAST(category_id AS VARCHAR), CAST(supplier_id AS VARCHAR), quantity_per_unit, CAST(unit_cost AS VARCHAR), CAST(unit_price AS VARCHAR), CAST(units_in_stock AS VARCHAR), CAST(units_on_order AS VARCHAR)]) AS v
        FROM fx_products) t GROUP BY column_name
  UNION ALL
  SELECT 'customers', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 12
  FROM (SELECT unnest(['customer_id', 'company_name', 'contact_name', 'city', 'country', 'state_province', 'division_id', 'address', 'phone', 'fax', 'postal_code', 'birth_date']) AS column_name,
               unnest([CAST(customer_id AS VARCHAR), company_name, contact_name, city, country, state_province, CAST(division_id AS VARCHAR), address, phone, fax, postal_code, birth_date]) AS v
        FROM fx_customers) t GROUP BY column_name
  UNION ALL
  SELECT 'suppliers', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 2
  FROM (SELECT unnest(['supplier_id', 'company_name']) AS column_name,
               unnest([CAST(supplier_id AS VARCHAR), company_name]) AS v
        FROM fx_suppliers) t GROUP BY column_name
  UNION ALL
  SELECT 'divisions', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 2
  FROM (SELECT unnest(['division_id', 'division_name']) AS column_name,
               unnest([CAST(division_id AS VARCHAR), division_name]) AS v
        FROM fx_divisions) t GROUP BY column_name
  UNION ALL
  SELECT 'employees', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 9
  FROM (SELECT unnest(['emp_id', 'last_name', 'first_name', 'title', 'hire_date', 'office', 'extension', 'reports_to', 'year_salary']) AS column_name,
               unnest([emp_id, last_name, first_name, title, hire_date, office, extension, reports_to, year_salary]) AS v
        FROM fx_employees) t GROUP BY column_name
  UNION ALL
  SELECT 'offices', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 4
  FROM (SELECT unnest(['office', 'office_city', 'office_state_province', 'office_country']) AS column_name,
               unnest([office, office_city, office_state_province, office_country]) AS v
        FROM fx_offices) t GROUP BY column_name
  UNION ALL
  SELECT 'shippers', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 2
  FROM (SELECT unnest(['shipper_id', 'company_name']) AS column_name,
               unnest([CAST(shipper_id AS VARCHAR), company_name]) AS v
        FROM fx_shippers) t GROUP BY column_name
  UNION ALL
  SELECT 'orders', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 6
  FROM (SELECT unnest(['order_id', 'customer_id', 'employee_id', 'shipper_id', 'order_date', 'total_order']) AS column_name,
               unnest([CAST(order_id AS VARCHAR), CAST(customer_id AS VARCHAR), CAST(employee_id AS VARCHAR), CAST(shipper_id AS VARCHAR), order_date, CAST(total_order AS VARCHAR)]) AS v
        FROM fx_orders) t GROUP BY column_name
  UNION ALL
  SELECT 'order_details', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 6
  FROM (SELECT unnest(['order_id', 'line_no', 'product_id', 'quantity', 'unit_price', 'discount']) AS column_name,
               unnest([CAST(order_id AS VARCHAR), CAST(line_no AS VARCHAR), CAST(product_id AS VARCHAR), quantity, unit_price, discount]) AS v
        FROM fx_order_details) t GROUP BY column_name
  UNION ALL
  SELECT 'shipments', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 6
  FROM (SELECT unnest(['order_id', 'line_no', 'shipper_id', 'employee_id', 'shipment_date', 'source_file']) AS column_name,
               unnest([CAST(order_id AS VARCHAR), CAST(line_no AS VARCHAR), CAST(shipper_id AS VARCHAR), CAST(employee_id AS VARCHAR), shipment_date, source_file]) AS v
        FROM fx_shipments) t GROUP BY column_name
  UNION ALL
  SELECT 'budget', column_name, count(*), count(*) FILTER (WHERE v IS NULL OR v = ''), count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 9
  FROM (SELECT unnest(['office', 'employee_id', '1995', '1996', '1997', '1998', '1999', '2000', '2001']) AS column_name,
               unnest([office, employee_id, "1995", "1996", "1997", "1998", "1999", "2000", "2001"]) AS v
        FROM fx_budget) t GROUP BY column_name
  ) columns_counted
) judged
