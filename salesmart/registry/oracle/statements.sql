-- name: union_by_name
SELECT order_id, line_no, shipper_id, shipment_date FROM fx_shipments
-- name: shipments_labeled_union
SELECT order_id, line_no, shipper_id, shipment_date, source_file FROM fx_shipments
-- name: forward_fill
SELECT sheet, row_no, last_value(label IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_no
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label, amount
FROM fx_report_grid
-- name: stringify_columns
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(employee_id AS VARCHAR) AS employee_id, CAST(shipper_id AS VARCHAR) AS shipper_id, order_date,
       CAST(total_order AS VARCHAR) AS total_order
FROM fx_orders
-- name: normalize_schema
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
       o_orderstatus AS order_status, 'Orders.csv' AS source_file_name, 'SALES_FILES' AS source_system
FROM orders
-- name: lineage_rename
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
       o_orderstatus AS order_status, 'Orders.csv' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system
FROM orders
-- name: row_hash
SELECT order_id,
       sha256('customer_id=' || length(CAST(customer_id AS VARCHAR)) || ':' || CAST(customer_id AS VARCHAR)
              || '|amount=' || length(CAST(amount AS VARCHAR)) || ':' || CAST(amount AS VARCHAR)) AS row_hash
FROM fx_merge_source
-- name: cast_conform
SELECT emp_id, office, extension, reports_to, year_salary, hire_date FROM silver_employees WHERE emp_id <> -1
-- name: parse_dates
SELECT 'orders' AS source, order_id AS id, order_date AS parsed_date FROM silver_orders
UNION ALL
SELECT 'customers', customer_id, birth_date FROM silver_customers
-- name: shift_shipment_date
SELECT order_id, line_no, source_file, CAST(strptime(shipment_date, '%-m/%-d/%Y') AS DATE) AS shipment_date_original,
       CAST(CAST(strptime(shipment_date, '%-m/%-d/%Y') AS DATE) + INTERVAL 108 MONTH AS DATE) AS shipment_date
FROM fx_shipments
-- name: reassign_duplicate_key
SELECT * FROM silver_divisions
-- name: null_label
SELECT customer_id, state_province FROM silver_customers
-- name: null_fk_to_unknown
SELECT order_id, employee_id FROM silver_orders
-- name: unknown_member
SELECT * FROM silver_shippers
-- name: unpivot_budget
SELECT * FROM silver_budget
-- name: dedup_shipments
SELECT order_id, line_no, shipper_id, source_file FROM silver_shipments
-- name: dedup_metrics
SELECT count(*) AS rows_before, count(DISTINCT (order_id, line_no)) AS rows_after,
       count(*) - count(DISTINCT (order_id, line_no)) AS removed
FROM fx_shipments
-- name: silver_dim_category
SELECT *, 'categories' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system FROM fx_categories
-- name: silver_dim_product
SELECT * REPLACE (CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(unit_price AS DOUBLE) AS unit_price),
       'products' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system
FROM fx_products
-- name: silver_dim_customer
SELECT *, 'customers' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system FROM silver_customers
-- name: silver_dim_supplier
SELECT *, 'suppliers' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system FROM fx_suppliers
-- name: silver_dim_division
SELECT *, 'divisions' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system FROM silver_divisions
-- name: silver_dim_employee
SELECT *, CASE WHEN emp_id <> -1 THEN 'employees' END AS bronze_source_file_name,
       CASE WHEN emp_id <> -1 THEN 'SALES_FILES' END AS bronze_source_system
FROM silver_employees
-- name: silver_dim_office
SELECT *, 'offices' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system FROM silver_offices
-- name: silver_dim_shipper
SELECT shipper_id, company_name, 'shippers' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system
FROM fx_shippers
UNION ALL SELECT 4, 'Unknown Shipper — Pending Confirmation', NULL, NULL
UNION ALL SELECT 5, 'Unknown Shipper — Pending Confirmation', NULL, NULL
-- name: silver_orders
SELECT *, 'orders' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system FROM silver_orders
-- name: silver_order_details
SELECT order_id, line_no, product_id, CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, 'order_details' AS bronze_source_file_name,
       'SALES_FILES' AS bronze_source_system
FROM silver_lines
-- name: silver_shipments
SELECT *, 'shipments' AS bronze_source_file_name, 'SALES_FILES' AS bronze_source_system FROM silver_shipments
-- name: dim_date
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
       CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%B') AS month_name,
       CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
       strftime(full_date, '%A') AS day_name, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
       CAST(dayofyear(full_date) AS INTEGER) AS day_of_year
FROM gold_dates
-- name: dim_customer
SELECT c.customer_id, c.company_name, c.contact_name, c.city, c.country, c.state_province, c.division_id,
       d.division_name, c.address, c.phone, c.fax, c.postal_code, c.birth_date, 'SALES_FILES' AS bronze_source_system
FROM silver_customers c LEFT JOIN silver_divisions d ON c.division_id = d.division_id
-- name: dim_product
SELECT p.product_id, p.product_name, p.category_id, c.category_name, c.description AS category_description,
       p.supplier_id, p.quantity_per_unit, CAST(p.unit_cost AS DOUBLE) AS unit_cost,
       CAST(p.unit_price AS DOUBLE) AS unit_price, p.units_in_stock, p.units_on_order,
       'SALES_FILES' AS bronze_source_system
FROM fx_products p LEFT JOIN fx_categories c ON p.category_id = c.category_id
-- name: dim_employee
SELECT e.emp_id, e.last_name, e.first_name, e.title, e.hire_date, e.office, o.office_city, o.office_state_province,
       o.office_country, e.reports_to, e.year_salary,
       CASE WHEN e.emp_id <> -1 THEN 'SALES_FILES' END AS bronze_source_system
FROM silver_employees e LEFT JOIN silver_offices o ON e.office = o.office
-- name: dim_supplier
SELECT *, 'SALES_FILES' AS bronze_source_system FROM fx_suppliers
-- name: dim_shipper
SELECT shipper_id, company_name, 'SALES_FILES' AS bronze_source_system FROM fx_shippers
UNION ALL SELECT 4, 'Unknown Shipper — Pending Confirmation', NULL
UNION ALL SELECT 5, 'Unknown Shipper — Pending Confirmation', NULL
-- name: dim_division
SELECT *, 'SALES_FILES' AS bronze_source_system FROM silver_divisions
-- name: gold_passthrough
SELECT order_id, line_no, product_id, CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, 'SALES_FILES' AS bronze_source_system
FROM silver_lines
-- name: fact_sales
SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount,
                  CAST(extended_amount AS DOUBLE) AS extended_amount, CAST(margin AS DOUBLE) AS margin)
FROM gold_sales
-- name: fact_budget
SELECT *, 'SALES_FILES' AS bronze_source_system FROM silver_budget
-- name: cross_file_duplicates
SELECT count(*) AS total_rows, count(DISTINCT (order_id, line_no)) AS distinct_keys,
       count(*) - count(DISTINCT (order_id, line_no)) AS surplus_rows
FROM fx_shipments
-- name: duplicate_keys
SELECT order_id, line_no, count(*) AS row_count FROM fx_shipments GROUP BY order_id, line_no HAVING count(*) > 1
-- name: duplicate_rows
SELECT order_id, line_no, shipper_id, source_file FROM fx_shipments
QUALIFY count(*) OVER (PARTITION BY order_id, line_no) > 1
-- name: conflicting_duplicates
SELECT order_id, line_no, count(DISTINCT shipper_id) AS distinct_shipper_ids
FROM fx_shipments GROUP BY order_id, line_no HAVING count(DISTINCT shipper_id) > 1
-- name: conflicting_rows
SELECT order_id, line_no, shipper_id, source_file FROM fx_shipments
QUALIFY min(shipper_id) OVER (PARTITION BY order_id, line_no) <> max(shipper_id) OVER (PARTITION BY order_id, line_no)
-- name: validate_key
SELECT table_name, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(CASE WHEN k_null THEN n ELSE 0 END) AS BIGINT)
         AS key_nulls, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CASE WHEN sum(CASE WHEN k_null THEN n ELSE 0 END) = 0 AND count(*) FILTER (WHERE n > 1) = 0
            THEN 'CLEAN' ELSE 'REVIEW NEEDED' END AS status
FROM (
  SELECT 'shipments' AS table_name, (order_id IS NULL OR line_no IS NULL) AS k_null, count(*) AS n
  FROM fx_shipments GROUP BY order_id, line_no
  UNION ALL SELECT 'divisions', division_id IS NULL, count(*) FROM fx_divisions GROUP BY division_id
  UNION ALL SELECT 'orders', employee_id IS NULL, count(*) FROM fx_orders GROUP BY employee_id
) t GROUP BY table_name
-- name: gold_validation_summary
SELECT table_name, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(CASE WHEN k_null THEN n ELSE 0 END) AS BIGINT)
         AS key_nulls, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CASE WHEN sum(CASE WHEN k_null THEN n ELSE 0 END) = 0 AND count(*) FILTER (WHERE n > 1) = 0
            THEN 'CLEAN' ELSE 'REVIEW NEEDED' END AS status
FROM (
  SELECT 'dim_date' AS table_name, full_date IS NULL AS k_null, count(*) AS n FROM gold_dates GROUP BY full_date
  UNION ALL
  SELECT 'dim_customer', c.customer_id IS NULL, count(*)
  FROM silver_customers c LEFT JOIN silver_divisions d ON c.division_id = d.division_id GROUP BY c.customer_id
  UNION ALL
  SELECT 'dim_product', p.product_id IS NULL, count(*)
  FROM fx_products p LEFT JOIN fx_categories c ON p.category_id = c.category_id GROUP BY p.product_id
  UNION ALL
  SELECT 'dim_employee', e.emp_id IS NULL, count(*)
  FROM silver_employees e LEFT JOIN silver_offices o ON e.office = o.office GROUP BY e.emp_id
  UNION ALL SELECT 'dim_supplier', supplier_id IS NULL, count(*) FROM fx_suppliers GROUP BY supplier_id
  UNION ALL SELECT 'dim_shipper', shipper_id IS NULL, count(*) FROM silver_shippers GROUP BY shipper_id
  UNION ALL SELECT 'dim_division', division_id IS NULL, count(*) FROM silver_divisions GROUP BY division_id
  UNION ALL
  SELECT 'fact_sales', order_id IS NULL OR line_no IS NULL, count(*) FROM gold_sales GROUP BY order_id, line_no
  UNION ALL
  SELECT 'fact_budget', office IS NULL OR employee_id IS NULL OR year IS NULL, count(*)
  FROM silver_budget GROUP BY office, employee_id, year
) t GROUP BY table_name
-- name: audit_timestamps
SELECT min(CAST(o_orderdate AS DATE)) AS earliest_created_at,
       max(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER)) AS latest_updated_at
FROM orders
-- name: referential_integrity
SELECT DISTINCT 'orders' AS child, 'shipper_id' AS fk, 'shippers' AS parent, CAST(shipper_id AS VARCHAR) AS orphan_value
FROM fx_orders WHERE shipper_id NOT IN (SELECT shipper_id FROM fx_shippers)
-- name: referential_integrity_all
SELECT DISTINCT child, fk, parent, v AS orphan_value FROM (
  SELECT 'orders' AS child, 'shipper_id' AS fk, 'shippers' AS parent, CAST(shipper_id AS VARCHAR) AS v FROM fx_orders
  WHERE CAST(shipper_id AS VARCHAR) NOT IN (SELECT CAST(shipper_id AS VARCHAR) FROM fx_shippers)
  UNION ALL
  SELECT 'shipments', 'shipper_id', 'shippers', CAST(shipper_id AS VARCHAR) FROM fx_shipments
  WHERE CAST(shipper_id AS VARCHAR) NOT IN (SELECT CAST(shipper_id AS VARCHAR) FROM fx_shippers)
  UNION ALL
  SELECT 'orders', 'customer_id', 'customers', CAST(customer_id AS VARCHAR) FROM fx_orders
  WHERE CAST(customer_id AS VARCHAR) NOT IN (SELECT CAST(customer_id AS VARCHAR) FROM fx_customers)
  UNION ALL
  SELECT 'orders', 'employee_id', 'employees', CAST(employee_id AS VARCHAR) FROM fx_orders
  WHERE CAST(employee_id AS VARCHAR) NOT IN (SELECT emp_id FROM fx_employees)
  UNION ALL
  SELECT 'order_details', 'order_id', 'orders', CAST(order_id AS VARCHAR) FROM fx_order_details
  WHERE CAST(order_id AS VARCHAR) NOT IN (SELECT CAST(order_id AS VARCHAR) FROM fx_orders)
  UNION ALL
  SELECT 'order_details', 'product_id', 'products', CAST(product_id AS VARCHAR) FROM fx_order_details
  WHERE CAST(product_id AS VARCHAR) NOT IN (SELECT CAST(product_id AS VARCHAR) FROM fx_products)
  UNION ALL
  SELECT 'products', 'supplier_id', 'suppliers', CAST(supplier_id AS VARCHAR) FROM fx_products
  WHERE CAST(supplier_id AS VARCHAR) NOT IN (SELECT CAST(supplier_id AS VARCHAR) FROM fx_suppliers)
  UNION ALL
  SELECT 'products', 'category_id', 'categories', CAST(category_id AS VARCHAR) FROM fx_products
  WHERE CAST(category_id AS VARCHAR) NOT IN (SELECT CAST(category_id AS VARCHAR) FROM fx_categories)
  UNION ALL
  SELECT 'customers', 'division_id', 'divisions', CAST(division_id AS VARCHAR) FROM fx_customers
  WHERE CAST(division_id AS VARCHAR) NOT IN (SELECT CAST(division_id AS VARCHAR) FROM fx_divisions)
  UNION ALL
  SELECT 'employees', 'office', 'offices', office FROM fx_employees
  WHERE office NOT IN (SELECT office FROM fx_offices)
) t WHERE v IS NOT NULL
-- name: referential_integrity_counts
SELECT child, fk, parent, count(DISTINCT v) FILTER (WHERE side = 0) AS fk_values,
       count(DISTINCT v) FILTER (WHERE side = 1) AS pk_values,
       count(DISTINCT v) FILTER (WHERE side = 0)
         - (count(DISTINCT v) FILTER (WHERE side = 0) + count(DISTINCT v) FILTER (WHERE side = 1) - count(DISTINCT v))
         AS orphan_values
FROM (
  SELECT 'orders' AS child, 'shipper_id' AS fk, 'shippers' AS parent, 0 AS side, CAST(shipper_id AS VARCHAR) AS v
  FROM fx_orders
  UNION ALL SELECT 'orders', 'shipper_id', 'shippers', 1, CAST(shipper_id AS VARCHAR) FROM fx_shippers
  UNION ALL SELECT 'shipments', 'shipper_id', 'shippers', 0, CAST(shipper_id AS VARCHAR) FROM fx_shipments
  UNION ALL SELECT 'shipments', 'shipper_id', 'shippers', 1, CAST(shipper_id AS VARCHAR) FROM fx_shippers
  UNION ALL SELECT 'orders', 'customer_id', 'customers', 0, CAST(customer_id AS VARCHAR) FROM fx_orders
  UNION ALL SELECT 'orders', 'customer_id', 'customers', 1, CAST(customer_id AS VARCHAR) FROM fx_customers
  UNION ALL SELECT 'orders', 'employee_id', 'employees', 0, CAST(employee_id AS VARCHAR) FROM fx_orders
  UNION ALL SELECT 'orders', 'employee_id', 'employees', 1, emp_id FROM fx_employees
  UNION ALL SELECT 'order_details', 'order_id', 'orders', 0, CAST(order_id AS VARCHAR) FROM fx_order_details
  UNION ALL SELECT 'order_details', 'order_id', 'orders', 1, CAST(order_id AS VARCHAR) FROM fx_orders
  UNION ALL SELECT 'order_details', 'product_id', 'products', 0, CAST(product_id AS VARCHAR) FROM fx_order_details
  UNION ALL SELECT 'order_details', 'product_id', 'products', 1, CAST(product_id AS VARCHAR) FROM fx_products
  UNION ALL SELECT 'products', 'supplier_id', 'suppliers', 0, CAST(supplier_id AS VARCHAR) FROM fx_products
  UNION ALL SELECT 'products', 'supplier_id', 'suppliers', 1, CAST(supplier_id AS VARCHAR) FROM fx_suppliers
  UNION ALL SELECT 'products', 'category_id', 'categories', 0, CAST(category_id AS VARCHAR) FROM fx_products
  UNION ALL SELECT 'products', 'category_id', 'categories', 1, CAST(category_id AS VARCHAR) FROM fx_categories
  UNION ALL SELECT 'customers', 'division_id', 'divisions', 0, CAST(division_id AS VARCHAR) FROM fx_customers
  UNION ALL SELECT 'customers', 'division_id', 'divisions', 1, CAST(division_id AS VARCHAR) FROM fx_divisions
  UNION ALL SELECT 'employees', 'office', 'offices', 0, office FROM fx_employees
  UNION ALL SELECT 'employees', 'office', 'offices', 1, office FROM fx_offices
) t WHERE v IS NOT NULL GROUP BY child, fk, parent
-- name: row_count_reconcile
SELECT e.table_name, expected_rows, actual_rows, COALESCE(expected_rows = actual_rows, false) AS counts_match
FROM (
  SELECT 'customers' AS table_name, count(*) AS expected_rows FROM customer
  UNION ALL SELECT 'products', count(*) FROM part
  UNION ALL SELECT 'suppliers', count(*) FROM supplier
  UNION ALL SELECT 'shippers', count(*) FROM supplier
  UNION ALL SELECT 'offices', count(*) FROM region
  UNION ALL SELECT 'employees', count(*) FROM nation
  UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'order_details', count(*) FROM lineitem
  UNION ALL SELECT 'divisions', count(*) + count(*) FILTER (WHERE r_regionkey = 1) FROM region
  UNION ALL SELECT 'categories', count(DISTINCT p_brand) FROM part
  UNION ALL SELECT 'shipments', count(*) + count(*) FILTER (WHERE l_orderkey % 120 = 1) FROM lineitem
) e JOIN (
  SELECT 'customers' AS table_name, count(*) AS actual_rows FROM fx_customers
  UNION ALL SELECT 'products', count(*) FROM fx_products
  UNION ALL SELECT 'suppliers', count(*) FROM fx_suppliers
  UNION ALL SELECT 'shippers', count(*) FROM fx_shippers
  UNION ALL SELECT 'offices', count(*) FROM fx_offices
  UNION ALL SELECT 'employees', count(*) FROM fx_employees
  UNION ALL SELECT 'orders', count(*) FROM fx_orders
  UNION ALL SELECT 'order_details', count(*) FROM fx_order_details
  UNION ALL SELECT 'divisions', count(*) FROM fx_divisions
  UNION ALL SELECT 'categories', count(*) FROM fx_categories
  UNION ALL SELECT 'shipments', count(*) FROM fx_shipments
) a ON e.table_name = a.table_name
-- name: dq_orders
SELECT * FROM dq_orders
-- name: dq_order_details
SELECT * FROM dq_order_details
-- name: dq_shipments
SELECT * FROM dq_shipments
-- name: dq_summary
SELECT * FROM dq_summary
-- name: dq_gate
SELECT rule_failed, severity, count(*) AS violations FROM dq_summary GROUP BY rule_failed, severity
-- name: shipment_before_order
SELECT s.order_id, s.line_no, s.shipment_date, o.order_date
FROM silver_shipments s JOIN silver_orders o ON s.order_id = o.order_id WHERE s.shipment_date < o.order_date
-- name: employee_mismatches
SELECT * FROM mismatches
-- name: mismatch_concentration
SELECT shipment_employee_id, count(*) AS mismatch_count FROM mismatches GROUP BY shipment_employee_id
-- name: employee_default_pattern
SELECT *, round(CAST(mismatch_count AS DOUBLE) * 100 / CAST(total_mismatches AS DOUBLE), 4) AS concentration_pct
FROM default_pattern
-- name: date_range
SELECT min(order_date) AS min_order_date, max(order_date) AS max_order_date FROM silver_orders
-- name: days_to_ship
SELECT * FROM raw_dates
-- name: days_to_ship_stats
SELECT min(days_to_ship) AS min_days, max(days_to_ship) AS max_days, round(avg(days_to_ship), 6) AS avg_days,
       round(stddev_samp(days_to_ship), 6) AS stddev_days, count(*) AS row_count
FROM raw_dates
-- name: days_to_ship_by_file
SELECT source_file, round(avg(days_to_ship), 6) AS avg_days, round(stddev_samp(days_to_ship), 6) AS stddev_days,
       count(*) AS row_count
FROM raw_dates GROUP BY source_file
-- name: date_anomaly_scope
SELECT count(*) FILTER (WHERE days_to_ship < 0) AS negative_lines,
       count(*) FILTER (WHERE days_to_ship >= 0) AS valid_lines, count(*) AS total_lines,
       round(CAST(count(*) FILTER (WHERE days_to_ship < 0) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 4)
         AS affected_pct,
       CASE WHEN count(*) FILTER (WHERE days_to_ship < 0) = 0 THEN 'none'
            WHEN count(*) FILTER (WHERE days_to_ship < 0) = count(*) THEN 'all' ELSE 'partial' END AS verdict
FROM raw_dates
-- name: negative_margin_summary
SELECT count(*) AS total_lines, count(*) FILTER (WHERE margin < 0) AS negative_lines,
       CAST(sum(margin) FILTER (WHERE margin < 0) AS DOUBLE) AS total_loss,
       CAST(sum(extended_amount) AS DOUBLE) AS total_revenue, CAST(sum(margin) AS DOUBLE) AS total_margin,
       round(CAST(count(*) FILTER (WHERE margin < 0) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 4) AS negative_pct,
       round(CAST(abs(sum(margin) FILTER (WHERE margin < 0)) AS DOUBLE) * 100 / CAST(sum(margin) AS DOUBLE), 4)
         AS loss_pct_of_margin
FROM gold_sales
-- name: negative_margin_by_discount
SELECT CAST(discount AS DOUBLE) AS discount, count(*) AS losing_lines, CAST(sum(margin) AS DOUBLE) AS total_loss
FROM gold_sales WHERE margin < 0 GROUP BY discount
-- name: top_loss_products
SELECT t.product_id, losing_lines, CAST(total_loss AS DOUBLE) AS total_loss, product_name
FROM (SELECT product_id, count(*) AS losing_lines, sum(margin) AS total_loss
      FROM gold_sales WHERE margin < 0 GROUP BY product_id) t
JOIN fx_products p ON t.product_id = p.product_id
ORDER BY t.total_loss, t.product_id LIMIT 10
-- name: losing_lines_at_tier
SELECT order_id, line_no, product_name, CAST(quantity AS DOUBLE) AS quantity, CAST(s.unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, CAST(margin AS DOUBLE) AS margin
FROM gold_sales s JOIN fx_products p ON s.product_id = p.product_id
WHERE discount = CAST('0.10' AS DECIMAL(9,4)) AND margin < 0
ORDER BY s.margin, order_id, line_no LIMIT 5
-- name: discount_tier_summary
SELECT CAST(discount AS DOUBLE) AS discount, count(*) AS total_lines, count(*) FILTER (WHERE margin < 0)
         AS losing_lines,
       CAST(sum(margin) AS DOUBLE) AS net_margin, CAST(sum(extended_amount) AS DOUBLE) AS net_revenue
FROM gold_sales GROUP BY discount
-- name: shipper_coverage
SELECT u.shipper_id, company_name FROM (SELECT DISTINCT shipper_id FROM gold_sales) u
LEFT JOIN silver_shippers s ON u.shipper_id = s.shipper_id
-- name: placeholder_shipper_orders
SELECT order_id, line_no, g.shipper_id, company_name, CAST(extended_amount AS DOUBLE) AS extended_amount
FROM gold_sales g JOIN silver_shippers s ON g.shipper_id = s.shipper_id WHERE g.shipper_id IN (4, 5)
-- name: order_value
SELECT order_id, CAST(sum(extended_amount) AS DOUBLE) AS order_value FROM gold_sales GROUP BY order_id
-- name: margin_by_employee
SELECT employee_id, count(*) AS line_count, CAST(sum(extended_amount) AS DOUBLE) AS revenue,
       CAST(sum(margin) AS DOUBLE) AS margin
FROM gold_sales GROUP BY employee_id
-- name: ytd_vs_ly
SELECT a.year, CAST(a.revenue AS DOUBLE) AS revenue, CAST(a.margin AS DOUBLE) AS margin,
       CAST(b.revenue AS DOUBLE) AS last_year_revenue, CAST(b.margin AS DOUBLE) AS last_year_margin
FROM (SELECT CAST(year(order_date) AS INTEGER) AS year, sum(extended_amount) AS revenue, sum(margin) AS margin
      FROM gold_sales WHERE dayofyear(order_date) <= 180 GROUP BY 1) a
LEFT JOIN (SELECT CAST(year(order_date) AS INTEGER) + 1 AS year, sum(extended_amount) AS revenue, sum(margin) AS margin
      FROM gold_sales WHERE dayofyear(order_date) <= 180 GROUP BY 1) b ON a.year = b.year
-- name: findings_table
SELECT 'shippers' AS source, 'Orphan FK' AS type,
       count(*) FILTER (WHERE shipper_id NOT IN (SELECT shipper_id FROM fx_shippers)) AS affected_rows,
       count(*) AS total_rows
FROM (SELECT DISTINCT 'orders' AS child, shipper_id FROM fx_orders
      UNION ALL SELECT DISTINCT 'shipments', shipper_id FROM fx_shipments) used
UNION ALL
SELECT 'divisions', 'Duplicate key', count(*) FILTER (WHERE n > 1), count(*)
FROM (SELECT division_id, count(*) AS n FROM fx_divisions GROUP BY division_id) d
UNION ALL
SELECT 'orders', 'Broken measure', count(*) FILTER (WHERE total_order = 0), count(*) FROM fx_orders
UNION ALL
SELECT 'orders', 'Null FK', count(*) FILTER (WHERE employee_id IS NULL), count(*) FROM fx_orders
UNION ALL
SELECT 'shipments', 'Cross-file duplicate', count(*) - count(DISTINCT (order_id, line_no)), count(*) FROM fx_shipments
UNION ALL
SELECT 'shipments', 'Systemic date anomaly', count(*) FILTER (WHERE days_to_ship < 0), count(*) FROM raw_dates
UNION ALL
SELECT 'order_details', 'Key correction', count(*) FILTER (WHERE n > 1), count(*)
FROM (SELECT order_id, product_id, count(DISTINCT line_no) AS n FROM fx_order_details GROUP BY order_id, product_id) pairs
UNION ALL
SELECT 'products / order_details', 'Price difference', count(*) FILTER (WHERE d.unit_price <> p.unit_price), count(*)
FROM silver_lines d JOIN fx_products p ON d.product_id = p.product_id WHERE d.unit_price IS NOT NULL AND p.unit_price IS NOT NULL
-- name: merge_upsert
SELECT COALESCE(s.order_id, t.order_id) AS order_id, COALESCE(s.customer_id, t.customer_id) AS customer_id,
       CAST(COALESCE(s.amount, t.amount) AS DOUBLE) AS amount,
       sha256('customer_id=' || length(CAST(COALESCE(s.customer_id, t.customer_id) AS VARCHAR)) || ':'
              || CAST(COALESCE(s.customer_id, t.customer_id) AS VARCHAR)
              || '|amount=' || length(CAST(COALESCE(s.amount, t.amount) AS VARCHAR)) || ':'
              || CAST(COALESCE(s.amount, t.amount) AS VARCHAR)) AS row_hash
FROM fx_merge_target t FULL JOIN fx_merge_source s ON t.order_id = s.order_id
-- name: merge_changes
SELECT CASE WHEN s.order_id IS NULL THEN 'kept' WHEN t.order_id IS NULL THEN 'insert'
            WHEN t.customer_id = s.customer_id AND t.amount = s.amount THEN 'unchanged' ELSE 'update' END AS change,
       count(*) AS row_count
FROM fx_merge_target t FULL JOIN fx_merge_source s ON t.order_id = s.order_id GROUP BY 1
-- name: merge_idempotent
SELECT CASE WHEN s.order_id IS NULL THEN 'kept' ELSE 'unchanged' END AS change, count(*) AS row_count
FROM fx_merge_target t FULL JOIN fx_merge_source s ON t.order_id = s.order_id GROUP BY 1
-- name: pipeline_audit
SELECT 'orders' AS table_name, count(s.order_id) AS rows_read, count(*) FILTER (WHERE t.order_id IS NULL) AS rows_inserted,
       count(*) FILTER (WHERE t.order_id = s.order_id AND (t.customer_id, t.amount) IS DISTINCT FROM (s.customer_id, s.amount))
         AS rows_updated,
       count(*) AS rows_total, CAST(0 AS BIGINT) AS duplicate_keys,
       CASE WHEN count(s.order_id) = (SELECT count(*) FROM orders) THEN 'SUCCESS' ELSE 'WARNING' END AS status
FROM fx_merge_target t FULL JOIN fx_merge_source s ON t.order_id = s.order_id
UNION ALL
SELECT 'customers', count(*), 0, 0, count(*), count(*) - count(DISTINCT customer_id),
       CASE WHEN count(*) = (SELECT count(*) FROM customer) THEN 'SUCCESS' ELSE 'WARNING' END
FROM fx_customers
UNION ALL
SELECT 'shipments', CAST(sum(n) AS BIGINT), 0, 0, count(*), count(*) FILTER (WHERE n > 1),
       CASE WHEN sum(n) = (SELECT count(*) FROM lineitem) THEN 'SUCCESS' ELSE 'WARNING' END
FROM (SELECT count(*) AS n FROM fx_shipments GROUP BY order_id, line_no, source_file) k

-- name: dq_parse_failures
SELECT 'order_details' AS table_name, 'quantity' AS column_name, CAST(order_id AS VARCHAR) AS record, quantity AS value
FROM fx_order_details WHERE quantity IS NOT NULL AND TRY_CAST(quantity AS DECIMAL(11,3)) IS NULL
UNION ALL SELECT 'order_details', 'unit_price', CAST(order_id AS VARCHAR), unit_price
FROM fx_order_details WHERE unit_price IS NOT NULL AND TRY_CAST(unit_price AS DECIMAL(12,4)) IS NULL
UNION ALL SELECT 'order_details', 'discount', CAST(order_id AS VARCHAR), discount
FROM fx_order_details WHERE discount IS NOT NULL AND TRY_CAST(discount AS DECIMAL(9,4)) IS NULL
UNION ALL SELECT 'orders', 'order_date', CAST(order_id AS VARCHAR), order_date
FROM fx_orders WHERE order_date IS NOT NULL AND try_strptime(order_date, '%-m/%-d/%Y') IS NULL
UNION ALL SELECT 'shipments', 'shipment_date', CAST(order_id AS VARCHAR), shipment_date
FROM fx_shipments WHERE shipment_date IS NOT NULL AND try_strptime(shipment_date, '%-m/%-d/%Y') IS NULL
UNION ALL SELECT 'customers', 'birth_date', CAST(customer_id AS VARCHAR), birth_date
FROM fx_customers WHERE birth_date IS NOT NULL AND try_strptime(birth_date, '%-m/%-d/%Y') IS NULL
UNION ALL SELECT 'employees', 'emp_id', emp_id, emp_id
FROM fx_employees WHERE emp_id IS NOT NULL AND TRY_CAST(emp_id AS DOUBLE) IS NULL
UNION ALL SELECT 'offices', 'office', office, office
FROM fx_offices WHERE office IS NOT NULL AND TRY_CAST(office AS DOUBLE) IS NULL
