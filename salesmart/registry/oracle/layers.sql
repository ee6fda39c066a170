-- The silver and gold layers in SQL.
silver_lines AS (
  SELECT * REPLACE (TRY_CAST(quantity AS DECIMAL(11,3)) AS quantity, TRY_CAST(unit_price AS DECIMAL(12,4)) AS unit_price,
                    TRY_CAST(discount AS DECIMAL(9,4)) AS discount)
  FROM fx_order_details
),
silver_customers AS (
  SELECT * REPLACE (COALESCE(state_province, 'N/A (International)') AS state_province,
                    CAST(try_strptime(birth_date, '%-m/%-d/%Y') AS DATE) AS birth_date)
  FROM fx_customers
),
silver_divisions AS (
  SELECT CASE WHEN division_id = 2 AND division_name = 'Central America' THEN 6 ELSE division_id END AS division_id,
         division_name
  FROM fx_divisions
),
silver_employees AS (
  SELECT CAST(TRY_CAST(emp_id AS DOUBLE) AS BIGINT) AS emp_id, last_name, first_name, title,
         CAST(hire_date AS DATE) AS hire_date, CAST(office AS BIGINT) AS office,
         CAST(extension AS BIGINT) AS extension, CAST(TRY_CAST(reports_to AS DOUBLE) AS BIGINT) AS reports_to,
         CAST(year_salary AS BIGINT) AS year_salary
  FROM fx_employees
  UNION ALL SELECT -1, 'Unknown', 'Employee', NULL, NULL, NULL, NULL, NULL, NULL
),
silver_offices AS (SELECT * REPLACE (CAST(office AS BIGINT) AS office) FROM fx_offices),
silver_shippers AS (
  SELECT shipper_id, company_name FROM fx_shippers
  UNION ALL SELECT 4, 'Unknown Shipper — Pending Confirmation'
  UNION ALL SELECT 5, 'Unknown Shipper — Pending Confirmation'
),
silver_orders AS (
  SELECT order_id, customer_id, CAST(COALESCE(employee_id, -1) AS BIGINT) AS employee_id, shipper_id,
         CAST(try_strptime(order_date, '%-m/%-d/%Y') AS DATE) AS order_date
  FROM fx_orders
),
silver_shipments AS (
  SELECT order_id, line_no, shipper_id, employee_id,
         CAST(CAST(strptime(shipment_date, '%-m/%-d/%Y') AS DATE) + INTERVAL 108 MONTH AS DATE) AS shipment_date,
         source_file, CAST(strptime(shipment_date, '%-m/%-d/%Y') AS DATE) AS shipment_date_original
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_no
                    ORDER BY source_file DESC, shipper_id DESC, employee_id DESC, shipment_date DESC) AS rn
        FROM fx_shipments) ranked
  WHERE rn = 1
),
silver_budget AS (
  SELECT CAST(office AS BIGINT) AS office, CAST(employee_id AS BIGINT) AS employee_id,
         CAST(year AS INTEGER) AS year, CAST(budget_amount AS DOUBLE) AS budget_amount
  FROM (
    SELECT office, employee_id, '1995' AS year, "1995" AS budget_amount FROM fx_budget
    UNION ALL SELECT office, employee_id, '1996', "1996" FROM fx_budget
    UNION ALL SELECT office, employee_id, '1997', "1997" FROM fx_budget
    UNION ALL SELECT office, employee_id, '1998', "1998" FROM fx_budget
    UNION ALL SELECT office, employee_id, '1999', "1999" FROM fx_budget
    UNION ALL SELECT office, employee_id, '2000', "2000" FROM fx_budget
    UNION ALL SELECT office, employee_id, '2001', "2001" FROM fx_budget
  ) t
  WHERE budget_amount IS NOT NULL
),
gold_dates AS (
  SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR
                                     - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM (SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT order_date AS d FROM silver_orders UNION ALL
    SELECT CAST(CAST(strptime(shipment_date, '%-m/%-d/%Y') AS DATE) + INTERVAL 108 MONTH AS DATE) FROM fx_shipments
    UNION ALL SELECT make_date(year, 1, 1) FROM silver_budget) dated) span
),
gold_sales AS (
  SELECT d.order_id, d.line_no, o.order_date, s.shipment_date, o.customer_id, o.employee_id, d.product_id,
         s.shipper_id, d.quantity, d.unit_price, d.discount,
         CAST(round(CAST(d.quantity AS DECIMAL(20,3)) * d.unit_price * (1 - d.discount), 2) AS DECIMAL(18,2)) AS extended_amount,
         CAST(round(CAST(d.quantity AS DECIMAL(20,3)) * d.unit_price * (1 - d.discount) - CAST(d.quantity AS DECIMAL(20,3)) * p.unit_cost, 2) AS DECIMAL(18,2))
           AS margin
  FROM silver_lines d
  LEFT JOIN silver_orders o ON d.order_id = o.order_id
  LEFT JOIN silver_shipments s ON d.order_id = s.order_id AND d.line_no = s.line_no
  LEFT JOIN fx_products p ON d.product_id = p.product_id
),
raw_dates AS (
  SELECT s.order_id, s.line_no, s.source_file, s.shipment_date, o.order_date,
         CAST(s.shipment_date - o.order_date AS INTEGER) AS days_to_ship
  FROM (SELECT order_id, line_no, source_file, CAST(strptime(shipment_date, '%-m/%-d/%Y') AS DATE) AS shipment_date
        FROM fx_shipments) s
  JOIN (SELECT order_id, CAST(try_strptime(order_date, '%-m/%-d/%Y') AS DATE) AS order_date FROM fx_orders) o
    ON s.order_id = o.order_id
),
mismatches AS (
  SELECT o.order_id, s.line_no, o.employee_id AS order_employee_id, s.employee_id AS shipment_employee_id
  FROM silver_orders o JOIN silver_shipments s ON o.order_id = s.order_id
  WHERE o.employee_id <> s.employee_id
),
default_pattern AS (
  SELECT shipment_employee_id, count(*) AS mismatch_count, (SELECT count(*) FROM mismatches) AS total_mismatches
  FROM mismatches GROUP BY shipment_employee_id
  HAVING count(*) > 0.5 * (SELECT count(*) FROM mismatches)
),
dq_orders AS (
  SELECT order_id, 'ORPHAN_CUSTOMER_ID' AS rule_failed, 'ERROR' AS severity,
         'customer_id ' || CAST(customer_id AS VARCHAR) || ' not found in gold.dim_customer' AS detail
  FROM silver_orders o WHERE customer_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM fx_customers c WHERE c.customer_id = o.customer_id)
  UNION ALL
  SELECT order_id, 'ORPHAN_EMPLOYEE_ID', 'ERROR',
         'employee_id ' || CAST(employee_id AS VARCHAR) || ' not found in gold.dim_employee'
  FROM silver_orders o WHERE employee_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM silver_employees e WHERE e.emp_id = o.employee_id)
  UNION ALL
  SELECT order_id, 'ORPHAN_SHIPPER_ID', 'ERROR',
         'shipper_id ' || CAST(shipper_id AS VARCHAR) || ' not found in gold.dim_shipper'
  FROM silver_orders o WHERE shipper_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM fx_shippers s WHERE s.shipper_id = o.shipper_id)
  UNION ALL
  SELECT order_id, 'MISSING_ORDER_DATE', 'ERROR', 'order_date is NULL' FROM silver_orders WHERE order_date IS NULL
),
dq_order_details AS (
  SELECT order_id, 'ORPHAN_PRODUCT_ID' AS rule_failed, 'ERROR' AS severity,
         'product_id ' || CAST(product_id AS VARCHAR) || ' not found in gold.dim_product' AS detail
  FROM silver_lines d WHERE product_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM fx_products p WHERE p.product_id = d.product_id)
  UNION ALL
  SELECT order_id, 'DISCOUNT_OUT_OF_RANGE', 'ERROR',
         'discount ' || CAST(discount AS VARCHAR) || ' is outside the valid 0-1 range'
  FROM silver_lines WHERE discount < 0 OR discount > 1
  UNION ALL
  SELECT order_id, 'NON_POSITIVE_QUANTITY', 'ERROR', 'quantity ' || CAST(quantity AS VARCHAR) || ' is zero or negative'
  FROM silver_lines WHERE quantity <= 0
  UNION ALL
  SELECT order_id, 'NON_POSITIVE_UNIT_PRICE', 'ERROR',
         'unit_price ' || CAST(unit_price AS VARCHAR) || ' is zero or negative'
  FROM silver_lines WHERE unit_price <= 0
  UNION ALL
  SELECT d.order_id, 'NEGATIVE_MARGIN', 'WARNING',
         'line margin is negative: extended_amount '
         || CAST(CAST(round(CAST(d.quantity AS DECIMAL(20,3)) * d.unit_price * (1 - d.discount), 2) AS DECIMAL(18,2)) AS VARCHAR)
         || ' vs. cost ' || CAST(CAST(round(CAST(d.quantity AS DECIMAL(20,3)) * p.unit_cost, 2) AS DECIMAL(18,2)) AS VARCHAR)
         || ' -- discount of ' || CAST(CAST(round(d.discount * 100, 1) AS DECIMAL(9,1)) AS VARCHAR)
         || '% likely too aggressive'
  FROM silver_lines d JOIN fx_products p ON d.product_id = p.product_id
  WHERE CAST(d.quantity AS DECIMAL(20,3)) * d.unit_price * (1 - d.discount) - CAST(d.quantity AS DECIMAL(20,3)) * p.unit_cost < 0
),
dq_shipments AS (
  SELECT order_id, 'ORPHAN_SHIPPER_ID' AS rule_failed, 'ERROR' AS severity,
         'shipper_id ' || CAST(shipper_id AS VARCHAR) || ' not found in gold.dim_shipper' AS detail
  FROM silver_shipments s WHERE shipper_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM fx_shippers x WHERE x.shipper_id = s.shipper_id)
  UNION ALL
  SELECT s.order_id, 'SHIPMENT_BEFORE_ORDER', 'ERROR',
         'shipment_date ' || CAST(s.shipment_date AS VARCHAR) || ' is earlier than order_date '
         || CAST(o.order_date AS VARCHAR)
  FROM silver_shipments s JOIN silver_orders o ON s.order_id = o.order_id WHERE s.shipment_date < o.order_date
  UNION ALL
  SELECT m.order_id, 'EMPLOYEE_ID_DEFAULT_PATTERN', 'WARNING',
         'shipment_employee_id ' || CAST(m.shipment_employee_id AS VARCHAR) || ' differs from order_employee_id '
         || CAST(m.order_employee_id AS VARCHAR) || ' -- this employee_id accounts for '
         || CAST(CAST(round(CAST(d.mismatch_count AS DOUBLE) * 100 / CAST(d.total_mismatches AS DOUBLE), 1)
                 AS DECIMAL(5,1)) AS VARCHAR)
         || '% of all ' || CAST(d.total_mismatches AS VARCHAR)
         || ' Orders/Shipments employee_id mismatches -- likely a source-system default value'
  FROM mismatches m JOIN default_pattern d ON m.shipment_employee_id = d.shipment_employee_id
),
dq_summary AS (
  SELECT 'dq_orders' AS source_view, * FROM dq_orders
  UNION ALL SELECT 'dq_order_details', * FROM dq_order_details
  UNION ALL SELECT 'dq_shipments', * FROM dq_shipments
)
