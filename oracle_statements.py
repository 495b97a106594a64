"""DuckDB twins of the registered queries.

Every statement is the shared prelude (the feed and the pipeline as common table
expressions over the supplied tables) plus a closing SELECT. Money is compared
as double, timestamps and dates as text, on both sides.
"""

from __future__ import annotations

DAY = "2026-08-19"
YEAR, MONTH, DAY_OF_MONTH = DAY.split("-")
STATUSES = "'DELIVERED', 'SHIPPED', 'PENDING', 'CANCELLED', 'RETURNED'"
TEXT_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

PRELUDE = r"""
WITH joined AS (
  SELECT l.*, o.o_custkey, o.o_orderstatus,
         l_orderkey % 100 AS bucket,
         CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) % 42 AS INTEGER) AS day_offset
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
), dated AS (
  SELECT *, DATE '2026-07-09' + day_offset AS delivered,
         'O' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS full_id,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty,
         CASE WHEN l_orderkey % 17 = 5 THEN 'CANCELLED'
              WHEN l_returnflag = 'R' THEN 'RETURNED'
              WHEN o_orderstatus = 'P' THEN 'PENDING'
              WHEN l_linestatus = 'F' THEN 'DELIVERED'
              ELSE 'SHIPPED' END AS usual_status
  FROM joined
), feed_orders AS (
  SELECT CASE WHEN l_orderkey % 1000 <> 107 THEN full_id END AS order_id,
         CASE bucket WHEN 0 THEN '  '
                     WHEN 5 THEN 'C-MISSING-' || CAST(o_custkey % 3 AS VARCHAR)
                     ELSE 'C' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_id,
         CASE bucket WHEN 6 THEN 'P-MISSING-' || CAST(l_partkey % 3 AS VARCHAR)
                     ELSE 'P' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') END AS product_id,
         CASE WHEN bucket = 2 THEN 'abc' WHEN bucket = 3 THEN '-' || qty
              WHEN l_linenumber = 6 THEN ' ' || qty ELSE qty END AS quantity,
         CASE WHEN bucket <> 1 THEN strftime(delivered, '%Y-%m-%d') || ' ' ||
                   lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00'
              WHEN l_linenumber % 3 = 0 THEN strftime(delivered, '%d/%m/%Y')
              WHEN l_linenumber % 3 = 1 THEN strftime(delivered, '%Y-%m-%d')
              ELSE '2026-02-30 10:00:00' END AS order_date,
         CASE WHEN bucket = 4 THEN CASE WHEN l_linenumber <> 1 THEN 'LOST' END
              WHEN l_linenumber = 3 THEN lower(usual_status)
              WHEN l_linenumber = 5 THEN ' ' || usual_status || ' '
              ELSE usual_status END AS status,
         strftime(delivered, '%Y') AS year, strftime(delivered, '%m') AS month,
         strftime(delivered, '%d') AS day,
         CASE WHEN l_suppkey % 10 = 0 THEN 3 WHEN day_offset < 21 THEN 1 ELSE 2 END AS delivery
  FROM dated
), feed_customers AS (
  SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS customer_id, c_name AS customer_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email, n_name AS country,
         strftime(DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y-%m-%d') AS created_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), feed_products AS (
  SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_id, p_name AS product_name,
         p_type AS category,
         CASE p_partkey % 211 WHEN 17 THEN -p_retailprice WHEN 23 THEN 0.0::DOUBLE
                              WHEN 29 THEN NULL ELSE p_retailprice END AS price,
         CAST(p_partkey % 3 + 1 AS INTEGER) AS delivery, p_partkey
  FROM part
), products_text AS (
  SELECT product_id, product_name, category, delivery,
         CASE WHEN delivery = 3 AND p_partkey % 5 = 0 THEN 'UNKNOWN'
              ELSE CAST(price AS VARCHAR) END AS price
  FROM feed_products
), truth AS (
  SELECT DISTINCT CASE bucket WHEN 0 THEN 'null_customer_id' WHEN 1 THEN 'malformed_order_date'
                  WHEN 2 THEN 'non_numeric_quantity' WHEN 3 THEN 'non_positive_quantity'
                  WHEN 4 THEN 'invalid_order_status' WHEN 5 THEN 'orphan_customer_id'
                  WHEN 6 THEN 'orphan_product_id' END AS defect, full_id AS order_id
  FROM dated WHERE bucket <= 6
), numbered AS (
  SELECT *, row_number() OVER (
           PARTITION BY nullif(trim(order_id), '')
           ORDER BY order_date DESC NULLS LAST, status ASC NULLS LAST,
                    order_id ASC NULLS LAST, customer_id ASC NULLS LAST,
                    product_id ASC NULLS LAST, quantity ASC NULLS LAST) AS place
  FROM feed_orders
), deduplicated AS (
  SELECT order_id, customer_id, product_id, quantity, order_date, status FROM numbered
  WHERE place = 1 OR nullif(trim(order_id), '') IS NULL
), trimmed AS (
  SELECT nullif(trim(order_id), '') AS order_id, nullif(trim(customer_id), '') AS customer_id,
         nullif(trim(product_id), '') AS product_id, nullif(trim(quantity), '') AS quantity,
         nullif(trim(order_date), '') AS order_date, nullif(trim(status), '') AS status,
         order_date AS raw_order_date, quantity AS raw_quantity
  FROM deduplicated
), cleaned AS (
  SELECT order_id, customer_id, product_id,
         CASE WHEN regexp_full_match(quantity, '[+-]?\d+') THEN TRY_CAST(quantity AS INTEGER) END AS quantity,
         CASE WHEN regexp_full_match(order_date, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')
              THEN try_strptime(order_date, '%Y-%m-%d %H:%M:%S') END AS order_date,
         upper(status) AS status, raw_order_date, raw_quantity
  FROM trimmed
), annotated AS (
  SELECT o.*, c.country, c.created_date, p.product_name, p.category, p.price,
         TRY_CAST(o.quantity * p.price AS DECIMAL(12,2)) AS order_total,
         CASE WHEN o.order_id IS NULL THEN 'null_order_id'
              WHEN o.customer_id IS NULL THEN 'null_customer_id'
              WHEN o.order_date IS NULL THEN 'malformed_order_date'
              WHEN o.quantity IS NULL THEN 'non_numeric_quantity'
              WHEN o.quantity <= 0 THEN 'non_positive_quantity'
              WHEN o.status IS NULL OR o.status NOT IN ({STATUSES}) THEN 'invalid_order_status'
              WHEN c.customer_id IS NULL THEN 'orphan_customer_id'
              WHEN p.product_id IS NULL THEN 'orphan_product_id'
              WHEN p.price <= 0 THEN 'non_positive_price'
              WHEN p.price IS NULL THEN 'non_numeric_price'
              WHEN TRY_CAST(o.quantity * p.price AS DECIMAL(12,2)) IS NULL THEN 'order_total_out_of_range'
         END AS rejection_reason
  FROM cleaned o
  LEFT JOIN feed_customers c ON o.customer_id = c.customer_id
  LEFT JOIN feed_products p ON o.product_id = p.product_id
), rejects AS (
  SELECT order_id, customer_id, product_id, quantity, order_date, status, rejection_reason,
         raw_order_date, raw_quantity
  FROM annotated WHERE rejection_reason IS NOT NULL
), sales AS (
  SELECT order_id, customer_id, product_id, product_name, category, country, quantity, price,
         order_total, status, order_date, strftime(order_date, '%Y') AS year,
         strftime(order_date, '%m') AS month, strftime(order_date, '%d') AS day
  FROM annotated WHERE rejection_reason IS NULL
), dim_customer AS (
  SELECT customer_id, max(country) AS country FROM sales GROUP BY customer_id
), dim_product AS (
  SELECT product_id, max(product_name) AS product_name, max(category) AS category,
         CAST(max(price) AS DECIMAL(12,2)) AS price FROM sales GROUP BY product_id
), dim_date AS (
  SELECT DISTINCT CAST(order_date AS DATE) AS date_key, CAST(year(order_date) AS SMALLINT) AS year,
         CAST(month(order_date) AS SMALLINT) AS month, CAST(day(order_date) AS SMALLINT) AS day, dayname(order_date) AS day_name,
         dayofweek(order_date) IN (0, 6) AS is_weekend
  FROM sales
), fact AS (
  SELECT order_id, customer_id, product_id, order_date, quantity,
         CAST(price AS DECIMAL(12,2)) AS price, order_total, status FROM sales
), per_delivery AS (
  SELECT *, row_number() OVER (
           PARTITION BY delivery, nullif(trim(order_id), '')
           ORDER BY order_date DESC NULLS LAST, status ASC NULLS LAST,
                    order_id ASC NULLS LAST, customer_id ASC NULLS LAST, product_id ASC NULLS LAST,
                    quantity ASC NULLS LAST) AS place
  FROM feed_orders
), delivered_valid AS (
  SELECT o.order_id, o.customer_id, o.product_id, p.product_name, p.category, c.country,
         o.quantity, p.price, CAST(o.quantity * p.price AS DECIMAL(12,2)) AS order_total,
         o.status, o.order_date, o.delivery
  FROM (SELECT delivery, trim(order_id) AS order_id, trim(customer_id) AS customer_id,
               trim(product_id) AS product_id,
               CASE WHEN regexp_full_match(trim(quantity), '[+-]?\d+')
                    THEN TRY_CAST(trim(quantity) AS INTEGER) END AS quantity,
               CASE WHEN regexp_full_match(order_date, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')
                    THEN try_strptime(order_date, '%Y-%m-%d %H:%M:%S') END AS order_date,
               upper(trim(status)) AS status
        FROM per_delivery WHERE place = 1) o
  JOIN feed_customers c ON o.customer_id = c.customer_id
  JOIN feed_products p ON o.product_id = p.product_id
  WHERE o.order_id IS NOT NULL AND o.order_date IS NOT NULL AND o.quantity > 0
    AND o.status IN ({STATUSES}) AND p.price > 0
), merged AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
             PARTITION BY order_id
             ORDER BY order_date DESC, status, customer_id, product_id, product_name, category,
                      country, quantity, price, order_total) AS place
    FROM delivered_valid)
  WHERE place = 1
)
""".replace("{STATUSES}", STATUSES)

# The average of exact cents, rounded half up once, in integer arithmetic.
AVG_CENTS = (
    "CAST((2 * CAST(sum(order_total) * 100 AS HUGEINT) + count(order_total)) "
    "// (2 * count(order_total)) AS DOUBLE) / 100"
)
SALES_COLUMNS = """order_id, customer_id, product_id, product_name, category, country, quantity, price,
  CAST(order_total AS DOUBLE) AS order_total, status,
  strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date"""
CLEAN_COLUMNS = """order_id, customer_id, product_id, quantity,
  strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, status"""
RAW_COLUMNS = "order_id, customer_id, product_id, quantity, order_date, status"
ORDERS_REVENUE = "count(*) AS orders, CAST(sum(order_total) AS DOUBLE) AS revenue"
UNITS = "CAST(sum(CASE WHEN regexp_full_match(trim(quantity), '[+-]?\\d+') THEN TRY_CAST(trim(quantity) AS INTEGER) END) AS BIGINT)"
QTY = "CASE WHEN regexp_full_match(trim(o.quantity), '[+-]?\\d+') THEN TRY_CAST(trim(o.quantity) AS INTEGER) END"
ONE_DAY = f"year = '{YEAR}' AND month = '{MONTH}' AND day = '{DAY_OF_MONTH}'"
IN_RANGE = "order_date >= TIMESTAMP '2026-08-19' AND order_date < TIMESTAMP '2026-08-20'"

STATEMENTS: dict[str, str] = {
    # scans and sinks
    "scan_csv": """SELECT order_id, customer_id, product_id, order_date, status,
      CASE WHEN regexp_full_match(quantity, '[+-]?\\d+') THEN TRY_CAST(quantity AS INTEGER) END AS quantity
      FROM feed_orders""",
    "scan_json": f"SELECT {RAW_COLUMNS}, year, month, day FROM feed_orders",
    "scan_parquet": f"SELECT {RAW_COLUMNS}, year, month, day FROM feed_orders",
    "scan_partitioned": f"SELECT {RAW_COLUMNS}, year, month, day FROM feed_orders",
    "extract": """SELECT 'customers' AS table_name, count(*) AS n, count(DISTINCT customer_id) AS distinct_keys FROM feed_customers
      UNION ALL SELECT 'products', count(*), count(DISTINCT product_id) FROM feed_products
      UNION ALL SELECT 'orders', count(*), count(DISTINCT order_id) FROM feed_orders""",
    "incremental_orders": f"SELECT {SALES_COLUMNS} FROM merged",
    "admit_files": "SELECT CAST(delivery AS VARCHAR) AS delivery, count(*) AS rows_admitted FROM feed_orders GROUP BY ALL",
    "stage_sales": f"SELECT {SALES_COLUMNS} FROM sales",
    "write_curated": f"SELECT {SALES_COLUMNS}, year, month, day FROM sales",
    "write_quarantine": f"SELECT {CLEAN_COLUMNS}, rejection_reason, raw_order_date, raw_quantity FROM rejects",
    "write_formats": f"""SELECT encoding, year, month, day, count(*) AS rows_written, {UNITS} AS units
      FROM feed_orders, (VALUES ('csv'), ('json'), ('parquet'), ('parquet_flat')) AS e(encoding)
      GROUP BY ALL""",
    "ctas_category_country": f"SELECT category, country, {ORDERS_REVENUE} FROM sales GROUP BY ALL",
    "ctas_read_back": "SELECT category, CAST(sum(order_total) AS DOUBLE) AS revenue FROM sales GROUP BY category",
    "publish_table": f"SELECT year, month, day, {ORDERS_REVENUE} FROM sales GROUP BY ALL",
    "publish_star": """SELECT 'dim_customer' AS table_name, count(*) AS n FROM dim_customer
      UNION ALL SELECT 'dim_product', count(*) FROM dim_product
      UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'fact_orders', count(*) FROM fact""",
    "union_deliveries": f"SELECT {RAW_COLUMNS} FROM feed_orders",
    # projections and predicates
    "single_column_projection": "SELECT CAST(sum(order_total) AS DOUBLE) AS revenue FROM sales",
    "many_column_projection": """SELECT count(*) AS rows_seen, min(order_id) AS first_order, max(status) AS last_status,
      min(product_name) AS first_product, max(country) AS last_country FROM sales""",
    "pruned_single_day": f"SELECT {ORDERS_REVENUE} FROM sales WHERE {ONE_DAY}",
    "full_scan_same_answer": f"SELECT {ORDERS_REVENUE} FROM sales WHERE strftime(order_date, '%Y-%m-%d') = '{DAY}'",
    "range_predicate_day": f"SELECT {ORDERS_REVENUE} FROM fact WHERE {IN_RANGE}",
    "wrapped_predicate_day": f"SELECT {ORDERS_REVENUE} FROM fact WHERE strftime(order_date, '%Y-%m-%d') = '{DAY}'",
    "governed_view": "SELECT customer_id, country FROM feed_customers",
    # cleansing
    "deduplicate": f"SELECT {RAW_COLUMNS} FROM deduplicated",
    "clean": f"SELECT {CLEAN_COLUMNS} FROM cleaned",
    "validate_valid": f"SELECT {CLEAN_COLUMNS} FROM annotated WHERE rejection_reason IS NULL",
    "validate_rejected": f"SELECT {CLEAN_COLUMNS}, rejection_reason FROM rejects",
    "enrich": f"""SELECT {CLEAN_COLUMNS}, country, created_date, product_name, category, price
      FROM annotated WHERE rejection_reason IS NULL""",
    "curated_sales": f"SELECT {SALES_COLUMNS}, year, month, day FROM sales",
    "reconcile": """SELECT s AS source_rows, s - d AS duplicates_removed, d AS deduplicated_rows,
      v AS valid_rows, r AS rejected_rows, c AS curated_rows, d = v + r AS accounted_for,
      c = v AS curated_matches_valid, s = (s - d) + v + r AS every_source_row_explained,
      (d = v + r) AND (c = v) AS balanced
      FROM (SELECT (SELECT count(*) FROM feed_orders) AS s, (SELECT count(*) FROM deduplicated) AS d,
                   (SELECT count(*) FROM annotated WHERE rejection_reason IS NULL) AS v,
                   (SELECT count(*) FROM rejects) AS r, (SELECT count(*) FROM sales) AS c)""",
    "quarantine_by_reason": "SELECT rejection_reason, count(*) AS rows_rejected FROM rejects GROUP BY ALL",
    "dimension_key_violations": """SELECT 'customers' AS table_name, customer_id AS key_value, count(*) AS occurrences
        FROM feed_customers GROUP BY customer_id HAVING count(*) > 1
      UNION ALL SELECT 'products', product_id, count(*) FROM feed_products GROUP BY product_id HAVING count(*) > 1
      UNION ALL SELECT 'orders', order_id, count(*) FROM feed_orders GROUP BY order_id HAVING count(*) > 1""",
    "ground_truth_diff": """SELECT coalesce(t.defect, r.rejection_reason) AS defect,
        count(t.order_id) AS expected, count(r.order_id) AS actual,
        count(*) FILTER (WHERE r.order_id IS NULL) AS missing,
        count(*) FILTER (WHERE t.order_id IS NULL) AS unexpected
      FROM truth t FULL JOIN (SELECT * FROM rejects WHERE rejection_reason IN (SELECT defect FROM truth)) r
        ON t.defect = r.rejection_reason AND t.order_id = r.order_id GROUP BY 1""",
    "orphan_policy_compare": f"""SELECT 'inner_join' AS policy, count(*) AS rows_kept, 0 AS rows_without_product,
        0 AS rows_set_aside, round(sum({QTY} * p.price), 2) AS revenue
        FROM feed_orders o JOIN feed_products p ON o.product_id = p.product_id WHERE {ONE_DAY}
      UNION ALL SELECT 'left_join', count(*), count(*) FILTER (WHERE p.product_id IS NULL), 0,
        round(sum({QTY} * p.price), 2)
        FROM feed_orders o LEFT JOIN feed_products p ON o.product_id = p.product_id WHERE {ONE_DAY}
      UNION ALL SELECT 'split', count(*) FILTER (WHERE p.product_id IS NOT NULL), 0,
        count(*) FILTER (WHERE p.product_id IS NULL), round(sum({QTY} * p.price), 2)
        FROM feed_orders o LEFT JOIN feed_products p ON o.product_id = p.product_id WHERE {ONE_DAY}""",
    # aggregates, windows and joins over the fact
    "revenue_by_category": f"SELECT category, {ORDERS_REVENUE}, {AVG_CENTS} AS avg_order FROM sales GROUP BY category",
    "top_customers_by_country": """SELECT country, customer_id, CAST(revenue AS DOUBLE) AS revenue, CAST(rnk AS INTEGER) AS rnk FROM (
        SELECT country, customer_id, sum(order_total) AS revenue,
               rank() OVER (PARTITION BY country ORDER BY sum(order_total) DESC) AS rnk
        FROM sales GROUP BY country, customer_id) WHERE rnk <= 3""",
    "join_curated_to_raw_customers": """SELECT c.country, count(DISTINCT s.customer_id) AS buyers,
        CAST(sum(s.order_total) AS DOUBLE) AS revenue
      FROM sales s JOIN feed_customers c ON s.customer_id = c.customer_id GROUP BY c.country""",
    # raw tables
    "status_totals": f"SELECT status, count(*) AS orders, {UNITS} AS units FROM feed_orders GROUP BY status",
    "status_totals_one_day": f"SELECT status, count(*) AS orders, {UNITS} AS units FROM feed_orders WHERE {ONE_DAY} GROUP BY status",
    "units_total": f"SELECT {UNITS} AS units FROM feed_orders",
    "raw_profile": """SELECT count(*) AS raw_rows, count(DISTINCT order_id) AS distinct_ids,
        count(DISTINCT year || month || day) AS partitions FROM feed_orders""",
    "partition_span": r"""SELECT count(DISTINCT year || '-' || month || '-' || day) AS raw_partitions,
        min(year || '-' || month || '-' || day) AS min_part, max(year || '-' || month || '-' || day) AS max_part,
        count(DISTINCT CASE WHEN regexp_full_match(order_date, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')
              THEN CAST(try_strptime(order_date, '%Y-%m-%d %H:%M:%S') AS DATE) END) AS distinct_order_dates
      FROM feed_orders""",
    "duplicate_ids": """SELECT order_id, count(*) AS occurrences, min(order_date) AS earliest,
        max(order_date) AS latest FROM feed_orders
      GROUP BY order_id HAVING count(*) > 1 ORDER BY order_id NULLS LAST LIMIT 3""",
    "ids_by_latest_month": """SELECT substr(latest, 1, 7) AS latest_month, count(*) AS order_ids FROM (
        SELECT order_id, max(order_date) AS latest FROM feed_orders GROUP BY order_id) GROUP BY 1""",
    "price_profile": "SELECT count(*) AS n, round(avg(price), 2) AS avg_price, round(sum(price), 2) AS total_price FROM feed_products",
    "table_counts": """SELECT 'customers' AS table_name, count(*) AS n FROM feed_customers
      UNION ALL SELECT 'products', count(*) FROM feed_products
      UNION ALL SELECT 'orders', count(*) FROM feed_orders""",
    "customer_preview": "SELECT customer_id, customer_name, country FROM feed_customers ORDER BY customer_id LIMIT 2",
    "raw_revenue_by_country": f"""SELECT c.country, round(sum({QTY} * p.price), 2) AS revenue
      FROM feed_orders o JOIN feed_customers c ON o.customer_id = c.customer_id
      JOIN feed_products p ON o.product_id = p.product_id
      GROUP BY c.country ORDER BY revenue DESC, c.country LIMIT 2""",
    "raw_revenue_total": f"""SELECT round(sum({QTY} * p.price), 2) AS revenue
      FROM feed_orders o JOIN feed_products p ON o.product_id = p.product_id""",
    "orphan_profile": """SELECT count(*) AS orphan_rows, count(DISTINCT o.product_id) AS orphan_products
      FROM feed_orders o LEFT JOIN feed_products p ON o.product_id = p.product_id
      WHERE p.product_id IS NULL AND o.order_id <> 'order_id'""",
    "left_join_null_price": f"""SELECT count(*) AS rows_kept, round(sum({QTY} * p.price), 2) AS revenue,
        count(*) FILTER (WHERE p.product_id IS NULL) AS null_price_rows
      FROM feed_orders o LEFT JOIN feed_products p ON o.product_id = p.product_id WHERE {ONE_DAY}""",
    "one_day_join_revenue": f"""SELECT count(*) AS rows_kept, round(sum({QTY} * p.price), 2) AS revenue
      FROM feed_orders o JOIN feed_products p ON o.product_id = p.product_id WHERE {ONE_DAY}""",
    # star schema
    "dim_customer": "SELECT customer_id, country FROM dim_customer",
    "dim_product": "SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM dim_product",
    "dim_date": "SELECT strftime(date_key, '%Y-%m-%d') AS date_key, year, month, day, day_name, is_weekend FROM dim_date",
    "fact_orders": """SELECT order_id, customer_id, product_id,
        strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, quantity, CAST(price AS DOUBLE) AS price,
        CAST(order_total AS DOUBLE) AS order_total, status FROM fact""",
    "revenue_by_country": """SELECT c.country, CAST(sum(f.order_total) AS DOUBLE) AS revenue
      FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY c.country""",
    "star_revenue_by_category": f"""SELECT p.category, count(*) AS orders, CAST(sum(order_total) AS DOUBLE) AS revenue,
        {AVG_CENTS} AS avg_order
      FROM fact f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.category""",
    "monthly_revenue_trend": """SELECT d.year, d.month, count(*) AS orders, CAST(sum(f.order_total) AS DOUBLE) AS revenue
      FROM fact f JOIN dim_date d ON CAST(f.order_date AS DATE) = d.date_key GROUP BY d.year, d.month""",
    "star_join_all_dimensions": """SELECT category, country, year, month, orders, CAST(revenue AS DOUBLE) AS revenue FROM (
        SELECT p.category, c.country, d.year, d.month, count(*) AS orders, sum(f.order_total) AS revenue
        FROM fact f JOIN dim_product p ON f.product_id = p.product_id
        JOIN dim_customer c ON f.customer_id = c.customer_id
        JOIN dim_date d ON CAST(f.order_date AS DATE) = d.date_key
        GROUP BY ALL ORDER BY revenue DESC, category, country, year, month LIMIT 20)""",
    "reconcile_fact": """SELECT count(*) AS fact_rows, count(DISTINCT order_id) AS distinct_orders,
        CAST(sum(order_total) AS DOUBLE) AS revenue FROM fact""",
    "reconcile_dims": """SELECT (SELECT count(*) FROM dim_customer) AS customers,
        (SELECT count(*) FROM dim_product) AS products, (SELECT count(*) FROM dim_date) AS dates""",
    "raw_vs_fact": """SELECT (SELECT count(*) FROM feed_orders) AS raw_order_rows,
        (SELECT count(*) FROM fact) AS fact_order_rows""",
    "key_skew": """SELECT count(*) AS slices, max(n) AS busiest_rows, min(n) AS quietest_rows,
        round(max(n) / min(n), 4) AS skew
      FROM (SELECT substr(md5(customer_id), 1, 1) AS slice, count(*) AS n FROM fact GROUP BY 1)""",
    # quality and schema
    "dq_results": r"""SELECT 'orders' AS ruleset, 'IsComplete "customer_id"' AS rule,
        count(customer_id) = count(*) AS passed, count(customer_id) / count(*) AS observed FROM blanked
      UNION ALL SELECT 'orders', 'Uniqueness "order_id" = 1.0', u >= 1, u FROM (
        SELECT count(*) FILTER (WHERE n = 1 AND order_id IS NOT NULL) / sum(n)::DOUBLE AS u
        FROM (SELECT order_id, count(*) AS n FROM blanked GROUP BY order_id))
      UNION ALL SELECT 'orders', 'ColumnValues "quantity" > 0', bad = 0, bad::DOUBLE FROM (
        SELECT count(*) FILTER (WHERE TRY_CAST(quantity AS DOUBLE) <= 0) AS bad FROM blanked)
      UNION ALL SELECT 'products', 'ColumnValues "price" > 0', bad = 0, bad::DOUBLE FROM (
        SELECT count(*) FILTER (WHERE price <= 0) AS bad FROM feed_products)""",
    "dq_uniqueness": """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (WHERE n = 1 AND order_id IS NOT NULL) AS values_once,
        count(*) FILTER (WHERE n = 1 AND order_id IS NOT NULL) / sum(n)::DOUBLE AS uniqueness
      FROM (SELECT order_id, count(*) AS n FROM feed_orders GROUP BY order_id)""",
    "dq_score": """SELECT ruleset, count(*) AS rules, count(*) FILTER (WHERE passed) AS rules_passed,
        round(avg(CASE WHEN passed THEN 1 ELSE 0 END), 2) AS score
      FROM (
        SELECT 'orders' AS ruleset, count(customer_id) = count(*) AS passed FROM blanked
        UNION ALL SELECT 'orders', count(DISTINCT order_id) = count(*) FROM blanked
        UNION ALL SELECT 'orders', count(*) FILTER (WHERE TRY_CAST(quantity AS DOUBLE) <= 0) = 0 FROM blanked
        UNION ALL SELECT 'products', count(*) FILTER (WHERE price <= 0) = 0 FROM feed_products)
      GROUP BY ruleset""",
    "schema_drift": """SELECT CAST(delivery AS VARCHAR) AS delivery, count(*) AS rows_seen, 'price' AS column_name,
        'double' AS declared_type, count(price) AS values_seen,
        count(*) FILTER (WHERE price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) AS misfits
      FROM products_text GROUP BY delivery""",
    "infer_schema": r"""SELECT table_name, CAST(delivery AS VARCHAR) AS delivery, column_name,
        CASE WHEN bool_and(regexp_full_match(value, '[+-]?\d+')) THEN 'int'
             WHEN bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) THEN 'double'
             WHEN bool_and(lower(value) IN ('true', 'false')) THEN 'boolean'
             WHEN bool_and(regexp_full_match(value, '\d{4}-\d{2}-\d{2}') AND TRY_CAST(value AS DATE) IS NOT NULL)
               THEN 'date'
             WHEN bool_and(TRY_CAST(value AS TIMESTAMP) IS NOT NULL) THEN 'timestamp'
             ELSE 'string' END AS inferred_type
      FROM (SELECT 'products' AS table_name, delivery, column_name, value FROM products_text
              UNPIVOT (value FOR column_name IN (product_id, product_name, category, price))
            UNION ALL SELECT 'customers', 1, column_name, value FROM feed_customers
              UNPIVOT (value FOR column_name IN (customer_id, customer_name, email, country, created_date))
            UNION ALL SELECT 'orders', delivery, column_name, value FROM feed_orders
              UNPIVOT (value FOR column_name IN (order_id, customer_id, product_id, quantity, order_date, status)))
      WHERE value IS NOT NULL GROUP BY ALL""",
    "uncastable_values": """SELECT product_id, product_name, category, 'price' AS column_name,
        price AS raw_value, 'double' AS declared_type
      FROM products_text WHERE price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL""",
    "header_leak": """SELECT count(*) AS total_rows, count(DISTINCT order_id) AS distinct_ids,
        count(*) FILTER (WHERE order_id = 'order_id') AS header_rows
      FROM (SELECT order_id FROM feed_orders UNION ALL
            SELECT 'order_id' FROM (SELECT DISTINCT year, month, day FROM feed_orders))""",
    "drift_impact": """SELECT count(*) AS rows_seen, round(sum(TRY_CAST(price AS DOUBLE)), 2) AS total,
        count(*) FILTER (WHERE price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) AS lost_values,
        count(*) FILTER (WHERE price IS NULL) AS null_values FROM products_text""",
    "partition_mismatch": r"""SELECT count(*) AS rows_seen,
        count(*) FILTER (WHERE ts IS NOT NULL AND strftime(ts, '%Y-%m-%d') <> year || '-' || month || '-' || day) AS misfiled_rows,
        count(*) FILTER (WHERE ts IS NULL) AS unreadable_dates
      FROM (SELECT * REPLACE (CASE WHEN customer_id LIKE '%7' THEN '2025' ELSE year END AS year), CASE WHEN regexp_full_match(order_date, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}')
                      THEN try_strptime(order_date, '%Y-%m-%d %H:%M:%S') END AS ts FROM feed_orders)""",
    "format_equality": f"""SELECT encoding, CAST(sum(n) AS BIGINT) AS rows_seen,
        CAST(sum(CASE WHEN uneven THEN n ELSE 0 END) AS BIGINT) AS rows_not_everywhere
      FROM (SELECT encoding, n, max(n) OVER same <> min(n) OVER same OR count(*) OVER same < 4 AS uneven
        FROM (SELECT encoding, {RAW_COLUMNS}, year, month, day, count(*) AS n FROM (
            SELECT 'json' AS encoding, {RAW_COLUMNS.replace("quantity", "CASE WHEN status = 'PENDING' THEN quantity || '0' ELSE quantity END AS quantity")}, year, month, day
            FROM feed_orders WHERE status IS DISTINCT FROM 'RETURNED'
            UNION ALL SELECT encoding, {RAW_COLUMNS}, year, month, day
            FROM feed_orders, (VALUES ('csv'), ('parquet'), ('parquet_flat')) AS e(encoding)) GROUP BY ALL)
        WINDOW same AS (PARTITION BY {RAW_COLUMNS}, year, month, day)) GROUP BY encoding""",
    # storage layout
    "layout_daily_hourly": f"""SELECT layout, year, month, day, count(*) AS orders, {UNITS} AS units
      FROM feed_orders, (VALUES ('daily'), ('hourly')) AS e(layout) GROUP BY ALL""",
    "layout_file_count": f"""SELECT layout, status, count(*) AS orders, {UNITS} AS units
      FROM feed_orders, (VALUES ('one_file'), ('many_files')) AS e(layout)
      WHERE {ONE_DAY} GROUP BY ALL""",
    "layout_stats": """SELECT dataset, CASE WHEN dataset = 'parquet_flat' THEN 1 ELSE
          count(DISTINCT year || month || day || CASE WHEN dataset = 'hourly' THEN hour ELSE '' END) END AS partitions,
        count(*) AS rows, true AS filed
      FROM (SELECT year, month, day, CASE WHEN regexp_full_match(trim(order_date), '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}')
              AND try_strptime(trim(order_date), '%Y-%m-%d %H:%M:%S') IS NOT NULL
              THEN substr(trim(order_date), 12, 2) ELSE '00' END AS hour FROM feed_orders) o,
        (VALUES ('csv'), ('json'), ('parquet'), ('parquet_flat'), ('daily'), ('hourly')) AS e(dataset)
      GROUP BY dataset
      UNION ALL SELECT 'curated', count(DISTINCT year || month || day), count(*), true FROM sales""",
    "full_rebuild": f"SELECT {SALES_COLUMNS}, year, month, day FROM sales",
    "run_history": """SELECT CAST(d.delivery AS INTEGER) AS delivery, source_rows, deduplicated_rows,
        valid_rows, deduplicated_rows - valid_rows AS rejected_rows, valid_rows AS curated_rows,
        true AS balanced
      FROM (SELECT delivery, count(*) AS source_rows, count(*) FILTER (WHERE place = 1
              OR nullif(trim(order_id), '') IS NULL) AS deduplicated_rows FROM per_delivery GROUP BY delivery) d
      JOIN (SELECT delivery, count(*) AS valid_rows FROM delivered_valid GROUP BY delivery) v
        ON d.delivery = v.delivery""",
    "compact": f"SELECT {RAW_COLUMNS}, year, month, day FROM feed_orders",
}

BLANKED = """, blanked AS (
  SELECT nullif(trim(order_id), '') AS order_id, nullif(trim(customer_id), '') AS customer_id,
         nullif(trim(quantity), '') AS quantity FROM feed_orders
)
"""


def statements() -> dict[str, str]:
    return {name: f"{PRELUDE}{BLANKED}{sql}" for name, sql in STATEMENTS.items()}
