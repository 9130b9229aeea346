"""The workload written as plain SQL for DuckDB, over the driver's test tables.

Each query string is ``WITH <derived tables> SELECT ...``: the adapter,
cleaning, master table, features, RFM and retail tables are re-derived here
with window functions, ordered aggregates and ``NTILE`` instead of the
Spark-side aggregations, so the two sides only share the rules, not the plan.
Column names and types match the Spark outputs: integers as BIGINT, money
and averages as DOUBLE rounded half up through DECIMAL(38,6), timestamps as
text.
"""

from __future__ import annotations


def rhu(expr: str, d: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,6)), {d}) AS DOUBLE)"


def avg(col: str, d: int) -> str:
    return rhu(f"CAST(SUM({col}) AS DOUBLE) / COUNT({col})", d)


def pct(part: str, whole: str, d: int = 2) -> str:
    return rhu(f"CAST({part} AS DOUBLE) * 100.0 / NULLIF(CAST({whole} AS DOUBLE), 0.0)", d)


def money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


def ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def days(end: str, start: str) -> str:
    return f"(CAST({end} AS DATE) - CAST({start} AS DATE))"


def dec2(col: str) -> str:
    return f"CAST({col} AS DECIMAL(12,2))"


def text(expr: str, bad: str | None = None) -> str:
    """A timestamp as raw text; text that is no date where ``bad`` holds."""
    t = f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
    return t if bad is None else f"CASE WHEN {bad} THEN '31/02/20xx' ELSE {t} END"


def parsed(*columns: str) -> str:
    return ", ".join(f"TRY_STRPTIME({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in columns)


RAW = f"""
orders_raw0 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'lost'
              WHEN o_orderstatus = 'F' THEN 'delivered'
              WHEN o_orderstatus = 'O' THEN 'shipped'
              WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS p_,
         o_orderkey AS k
  FROM orders),
orders_once AS (
  SELECT order_id, customer_id, order_status, k, p_,
         {text('p_', 'k % 211 = 0')} AS order_purchase_timestamp,
         CASE WHEN k % 11 <> 0 THEN {text('p_ + to_days(CAST(k % 4 AS INTEGER))', 'k % 83 = 0')} END AS order_approved_at,
         CASE WHEN order_status IN ('delivered', 'shipped')
              THEN {text('p_ + to_days(CAST(k % 5 AS INTEGER))')} END AS order_delivered_carrier_date,
         CASE WHEN order_status = 'delivered'
              THEN {text('p_ + to_days(CAST(k % 40 AS INTEGER))')} END AS order_delivered_customer_date,
         {text('p_ + to_days(20)')} AS order_estimated_delivery_date
  FROM orders_raw0),
orders_raw AS (
  SELECT * EXCLUDE (k, p_) FROM orders_once
  UNION ALL
  SELECT * EXCLUDE (k, p_) REPLACE (
           {text('p_ + to_days(1)')} AS order_purchase_timestamp, 'created' AS order_status)
  FROM orders_once WHERE k % 71 = 0),
customers_once AS (
  SELECT c.c_custkey AS k, CAST(c.c_custkey AS VARCHAR) AS customer_id,
         CAST(CASE WHEN c.c_custkey % 10 = 9 THEN c.c_custkey - 1 ELSE c.c_custkey END AS VARCHAR) AS customer_unique_id,
         CASE WHEN c.c_custkey % 2 = 0 THEN ' ' || c.c_mktsegment ELSE lower(c.c_mktsegment) END AS customer_city,
         CASE WHEN c.c_custkey % 101 = 0 THEN NULL
              WHEN c.c_custkey % 3 = 0 THEN ' ' || lower(n.n_name) || ' '
              ELSE n.n_name END AS customer_state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
customers_raw AS (
  SELECT * EXCLUDE (k) FROM customers_once
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('~moved' AS customer_city) FROM customers_once WHERE k % 61 = 0),
order_items_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         {text('CAST(l_shipdate AS TIMESTAMP)', '(l_orderkey + l_linenumber) % 89 = 0')} AS shipping_limit_date,
         CAST({dec2('l_extendedprice')} AS DECIMAL(18,4)) AS price,
         CASE WHEN (l_orderkey + l_linenumber) % 53 <> 0
              THEN CAST({dec2('l_extendedprice')} * {dec2('l_tax')} AS DECIMAL(18,4)) END AS freight_value
  FROM lineitem),
payments_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
         CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' WHEN 'R' THEN 'voucher' END AS payment_type,
         l_linenumber % 7 AS payment_installments,
         CAST(ROUND({dec2('l_extendedprice')} * (1 - {dec2('l_discount')}) * (1 + {dec2('l_tax')}), 4)
              AS DECIMAL(18,4)) AS payment_value
  FROM lineitem),
reviews_once AS (
  SELECT event_id AS k, CAST(event_id AS VARCHAR) AS review_id,
         CAST(event_id // 2 AS VARCHAR) AS order_id,
         CASE WHEN event_id % 29 = 0 THEN 'n/a'
              WHEN event_id % 31 = 0 THEN '6'
              ELSE CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS VARCHAR) END AS review_score,
         CASE WHEN event_id % 37 <> 0 THEN {text('ts', 'event_id % 41 = 0')} END AS review_creation_date,
         {text('ts + to_hours(CAST(event_id % 72 AS INTEGER))')} AS review_answer_timestamp
  FROM events),
reviews_raw AS (
  SELECT * EXCLUDE (k) FROM reviews_once
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('1' AS review_score, '~' AS order_id) FROM reviews_once WHERE k % 67 = 0),
products_once AS (
  SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 19 <> 0 THEN p_type END AS product_category_name,
         CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
         CAST(p_size AS DOUBLE) AS product_length_cm,
         CAST(p_size % 10 + 1 AS DOUBLE) AS product_height_cm,
         CAST(p_size % 7 + 1 AS DOUBLE) AS product_width_cm
  FROM part),
products_raw AS (
  SELECT * EXCLUDE (k) FROM products_once
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('~other' AS product_category_name) FROM products_once WHERE k % 47 = 0),
category_raw AS (
  SELECT p_type AS product_category_name, unnest([lower(p_type), '~' || lower(p_type)]) AS product_category_name_english
  FROM part WHERE p_type <> 'LARGE' GROUP BY p_type),
sellers_once AS (
  SELECT s.s_suppkey AS k, CAST(s.s_suppkey AS VARCHAR) AS seller_id, r.r_name AS seller_city, n.n_name AS seller_state
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
sellers_raw AS (
  SELECT * EXCLUDE (k) FROM sellers_once
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('~elsewhere' AS seller_state) FROM sellers_once WHERE k % 3 = 0),
retail_rows AS (
  SELECT (CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END) || CAST(l.l_orderkey AS VARCHAR) AS Invoice,
         CAST(l.l_partkey AS VARCHAR) AS StockCode,
         CASE WHEN l.l_partkey % 23 <> 0 THEN p.p_name END AS Description,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS BIGINT)
                   ELSE CAST(l.l_quantity AS BIGINT) END AS INTEGER) AS Quantity,
         {text('o.o_orderdate + to_hours(CAST(l.l_linenumber * 3 AS INTEGER))', '(l.l_orderkey + l.l_linenumber) % 97 = 0')} AS InvoiceDate,
         CAST(CAST((2 * CAST(round(l.l_extendedprice * 100) AS BIGINT) + CAST(l.l_quantity AS BIGINT))
                   // (2 * CAST(l.l_quantity AS BIGINT)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
              AS DECIMAL(18,2)) AS Price,
         CASE WHEN o.o_custkey % 17 <> 0 THEN o.o_custkey END AS "Customer ID",
         ' ' || n.n_name AS Country,
         l.l_orderkey AS k_
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey),
retail_raw AS (
  SELECT * EXCLUDE (k_) FROM retail_rows
  UNION ALL
  SELECT * EXCLUDE (k_) FROM retail_rows WHERE k_ % 50 = 0)"""

CLEAN = f"""
orders_typed AS (
  SELECT order_id, customer_id, order_status,
         {parsed('order_purchase_timestamp', 'order_approved_at', 'order_delivered_carrier_date',
                 'order_delivered_customer_date', 'order_estimated_delivery_date')}
  FROM orders_raw),
items_typed AS (SELECT * REPLACE ({parsed('shipping_limit_date')}) FROM order_items_raw),
reviews_typed AS (
  SELECT review_id, order_id, TRY_CAST(review_score AS INTEGER) AS review_score,
         {parsed('review_creation_date', 'review_answer_timestamp')}
  FROM reviews_raw),
retail_typed AS (SELECT * REPLACE ({parsed('InvoiceDate')}) FROM retail_raw),
orders_clean AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp NULLS FIRST,
             customer_id NULLS FIRST, order_status NULLS FIRST, order_approved_at NULLS FIRST,
             order_delivered_carrier_date NULLS FIRST, order_delivered_customer_date NULLS FIRST,
             order_estimated_delivery_date NULLS FIRST) AS rn_
    FROM orders_typed
    WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IS NOT NULL
      AND order_purchase_timestamp IS NOT NULL)
  WHERE rn_ = 1
    AND order_status IN ('delivered', 'shipped', 'canceled', 'unavailable', 'invoiced', 'processing',
                         'approved', 'created')),
customers_clean AS (
  SELECT customer_id, customer_unique_id, lower(trim(customer_city)) AS customer_city,
         upper(trim(customer_state)) AS customer_state
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
               customer_state NULLS FIRST, customer_city NULLS FIRST) AS rn_
        FROM customers_raw
        WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL AND customer_state IS NOT NULL)
  WHERE rn_ = 1),
items_clean AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id ORDER BY price NULLS FIRST,
             product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST,
             freight_value NULLS FIRST) AS rn_
    FROM items_typed
    WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL AND price IS NOT NULL
      AND price > 0 AND freight_value >= 0)
  WHERE rn_ = 1),
payments_clean AS (
  SELECT * FROM payments_raw
  WHERE order_id IS NOT NULL AND payment_type IS NOT NULL AND payment_value IS NOT NULL
    AND payment_value >= 0 AND payment_installments >= 1),
payments_agg AS (
  SELECT order_id,
         SUM(payment_value) AS total_payment_value,
         MAX(payment_installments) AS max_payment_installments,
         first(payment_type ORDER BY payment_sequential, payment_type) AS primary_payment_type,
         COUNT(payment_sequential) AS payment_methods_count
  FROM payments_clean GROUP BY order_id),
reviews_clean AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY order_id NULLS FIRST,
                              review_creation_date NULLS FIRST, review_score NULLS FIRST,
                              review_answer_timestamp NULLS FIRST) AS rn_
    FROM reviews_typed
    WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5)
  WHERE rn_ = 1),
reviews_latest AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
                                 ORDER BY review_creation_date DESC NULLS LAST, review_id DESC) AS rn_
    FROM reviews_clean)
  WHERE rn_ = 1),
category_clean AS (
  SELECT product_category_name, MIN(product_category_name_english) AS product_category_name_english
  FROM category_raw
  WHERE product_category_name IS NOT NULL AND product_category_name_english IS NOT NULL
  GROUP BY product_category_name),
products_dedup AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY product_category_name NULLS FIRST,
             product_weight_g NULLS FIRST, product_length_cm NULLS FIRST, product_height_cm NULLS FIRST,
             product_width_cm NULLS FIRST) AS rn_
    FROM products_raw WHERE product_id IS NOT NULL)
  WHERE rn_ = 1),
products_clean AS (
  SELECT p.product_category_name, p.product_id,
         p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
         COALESCE(c.product_category_name_english, 'other') AS product_category_name_english
  FROM (SELECT product_id, COALESCE(product_category_name, 'unknown') AS product_category_name,
               COALESCE(product_weight_g, 0.0) AS product_weight_g,
               COALESCE(product_length_cm, 0.0) AS product_length_cm,
               COALESCE(product_height_cm, 0.0) AS product_height_cm,
               COALESCE(product_width_cm, 0.0) AS product_width_cm
        FROM products_dedup) p
  LEFT JOIN category_clean c ON p.product_category_name = c.product_category_name),
sellers_clean AS (
  SELECT seller_id, lower(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY seller_state NULLS FIRST,
               seller_city NULLS FIRST) AS rn_
        FROM sellers_raw WHERE seller_id IS NOT NULL AND seller_state IS NOT NULL)
  WHERE rn_ = 1),
retail_clean AS (
  SELECT Invoice, StockCode, COALESCE(Description, 'UNKNOWN') AS Description, Quantity, InvoiceDate, Price,
         COALESCE("Customer ID", -1) AS "Customer ID", trim(Country) AS Country,
         ROUND(Quantity * CAST(Price AS DECIMAL(18,4)), 2) AS TotalLineValue
  FROM (SELECT DISTINCT * FROM retail_typed
        WHERE Invoice IS NOT NULL AND StockCode IS NOT NULL AND Quantity IS NOT NULL AND Price IS NOT NULL
          AND InvoiceDate IS NOT NULL AND Quantity > 0 AND Price > 0 AND NOT starts_with(Invoice, 'C')))"""

MASTER = f"""
items_agg AS (
  SELECT order_id,
         SUM(price) AS items_total_price,
         SUM(freight_value) AS items_total_freight,
         COUNT(order_item_id) AS items_count,
         CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_item_price,
         first(product_id ORDER BY order_item_id) AS main_product_id,
         first(seller_id ORDER BY order_item_id) AS main_seller_id
  FROM items_clean GROUP BY order_id),
master AS (
  SELECT o.*, c.customer_unique_id, c.customer_city, c.customer_state,
         i.items_total_price, i.items_total_freight, i.items_count, i.avg_item_price,
         i.main_product_id, i.main_seller_id,
         pa.total_payment_value, pa.max_payment_installments, pa.primary_payment_type, pa.payment_methods_count,
         r.review_score, r.review_creation_date, r.review_answer_timestamp,
         p.product_category_name_english, p.product_weight_g, p.product_length_cm, p.product_height_cm,
         p.product_width_cm, s.seller_state, s.seller_city
  FROM orders_clean o
  LEFT JOIN customers_clean c ON o.customer_id = c.customer_id
  LEFT JOIN items_agg i ON o.order_id = i.order_id
  LEFT JOIN payments_agg pa ON o.order_id = pa.order_id
  LEFT JOIN reviews_latest r ON o.order_id = r.order_id
  LEFT JOIN products_clean p ON i.main_product_id = p.product_id
  LEFT JOIN sellers_clean s ON i.main_seller_id = s.seller_id),
featured0 AS (
  SELECT *,
         {days('order_delivered_customer_date', 'order_estimated_delivery_date')} AS delay_,
         {days('order_delivered_customer_date', 'order_purchase_timestamp')} AS actual_,
         {days('order_approved_at', 'order_purchase_timestamp')} AS approve_,
         ROUND(items_total_price + items_total_freight, 2) AS total_order_value,
         CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS is_high_review,
         CASE WHEN order_status = 'delivered' THEN 1 ELSE 0 END AS is_delivered,
         year(order_purchase_timestamp) AS order_year,
         month(order_purchase_timestamp) AS order_month,
         dayofweek(order_purchase_timestamp) + 1 AS order_day_of_week,
         hour(order_purchase_timestamp) AS order_hour,
         product_length_cm * product_height_cm * product_width_cm AS volume_,
         (epoch_ms(review_answer_timestamp) // 1000 - epoch_ms(review_creation_date) // 1000) / 3600 AS response_
  FROM master),
featured AS (
  SELECT * EXCLUDE (delay_, actual_, approve_, volume_, response_, review_score, product_weight_g,
                    product_category_name_english),
         COALESCE(review_score, 3) AS review_score,
         COALESCE(product_weight_g, 0.0) AS product_weight_g,
         COALESCE(product_category_name_english, 'unknown') AS product_category_name_english,
         COALESCE(delay_, 0) AS delivery_delay_days,
         CASE WHEN delay_ > 0 THEN 1 ELSE 0 END AS is_late_delivery,
         COALESCE(actual_, 0) AS actual_delivery_days,
         COALESCE(approve_, 0) AS days_to_approve,
         COALESCE(volume_, 0.0) AS product_volume_cm3,
         COALESCE(response_, 0.0) AS review_response_hours
  FROM featured0)"""

RFM = """
rfm_base AS (
  SELECT customer_unique_id,
         (SELECT CAST(MAX(order_purchase_timestamp) AS DATE) FROM featured)
           - CAST(MAX(order_purchase_timestamp) AS DATE) AS recency_days,
         COUNT(order_id) AS frequency,
         COALESCE(SUM(total_order_value), 0) AS monetary
  FROM featured WHERE order_status = 'delivered' GROUP BY customer_unique_id),
rfm_best0 AS (
  SELECT *,
         NTILE(4) OVER (ORDER BY recency_days DESC, customer_unique_id ASC NULLS FIRST) AS R_score,
         NTILE(4) OVER (ORDER BY frequency ASC, customer_unique_id ASC NULLS FIRST) AS F_score,
         NTILE(4) OVER (ORDER BY monetary ASC, customer_unique_id ASC NULLS FIRST) AS M_score
  FROM rfm_base),
rfm_coded0 AS (
  SELECT *,
         NTILE(4) OVER (ORDER BY recency_days ASC, customer_unique_id ASC NULLS FIRST) AS R_score,
         NTILE(4) OVER (ORDER BY frequency DESC, customer_unique_id ASC NULLS FIRST) AS F_score,
         NTILE(4) OVER (ORDER BY monetary DESC, customer_unique_id ASC NULLS FIRST) AS M_score
  FROM rfm_base),
rfm_best AS (
  SELECT *, R_score + F_score + M_score AS RFM_score,
         CASE WHEN R_score + F_score + M_score >= 10 THEN 'Champions'
              WHEN R_score + F_score + M_score >= 7 THEN 'Loyal Customers'
              WHEN R_score + F_score + M_score >= 5 THEN 'At Risk'
              ELSE 'Lost Customers' END AS customer_segment
  FROM rfm_best0),
rfm_coded AS (
  SELECT *, R_score + F_score + M_score AS RFM_score,
         CASE WHEN R_score + F_score + M_score >= 10 THEN 'Champions'
              WHEN R_score + F_score + M_score >= 7 THEN 'Loyal Customers'
              WHEN R_score + F_score + M_score >= 5 THEN 'At Risk'
              ELSE 'Lost Customers' END AS customer_segment
  FROM rfm_coded0)"""

RETAIL = """
retail_lines AS (
  SELECT *, year(InvoiceDate) AS InvoiceYear, month(InvoiceDate) AS InvoiceMonth,
         dayofweek(InvoiceDate) + 1 AS InvoiceDayOfWeek, hour(InvoiceDate) AS InvoiceHour
  FROM retail_clean),
retail_median AS (
  SELECT TotalLineValue AS m FROM (
    SELECT TotalLineValue, ROW_NUMBER() OVER (ORDER BY TotalLineValue) AS rn, COUNT(*) OVER () AS n
    FROM retail_lines WHERE TotalLineValue IS NOT NULL)
  WHERE rn = CAST(CEIL(0.5 * n) AS BIGINT)),
retail_featured AS (
  SELECT *, CASE WHEN TotalLineValue > (SELECT m FROM retail_median) THEN 1 ELSE 0 END AS is_high_value
  FROM retail_lines),
rfm_retail AS (
  SELECT "Customer ID",
         (SELECT CAST(MAX(InvoiceDate) AS DATE) FROM retail_featured) - CAST(MAX(InvoiceDate) AS DATE) AS recency_days,
         COUNT(DISTINCT Invoice) AS frequency,
         COALESCE(SUM(TotalLineValue), 0) AS monetary
  FROM retail_featured WHERE "Customer ID" <> -1 GROUP BY "Customer ID")"""

WITH = "WITH " + ",".join([RAW, CLEAN, MASTER, RFM, RETAIL])

DELIVERED = "order_status = 'delivered'"
DAY_NAME = ("CASE order_day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' "
            "WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday' END")


def ym(y: str, m: str) -> str:
    return f"CAST({y} AS VARCHAR) || '-' || LPAD(CAST({m} AS VARCHAR), 2, '0')"


TOV = "total_order_value"

QUESTIONS = {
    "q01_revenue_kpis": f"""
SELECT COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_unique_id) AS unique_customers,
       {money(f'SUM({TOV})')} AS total_revenue, {avg(TOV, 2)} AS avg_order_value,
       {money(f'MAX({TOV})')} AS max_order_value, {money(f'MIN({TOV})')} AS min_order_value
FROM featured WHERE {DELIVERED}""",
    "q02_monthly_revenue": f"""
SELECT CAST(order_year AS BIGINT) AS order_year, CAST(order_month AS BIGINT) AS order_month,
       {ym('order_year', 'order_month')} AS year_month,
       COUNT(DISTINCT order_id) AS orders_count, {money(f'SUM({TOV})')} AS monthly_revenue
FROM featured WHERE {DELIVERED} AND order_year IN (1997, 1998)
GROUP BY order_year, order_month ORDER BY order_year, order_month""",
    "q03_revenue_by_state": f"""
SELECT customer_state, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_unique_id) AS customers,
       {money(f'SUM({TOV})')} AS revenue, {avg(TOV, 2)} AS avg_order_value
FROM featured WHERE {DELIVERED}
GROUP BY customer_state ORDER BY revenue DESC NULLS LAST, customer_state ASC NULLS FIRST LIMIT 10""",
    "q04_orders_by_weekday": f"""
SELECT {DAY_NAME} AS day_name, CAST(order_day_of_week AS BIGINT) AS order_day_of_week,
       COUNT(*) AS orders_count, {avg(TOV, 2)} AS avg_order_value
FROM featured GROUP BY order_day_of_week ORDER BY order_day_of_week""",
    "q05_segments": f"""
SELECT customer_segment, COUNT(*) AS customer_count,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage,
       {avg('monetary', 2)} AS avg_monetary, {avg('frequency', 2)} AS avg_frequency,
       {avg('recency_days', 1)} AS avg_recency_days
FROM rfm_best GROUP BY customer_segment ORDER BY customer_count DESC, customer_segment""",
    "q05_segments_as_coded": f"""
SELECT customer_segment, COUNT(*) AS customer_count,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage,
       {avg('monetary', 2)} AS avg_monetary, {avg('frequency', 2)} AS avg_frequency,
       {avg('recency_days', 1)} AS avg_recency_days
FROM rfm_coded GROUP BY customer_segment ORDER BY customer_count DESC, customer_segment""",
    "q06_repeat_customers": f"""
SELECT CASE WHEN frequency > 1 THEN 'Repeat Customer' ELSE 'One-Time Customer' END AS customer_type,
       COUNT(*) AS customer_count, {avg('monetary', 2)} AS avg_spend
FROM rfm_best GROUP BY 1 ORDER BY customer_count DESC, customer_type""",
    "q07_late_share": f"""
SELECT CASE WHEN is_late_delivery = 1 THEN 'Late' ELSE 'On Time' END AS delivery_status,
       COUNT(*) AS order_count, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage
FROM featured WHERE {DELIVERED} AND delivery_delay_days IS NOT NULL GROUP BY is_late_delivery""",
    "q08_slowest_states": f"""
SELECT customer_state, {avg('actual_delivery_days', 1)} AS avg_delivery_days,
       {avg('delivery_delay_days', 1)} AS avg_delay_days, COUNT(*) AS delivered_orders,
       CAST(SUM(is_late_delivery) AS BIGINT) AS late_orders
FROM featured WHERE {DELIVERED} AND actual_delivery_days > 0
GROUP BY customer_state ORDER BY avg_delivery_days DESC NULLS LAST, customer_state ASC NULLS FIRST LIMIT 10""",
    "q09_delivery_by_year": f"""
SELECT CAST(order_year AS BIGINT) AS order_year, COUNT(*) AS total_delivered,
       CAST(SUM(is_late_delivery) AS BIGINT) AS late_deliveries,
       {pct('SUM(is_late_delivery)', 'COUNT(*)')} AS late_pct,
       {avg('actual_delivery_days', 1)} AS avg_delivery_days
FROM featured WHERE {DELIVERED} AND actual_delivery_days > 0 GROUP BY order_year ORDER BY order_year""",
    "q10_top_categories": f"""
SELECT product_category_name_english AS category, COUNT(DISTINCT order_id) AS orders,
       {money(f'SUM({TOV})')} AS total_revenue, {avg(TOV, 2)} AS avg_order_value,
       {avg('review_score', 2)} AS avg_review_score
FROM featured WHERE {DELIVERED} AND product_category_name_english != 'unknown'
GROUP BY product_category_name_english ORDER BY total_revenue DESC NULLS LAST, category LIMIT 10""",
    "q11_scores_by_category": f"""
SELECT product_category_name_english AS category, COUNT(*) AS reviews_count,
       {avg('review_score', 2)} AS avg_score,
       CAST(SUM(CASE WHEN review_score = 5 THEN 1 ELSE 0 END) AS BIGINT) AS score_5,
       CAST(SUM(CASE WHEN review_score = 4 THEN 1 ELSE 0 END) AS BIGINT) AS score_4,
       CAST(SUM(CASE WHEN review_score = 3 THEN 1 ELSE 0 END) AS BIGINT) AS score_3,
       CAST(SUM(CASE WHEN review_score <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS score_1_2
FROM featured WHERE product_category_name_english NOT IN ('unknown', 'other')
GROUP BY product_category_name_english ORDER BY reviews_count DESC, category LIMIT 10""",
    "q12_payment_types": f"""
SELECT primary_payment_type, COUNT(*) AS orders_count,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage,
       {avg('total_payment_value', 2)} AS avg_payment, {money('SUM(total_payment_value)')} AS total_payment
FROM featured GROUP BY primary_payment_type ORDER BY orders_count DESC, primary_payment_type NULLS FIRST""",
    "q13_installments": f"""
SELECT CAST(max_payment_installments AS BIGINT) AS installments, COUNT(*) AS orders_count,
       {avg('total_payment_value', 2)} AS avg_payment, {money('SUM(total_payment_value)')} AS total_payment
FROM featured WHERE max_payment_installments <= 12
GROUP BY max_payment_installments ORDER BY installments""",
    "q14_score_distribution": f"""
SELECT CAST(review_score AS BIGINT) AS review_score, COUNT(*) AS count,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage
FROM featured WHERE review_score IS NOT NULL GROUP BY review_score ORDER BY review_score DESC""",
    "q15_score_vs_lateness": f"""
SELECT CAST(is_late_delivery AS BIGINT) AS is_late_delivery, {avg('review_score', 3)} AS avg_review_score,
       COUNT(*) AS orders_count
FROM featured WHERE review_score IS NOT NULL AND {DELIVERED} GROUP BY is_late_delivery""",
    "q16_top_countries": f"""
SELECT Country, COUNT(DISTINCT Invoice) AS invoices, COUNT(*) AS line_items,
       {money('SUM(TotalLineValue)')} AS total_revenue, {avg('TotalLineValue', 2)} AS avg_line_value
FROM retail_featured GROUP BY Country ORDER BY total_revenue DESC NULLS LAST, Country ASC NULLS FIRST LIMIT 10""",
    "q17_retail_monthly": f"""
SELECT CAST(InvoiceYear AS BIGINT) AS year, CAST(InvoiceMonth AS BIGINT) AS month,
       {ym('InvoiceYear', 'InvoiceMonth')} AS year_month,
       COUNT(DISTINCT Invoice) AS invoices, {money('SUM(TotalLineValue)')} AS monthly_revenue
FROM retail_featured GROUP BY InvoiceYear, InvoiceMonth ORDER BY InvoiceYear, InvoiceMonth""",
    "q18_best_sellers": f"""
SELECT StockCode, Description, CAST(SUM(Quantity) AS BIGINT) AS units_sold,
       {money('SUM(TotalLineValue)')} AS total_revenue, {avg('Price', 2)} AS avg_price
FROM retail_featured GROUP BY StockCode, Description
ORDER BY units_sold DESC, StockCode, Description LIMIT 10""",
    "q19_sales_by_hour": f"""
SELECT CAST(InvoiceHour AS BIGINT) AS hour_of_day, COUNT(DISTINCT Invoice) AS invoices,
       {money('SUM(TotalLineValue)')} AS revenue
FROM retail_featured GROUP BY InvoiceHour ORDER BY InvoiceHour""",
    "q20_high_low_value": f"""
SELECT CASE WHEN is_high_value = 1 THEN 'High Value' ELSE 'Low Value' END AS purchase_type,
       COUNT(*) AS transaction_count, {money('SUM(TotalLineValue)')} AS total_revenue,
       {avg('TotalLineValue', 2)} AS avg_value
FROM retail_featured GROUP BY is_high_value""",
    "r1_monthly": f"""
SELECT CAST(order_year AS BIGINT) AS order_year, CAST(order_month AS BIGINT) AS order_month,
       {ym('order_year', 'order_month')} AS year_month,
       COUNT(DISTINCT order_id) AS orders_count, {money(f'SUM({TOV})')} AS monthly_revenue,
       {avg(TOV, 2)} AS avg_order_value
FROM featured WHERE {DELIVERED} GROUP BY order_year, order_month ORDER BY order_year, order_month""",
    "r2_category": f"""
SELECT product_category_name_english AS category, COUNT(DISTINCT order_id) AS orders,
       {money(f'SUM({TOV})')} AS revenue, {avg('review_score', 2)} AS avg_review_score,
       {avg('actual_delivery_days', 1)} AS avg_delivery_days
FROM featured WHERE {DELIVERED} AND product_category_name_english NOT IN ('unknown', 'other')
GROUP BY product_category_name_english ORDER BY revenue DESC NULLS LAST, category""",
    "r3_state": f"""
SELECT customer_state, COUNT(DISTINCT customer_unique_id) AS customers, COUNT(DISTINCT order_id) AS orders,
       {money(f'SUM({TOV})')} AS revenue, {avg('actual_delivery_days', 1)} AS avg_delivery_days,
       {pct('SUM(is_late_delivery)', 'COUNT(*)')} AS late_pct
FROM featured WHERE {DELIVERED} GROUP BY customer_state""",
    "r4_payments": f"""
SELECT primary_payment_type, COUNT(*) AS orders, {money('SUM(total_payment_value)')} AS total_payment,
       {avg('total_payment_value', 2)} AS avg_payment
FROM featured GROUP BY primary_payment_type ORDER BY orders DESC, primary_payment_type NULLS FIRST""",
}


def queries() -> dict[str, str]:
    """Full SQL text per registered query name."""
    return {name: WITH + CLUSTER_BASE + "\n" + body.strip() for name, body in {**QUESTIONS, **TABLES}.items()}


TABLES: dict[str, str] = {}

# Column kinds of the tables returned whole: s text, i BIGINT, d DOUBLE, t timestamp as text.
ORDERS_COLS = [("order_id", "s"), ("customer_id", "s"), ("order_status", "s"), ("order_purchase_timestamp", "t"),
               ("order_approved_at", "t"), ("order_delivered_carrier_date", "t"),
               ("order_delivered_customer_date", "t"), ("order_estimated_delivery_date", "t")]
CUSTOMERS_COLS = [("customer_id", "s"), ("customer_unique_id", "s"), ("customer_city", "s"), ("customer_state", "s")]
ITEMS_COLS = [("order_id", "s"), ("order_item_id", "i"), ("product_id", "s"), ("seller_id", "s"),
              ("shipping_limit_date", "t"), ("price", "d"), ("freight_value", "d")]
PAYMENTS_RAW_COLS = [("order_id", "s"), ("payment_sequential", "i"), ("payment_type", "s"),
                     ("payment_installments", "i"), ("payment_value", "d")]
PAYMENTS_AGG_COLS = [("order_id", "s"), ("total_payment_value", "d"), ("max_payment_installments", "i"),
                     ("primary_payment_type", "s"), ("payment_methods_count", "i")]
ITEMS_AGG_COLS = [("order_id", "s"), ("items_total_price", "d"), ("items_total_freight", "d"), ("items_count", "i"),
                  ("avg_item_price", "d"), ("main_product_id", "s"), ("main_seller_id", "s")]
REVIEWS_COLS = [("review_id", "s"), ("order_id", "s"), ("review_score", "i"), ("review_creation_date", "t"),
                ("review_answer_timestamp", "t")]
REVIEWS_RAW_COLS = [("review_id", "s"), ("order_id", "s"), ("review_score", "s"), ("review_creation_date", "t"),
                    ("review_answer_timestamp", "t")]
PRODUCTS_RAW_COLS = [("product_id", "s"), ("product_category_name", "s"), ("product_weight_g", "d"),
                     ("product_length_cm", "d"), ("product_height_cm", "d"), ("product_width_cm", "d")]
PRODUCTS_COLS = [("product_category_name", "s"), ("product_id", "s"), ("product_weight_g", "d"),
                 ("product_length_cm", "d"), ("product_height_cm", "d"), ("product_width_cm", "d"),
                 ("product_category_name_english", "s")]
SELLERS_COLS = [("seller_id", "s"), ("seller_city", "s"), ("seller_state", "s")]
RETAIL_RAW_COLS = [("Invoice", "s"), ("StockCode", "s"), ("Description", "s"), ("Quantity", "i"),
                   ("InvoiceDate", "t"), ("Price", "d"), ("Customer ID", "i"), ("Country", "s")]
RETAIL_COLS = RETAIL_RAW_COLS + [("TotalLineValue", "d")]
RETAIL_FEATURED_COLS = RETAIL_COLS + [("InvoiceYear", "i"), ("InvoiceMonth", "i"), ("InvoiceDayOfWeek", "i"),
                                      ("InvoiceHour", "i"), ("is_high_value", "i")]
FEATURED_COLS = (ORDERS_COLS + CUSTOMERS_COLS[1:] + ITEMS_AGG_COLS[1:] + PAYMENTS_AGG_COLS[1:]
                 + [("review_score", "i"), ("review_creation_date", "t"), ("review_answer_timestamp", "t"),
                    ("product_category_name_english", "s"), ("product_weight_g", "d"), ("product_length_cm", "d"),
                    ("product_height_cm", "d"), ("product_width_cm", "d"), ("seller_state", "s"),
                    ("seller_city", "s"), ("delivery_delay_days", "i"), ("actual_delivery_days", "i"),
                    ("days_to_approve", "i"), ("total_order_value", "d"), ("is_high_review", "i"),
                    ("is_delivered", "i"), ("order_year", "i"), ("order_month", "i"), ("order_day_of_week", "i"),
                    ("order_hour", "i"), ("product_volume_cm3", "d"), ("review_response_hours", "d"),
                    ("is_late_delivery", "i")])
RFM_COLS = [("customer_unique_id", "s"), ("recency_days", "i"), ("frequency", "i"), ("monetary", "d"),
            ("R_score", "i"), ("F_score", "i"), ("M_score", "i"), ("RFM_score", "i"), ("customer_segment", "s")]
RFM_RETAIL_COLS = [("Customer ID", "i"), ("recency_days", "i"), ("frequency", "i"), ("monetary", "d")]

NULLABLE_COUNTS = {"items_count", "max_payment_installments", "payment_methods_count"}

RAW_TABLES = {  # profile name -> (raw CTE, columns)
    "orders": ("orders_raw", ORDERS_COLS),
    "customers": ("customers_raw", CUSTOMERS_COLS),
    "order_items": ("order_items_raw", ITEMS_COLS),
    "payments": ("payments_raw", PAYMENTS_RAW_COLS),
    "reviews": ("reviews_raw", REVIEWS_RAW_COLS),
    "products": ("products_raw", PRODUCTS_RAW_COLS),
    "sellers": ("sellers_raw", SELLERS_COLS),
    "retail": ("retail_raw", RETAIL_RAW_COLS),
}
CLEAN_TABLES = {  # profile name -> (clean CTE, columns)
    "orders_clean": ("orders_clean", ORDERS_COLS),
    "customers_clean": ("customers_clean", CUSTOMERS_COLS),
    "order_items_clean": ("items_clean", ITEMS_COLS),
    "payments_agg": ("payments_agg", PAYMENTS_AGG_COLS),
    "reviews_dedup": ("reviews_latest", REVIEWS_COLS),
    "products_clean": ("products_clean", PRODUCTS_COLS),
    "sellers_clean": ("sellers_clean", SELLERS_COLS),
    "retail_clean": ("retail_clean", RETAIL_COLS),
}
RECONCILE = {  # table -> (raw CTE, clean CTE)
    "orders": ("orders_raw", "orders_clean"),
    "customers": ("customers_raw", "customers_clean"),
    "order_items": ("order_items_raw", "items_clean"),
    "payments": ("payments_raw", "payments_clean"),
    "reviews": ("reviews_raw", "reviews_latest"),
    "products": ("products_raw", "products_clean"),
    "sellers": ("sellers_raw", "sellers_clean"),
    "retail": ("retail_raw", "retail_clean"),
}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def edge(col: str, kind: str) -> str:
    c = q(col)
    return {"s": f"CAST({c} AS VARCHAR)", "i": f"CAST({c} AS BIGINT)", "d": f"CAST({c} AS DOUBLE)",
            "t": ts(c)}[kind] + f" AS {c}"


def select_table(cte: str, cols) -> str:
    return f"SELECT {', '.join(edge(c, k) for c, k in cols)} FROM {cte}"


def _null_profile() -> str:
    parts = []
    for name, (cte, cols) in RAW_TABLES.items():
        for c, _ in cols:
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                         f"COUNT(*) - COUNT({q(c)}) AS null_count, "
                         f"{pct(f'COUNT(*) - COUNT({q(c)})', 'COUNT(*)', 1)} AS null_pct FROM {cte}")
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE null_count > 0"


def _null_total() -> str:
    parts = []
    for name, (cte, cols) in CLEAN_TABLES.items():
        nulls = " + ".join(f"(COUNT(*) - COUNT({q(c)}))" for c, _ in cols)
        parts.append(f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST({nulls} AS BIGINT) AS total_nulls "
                     f"FROM {cte}")
    return "\nUNION ALL ".join(parts)


def _row_counts() -> str:
    parts = [f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {cte}" for name, (cte, _) in RAW_TABLES.items()]
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT table_name, row_count FROM ({body}) UNION ALL "
            f"SELECT 'TOTAL', CAST(SUM(row_count) AS BIGINT) FROM ({body})")


def _clean_report() -> str:
    parts = []
    for name, (raw, clean) in RECONCILE.items():
        parts.append(f"SELECT '{name}' AS table_name, (SELECT COUNT(*) FROM {raw}) AS raw_rows, "
                     f"(SELECT COUNT(*) FROM {clean}) AS clean_rows")
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT table_name, raw_rows, clean_rows, raw_rows - clean_rows AS dropped_rows, "
            f"{pct('raw_rows - clean_rows', 'raw_rows')} AS dropped_pct FROM ({body})")


DESCRIBE_COLS = ["delivery_delay_days", "actual_delivery_days", "days_to_approve", "total_order_value",
                 "review_score", "items_count", "product_weight_g"]


def _describe(source: str = "featured", cols=None) -> str:
    parts = []
    for c in cols or DESCRIBE_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {avg(c, 6)} AS mean, "
                     f"{rhu(f'stddev_samp({x})', 6)} AS stddev, MIN({x}) AS min, MAX({x}) AS max FROM {source}")
    return "\nUNION ALL ".join(parts)


def _exact_q(cte: str, col: str, p: float) -> str:
    return (f"(SELECT v FROM (SELECT {q(col)} AS v, ROW_NUMBER() OVER (ORDER BY {q(col)}) AS rn, "
            f"COUNT(*) OVER () AS n FROM {cte} WHERE {q(col)} IS NOT NULL) WHERE rn = CAST(CEIL({p} * n) AS BIGINT))")


def _rfm_capped() -> str:
    return (f"SELECT CAST(\"Customer ID\" AS BIGINT) AS \"Customer ID\", "
            f"CAST(LEAST(recency_days, {_exact_q('cb', 'recency_days', 0.99)}) AS BIGINT) AS recency_days, "
            f"CAST(LEAST(frequency, {_exact_q('cb', 'frequency', 0.99)}) AS BIGINT) AS frequency, "
            f"CAST(LEAST(monetary, {_exact_q('cb', 'monetary', 0.99)}) AS DOUBLE) AS monetary FROM cb")


CLUSTER_BASE = """,
cb AS (
  SELECT "Customer ID", recency_days, frequency, ROUND(monetary, 2) AS monetary
  FROM rfm_retail WHERE ROUND(monetary, 2) > 0)"""


ML_PREP = """
SELECT * FROM featured WHERE order_status = 'delivered' AND actual_delivery_days IS NOT NULL
  AND total_order_value IS NOT NULL AND review_score IS NOT NULL"""

TABLES.update({
    "row_counts": _row_counts(),
    "null_profile": _null_profile(),
    "null_total": _null_total(),
    "clean_report": _clean_report(),
    "describe_orders": _describe(),
    "clean_orders": select_table("orders_clean", ORDERS_COLS),
    "clean_customers": select_table("customers_clean", CUSTOMERS_COLS),
    "dedup_items": select_table("items_clean", ITEMS_COLS),
    "payments_agg": select_table("payments_agg", PAYMENTS_AGG_COLS),
    "items_agg": select_table("items_agg", ITEMS_AGG_COLS),
    "latest_review": select_table("reviews_latest", REVIEWS_COLS),
    "products_translated": select_table("products_clean", PRODUCTS_COLS),
    "clean_sellers": select_table("sellers_clean", SELLERS_COLS),
    "clean_payments": select_table("payments_clean", PAYMENTS_RAW_COLS),
    "clean_reviews": select_table("reviews_clean", REVIEWS_COLS),
    "category_clean": select_table("category_clean", [("product_category_name", "s"),
                                                      ("product_category_name_english", "s")]),
    "rfm_retail_ml": select_table("cb", RFM_RETAIL_COLS),
    "master_featured": select_table("featured", [(c, "d" if c in NULLABLE_COUNTS else k) for c, k in FEATURED_COLS]),
    "retail_clean": select_table("retail_clean", RETAIL_COLS),
    "retail_featured": select_table("retail_featured", RETAIL_FEATURED_COLS),
    "rfm_orders_best_high": select_table("rfm_best", RFM_COLS),
    "rfm_orders_as_coded": select_table("rfm_coded", RFM_COLS),
    "rfm_retail": select_table("rfm_retail", RFM_RETAIL_COLS),
    "segment_counts": "SELECT customer_segment, COUNT(*) AS count FROM rfm_best GROUP BY customer_segment "
                      "ORDER BY count DESC, customer_segment",
    "rfm_capped_exact": _rfm_capped(),
    "class_balance_review": f"SELECT CAST(is_high_review AS BIGINT) AS label, COUNT(*) AS row_count, "
                            f"{pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_pct FROM ({ML_PREP}) "
                            f"GROUP BY is_high_review",
    "class_balance_retail": f"SELECT CAST(is_high_value AS BIGINT) AS label, COUNT(*) AS row_count, "
                            f"{pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_pct FROM retail_featured "
                            f"GROUP BY is_high_value",
    "describe_ml_orders": _describe(f"({ML_PREP})", ["is_late_delivery", "is_high_review", "is_delivered"]),
    "class_balance": f"SELECT CAST(is_late_delivery AS BIGINT) AS label, COUNT(*) AS row_count, "
                     f"{pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_pct FROM ({ML_PREP}) GROUP BY is_late_delivery",
})


# -- model input frames ---------------------------------------------------------
# Fills applied before training (same as the library's prep).
ORDER_ML_FILLS = {
    "delivery_delay_days": "0", "days_to_approve": "0", "actual_delivery_days": "0",
    "product_weight_g": "500.0", "product_volume_cm3": "1000.0", "items_count": "1", "avg_item_price": "0.0",
    "max_payment_installments": "1", "customer_state": "'SP'", "seller_state": "'SP'",
    "product_category_name_english": "'other'", "primary_payment_type": "'credit_card'",
}
ORDER_STATUS_ML_FILLS = {
    "total_payment_value": "0.0", "max_payment_installments": "1", "items_count": "1",
    "items_total_freight": "0.0", "items_total_price": "0.0", "avg_item_price": "0.0",
    "customer_state": "'SP'", "primary_payment_type": "'credit_card'", "is_delivered": "0",
}


def _frame(source: str, fills: dict, numeric: list[str], categorical: list[str], label: str) -> str:
    def val(c):
        return f"COALESCE({q(c)}, {fills[c]})" if c in fills else q(c)
    cols = ([f"CAST({val(c)} AS DOUBLE) AS {q(c)}" for c in numeric]
            + [f"CAST({val(c)} AS VARCHAR) AS {q(c)}" for c in categorical]
            + [f"CAST({val(label)} AS BIGINT) AS {q(label)}"])
    inner = f"SELECT {', '.join(cols)} FROM {source}"
    every = " AND ".join(f"{q(c)} IS NOT NULL" for c in numeric + categorical + [label])
    return f"SELECT * FROM ({inner}) WHERE {every}"


def _model_frames() -> dict[str, str]:
    from emporia.models.classifiers import SPECS
    gbt_source = ("(SELECT * REPLACE (COALESCE(Country, 'United Kingdom') AS Country) FROM retail_featured)")
    sources = {"lr": (f"({ML_PREP})", ORDER_ML_FILLS), "rf": (f"({ML_PREP})", ORDER_ML_FILLS),
               "dt": ("featured", ORDER_STATUS_ML_FILLS), "gbt": (gbt_source, {})}
    return {f"ml_frame_{k}": _frame(src, fills, SPECS[k].numeric, SPECS[k].categorical, SPECS[k].label)
            for k, (src, fills) in sources.items()}


TABLES.update(_model_frames())


# -- model data steps: split, sample, index, scale ------------------------------

def bucket(key: str, buckets: int, seed: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || {key}), 1, 8) AS BIGINT) % {buckets}"


def _keyed_frames() -> dict[str, str]:
    """Each model's frame with its row key; the key column is not part of the completeness rule."""
    from emporia.models.classifiers import SPECS
    gbt = "(SELECT * REPLACE (COALESCE(Country, 'United Kingdom') AS Country) FROM retail_featured)"
    sources = {"lr": (f"({ML_PREP})", ORDER_ML_FILLS, "order_id"), "rf": (f"({ML_PREP})", ORDER_ML_FILLS, "order_id"),
               "dt": ("featured", ORDER_STATUS_ML_FILLS, "order_id"), "gbt": (gbt, {}, "Invoice || '|' || StockCode")}
    out = {}
    for name, (source, fills, key) in sources.items():
        spec = SPECS[name]
        frame = _frame(source, fills, spec.numeric, spec.categorical, spec.label)
        out[name] = frame.replace("SELECT * FROM (SELECT ", f"SELECT * FROM (SELECT {key} AS _key, ", 1)
    return out


def _model_steps() -> dict[str, str]:
    from emporia.models.classifiers import SPECS
    frames = _keyed_frames()
    train = {k: f"(SELECT * FROM ({f}) WHERE {bucket('_key', 100, 42)} < 80)" for k, f in frames.items()}
    sizes = "\nUNION ALL ".join(
        f"SELECT '{SPECS[k].name}' AS model, CASE WHEN {bucket('_key', 100, 42)} < 80 THEN 'train' ELSE 'test' END AS part, "
        f"COUNT(*) AS row_count FROM ({f}) GROUP BY ALL" for k, f in frames.items())
    labels = "\nUNION ALL ".join(
        f"SELECT '{SPECS[k].name}' AS model, '{c}' AS column_name, {q(c)} AS value, "
        f"ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {q(c)}) - 1 AS idx FROM {train[k]} GROUP BY {q(c)}"
        for k in frames for c in SPECS[k].categorical)
    factors = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {rhu(f'stddev_samp({q(c)})', 6)} AS std FROM {train['lr']}" for c in SPECS["lr"].numeric)
    label = SPECS["gbt"].label
    balance = (f"SELECT CAST({label} AS BIGINT) AS label, COUNT(*) AS row_count, "
               f"{pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_pct FROM ({frames['gbt']}) "
               f"WHERE {bucket('_key', 10000, 43)} < 2500 GROUP BY {label}")
    measures = ("recency_days", "frequency", "monetary")
    scaled = ", ".join(rhu(f"(CAST({c} AS DOUBLE) - MIN(CAST({c} AS DOUBLE)) OVER ()) / "
                           f"(MAX(CAST({c} AS DOUBLE)) OVER () - MIN(CAST({c} AS DOUBLE)) OVER ())", 6) + f" AS {c}" for c in measures)
    return {"split_sizes": sizes, "index_labels": labels, "scale_factors": factors, "gbt_sample_balance": balance,
            "rfm_scaled": f'SELECT "Customer ID", {scaled} FROM ({_rfm_capped()})'}


TABLES.update(_model_steps())

# Per table: source, required columns, further rules, key columns, and the clean table judged after the key.
REJECT = {
    "orders": ("orders_typed", ["order_id", "customer_id", "order_status", "order_purchase_timestamp"], {}, "order_id",
               ("known status", "orders_clean")),
    "customers": ("customers_raw", ["customer_id", "customer_unique_id", "customer_state"], {}, "customer_id", None),
    "order_items": ("items_typed", ["order_id", "product_id", "seller_id", "price"],
                    {"price above 0": "price > 0", "freight not below 0": "freight_value >= 0"}, "order_id, order_item_id", None),
    "payments": ("payments_raw", ["order_id", "payment_type", "payment_value"],
                 {"value not below 0": "payment_value >= 0", "at least one installment": "payment_installments >= 1"}, "", None),
    "reviews": ("reviews_typed", ["review_id", "order_id"], {"score from 1 to 5": "review_score BETWEEN 1 AND 5"}, "review_id", None),
    "category_translation": ("category_raw", ["product_category_name", "product_category_name_english"], {},
                             "product_category_name", None),
    "products": ("products_raw", ["product_id"], {}, "product_id", None),
    "sellers": ("sellers_raw", ["seller_id", "seller_state"], {}, "seller_id", None),
    "retail": ("retail_typed", ["Invoice", "StockCode", "Quantity", "Price", "InvoiceDate"],
               {"quantity above 0": "Quantity > 0", "price above 0": "Price > 0", "not cancelled": "NOT starts_with(Invoice, 'C')"},
               "*", None),
}


def _rejected() -> str:
    parts = []
    for name, (source, required, rules, key, after) in REJECT.items():
        tests = {f"{c} present": f"{q(c)} IS NOT NULL" for c in required} | rules
        passed = "TRUE"
        for rule, test in tests.items():
            holds = f"COALESCE({test}, FALSE)"
            parts.append(f"SELECT '{name}' AS table_name, '{rule}' AS rule, COUNT(*) FILTER ({passed} AND NOT {holds}) AS rejected "
                         f"FROM {source}")
            passed += f" AND {holds}"
        kept = f"(SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {source} WHERE {passed}))"
        if key:
            parts.append(f"SELECT '{name}', 'one row per key', (SELECT COUNT(*) FROM {source} WHERE {passed}) - {kept}")
        if after:
            parts.append(f"SELECT '{name}', '{after[0]}', {kept} - (SELECT COUNT(*) FROM {after[1]})")
    return "\nUNION ALL ".join(parts)


def _exports() -> str:
    tables = {"master_featured.parquet": "featured", "master_featured_csv": "featured", "rfm_olist_csv": "rfm_best",
              "online_retail_featured_csv": "retail_featured", "rfm_retail_csv": "rfm_retail"}
    summaries = {"monthly_revenue": "r1_monthly", "category_revenue": "r2_category", "state": "r3_state", "payments": "r4_payments"}
    parts = [f"SELECT '{e}' AS export, COUNT(*) AS row_count FROM {t}" for e, t in tables.items()]
    parts += [f"SELECT 'summary_{e}', COUNT(*) FROM ({QUESTIONS[name]})" for e, name in summaries.items()]
    return "\nUNION ALL ".join(parts)


def _quarantine() -> str:
    k = "(CAST(order_id AS BIGINT) + order_item_id)"
    reason = (f"CASE WHEN {k} % 101 = 0 THEN 'too few fields' WHEN {k} % 103 = 0 THEN 'too many fields' "
              f"WHEN {k} % 107 = 0 THEN 'badly quoted' ELSE 'kept' END")
    return (f"SELECT {reason} AS reason, COUNT(*) AS row_count, "
            f"CAST(CASE WHEN {reason} = 'kept' THEN SUM(order_item_id) END AS BIGINT) AS item_sum FROM order_items_raw GROUP BY 1")


TABLES.update({"rejected_rows": _rejected(), "export_manifest": _exports(), "quarantine_report": _quarantine()})


# -- refresh, upkeep and stored sketches ---------------------------------------------

def _value_quantiles() -> str:
    columns = ["total_order_value", "items_total_freight", "actual_delivery_days"]
    points = ", ".join(f"CAST(QUANTILE_DISC(CAST({{c}} AS DOUBLE), {p}) AS DOUBLE) AS p{round(100 * p)}" for p in (0.25, 0.5, 0.75, 0.99))
    return "\nUNION ALL ".join(
        f"SELECT CAST(order_year AS BIGINT) AS order_year, '{c}' AS column_name, COUNT({c}) AS n, {points.format(c=c)} FROM featured "
        f"WHERE {c} IS NOT NULL GROUP BY order_year" for c in columns)


TABLES.update({
    "refresh_years": "SELECT CAST(order_year AS BIGINT) AS order_year, COUNT(*) AS orders, CAST(SUM(total_order_value) AS DOUBLE) AS revenue "
                     "FROM featured GROUP BY order_year",
    "rfm_upkeep_orders": select_table("rfm_base", RFM_COLS[:4]),
    "rfm_upkeep_retail": select_table("rfm_retail", RFM_RETAIL_COLS),
    "customers_by_state_sketch": "SELECT CAST(order_year AS BIGINT) AS order_year, customer_state, COUNT(*) AS orders, "
                                 "COUNT(DISTINCT customer_unique_id) AS customers FROM featured GROUP BY order_year, customer_state",
    "customers_retained_sketch": """
SELECT CAST(a.order_year AS BIGINT) AS order_year, COUNT(*) AS customers, COUNT(b.customer_unique_id) AS retained,
       COUNT(*) - COUNT(b.customer_unique_id) AS lost
FROM (SELECT DISTINCT order_year, customer_unique_id FROM featured WHERE customer_unique_id IS NOT NULL) a
LEFT JOIN (SELECT DISTINCT order_year, customer_unique_id FROM featured) b
  ON b.customer_unique_id = a.customer_unique_id AND b.order_year = a.order_year + 1
GROUP BY a.order_year""",
    "value_quantiles_sketch": _value_quantiles(),
})
