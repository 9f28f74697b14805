"""SQL text of the cleaned and aggregated tables for the check engine (DuckDB).

Written independently of the DataFrame builders; ``with_views`` puts the views a statement names, and the
views those name, in front of it.
"""

from __future__ import annotations

import re

from tidemark.catalog.raw_views import RAW_SQL, duckdb_text

AS_OF = "2001-08-01"
LOG_AS_OF = "2024-01-31"


def pct(part: str, whole: str) -> str:
    ratio = f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100.0"
    return f"CAST(round(CAST({ratio} AS DECIMAL(34,12)), 2) AS DECIMAL(18,2))"


def mean(column: str, over: str = "") -> str:
    return f"CAST(sum({column}) {over} AS DOUBLE) / NULLIF(count({column}) {over}, 0)"


def latest(view: str, key: str, order: str) -> str:
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS pos FROM {view}) "
        "WHERE pos = 1)"
    )


def _r(column: str) -> str:
    """Recency bands."""
    return f"CASE WHEN {column} <= 30 THEN 5 WHEN {column} <= 90 THEN 4 WHEN {column} <= 180 THEN 3 WHEN {column} <= 365 THEN 2 ELSE 1 END"


def _f(column: str) -> str:
    return f"CASE WHEN {column} >= 20 THEN 5 WHEN {column} >= 10 THEN 4 WHEN {column} >= 5 THEN 3 WHEN {column} >= 2 THEN 2 ELSE 1 END"


def _m(column: str) -> str:
    return f"CASE WHEN {column} >= 5000 THEN 5 WHEN {column} >= 2000 THEN 4 WHEN {column} >= 500 THEN 3 WHEN {column} >= 100 THEN 2 ELSE 1 END"


def _tier(r: str, f: str, m: str) -> str:
    return (
        f"CASE WHEN {r} >= 4 AND {f} >= 4 AND {m} >= 4 THEN 'champion' WHEN {r} >= 3 AND {f} >= 3 THEN 'loyal' "
        f"WHEN {r} >= 4 THEN 'new_active' WHEN {r} <= 2 THEN 'at_risk' ELSE 'regular' END"
    )


_PRICE_TIER = "CASE WHEN price < 25 THEN 'budget' WHEN price < 100 THEN 'mid-range' WHEN price < 500 THEN 'premium' ELSE 'luxury' END"
_EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
_CUSTOMERS = latest(
    "raw_customers", "customer_id",
    "_ingestion_timestamp DESC NULLS LAST, created_at, email, phone, segment, region, city, country, first_name, last_name",
)
_PRODUCTS = latest("raw_products", "product_id", "price, cost, category, subcategory, brand, product_name, weight_kg")
_ORDERS = latest("raw_orders", "order_id", "order_date, status, total_amount, customer_id, shipping_cost, payment_method")
_ITEMS = latest(
    "raw_order_items", "item_id",
    "_ingestion_timestamp DESC NULLS LAST, order_id, product_id, quantity, unit_price, discount NULLS LAST",
)
_STATUS = (
    "CASE WHEN status IN ('completed','delivered','shipped','pending','processing') THEN status "
    "WHEN status IN ('cancelled','canceled','refunded') THEN 'cancelled' ELSE 'unknown' END"
)
_WEEKEND = "dayofweek(order_date) IN (0, 6)"
_W7 = "OVER (ORDER BY sale_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_W30 = "OVER (ORDER BY sale_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
_YTD = "OVER (PARTITION BY order_year ORDER BY sale_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

VIEWS: dict[str, str] = {name: duckdb_text(name) for name in RAW_SQL}

VIEWS |= {
    "newest_orders": f"SELECT * FROM {_ORDERS} o",
    "silver_customers": f"""
SELECT customer_id, first_name, last_name, email, phone,
  CASE WHEN lower(trim(segment)) IN ('premium','gold','vip') THEN 'premium'
       WHEN lower(trim(segment)) IN ('standard','regular','normal') THEN 'standard'
       ELSE coalesce(lower(trim(segment)), 'unknown') END AS segment,
  coalesce(lower(trim(region)), 'unknown') AS region, coalesce(lower(trim(city)), 'unknown') AS city,
  coalesce(lower(trim(country)), 'unknown') AS country, created_at, _ingestion_timestamp,
  regexp_matches(email, '{_EMAIL}') AS email_valid, concat_ws(' ', first_name, last_name) AS full_name,
  1 AS _silver_version FROM {_CUSTOMERS} c""",
    "silver_products": f"""
SELECT product_id, product_name, lower(trim(category)) AS category, lower(trim(subcategory)) AS subcategory,
  lower(trim(brand)) AS brand, CAST(price AS DECIMAL(18,6)) AS price, CAST(cost AS DECIMAL(18,6)) AS cost, weight_kg, {pct("price - cost", "price")} AS profit_margin,
  {_PRICE_TIER} AS price_tier, 1 AS _silver_version
FROM {_PRODUCTS} p WHERE price > 0 AND cost > 0""",
    "silver_orders": f"""
SELECT order_id, customer_id, order_date, {_STATUS} AS status, total_amount, shipping_cost, payment_method,
  CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
  CAST(day(order_date) AS INTEGER) AS order_day, CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_dayofweek,
  CAST(hour(order_date) AS INTEGER) AS order_hour, {_WEEKEND} AS is_weekend,
  CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
  CAST(total_amount - coalesce(shipping_cost, 0) AS DECIMAL(19,2)) AS net_amount, 1 AS _silver_version
FROM {_ORDERS} o WHERE total_amount >= 0""",
    "silver_order_items": f"""
SELECT item_id, order_id, product_id, quantity, CAST(unit_price AS DECIMAL(18,6)) AS unit_price, CAST(coalesce(discount, 0) AS DECIMAL(9,6)) AS discount,
  _ingestion_timestamp,
  CAST(round(quantity * CAST(unit_price AS DECIMAL(18,6)) * (1 - CAST(coalesce(discount, 0) AS DECIMAL(9,6))), 2) AS DECIMAL(22,2)) AS line_total,
  1 AS _silver_version
FROM {_ITEMS} i WHERE quantity > 0 AND unit_price > 0""",
    "silver_clickstream": f"""
SELECT event_id, session_id, customer_id, lower(trim(event_type)) AS event_type, lower(trim(device_type)) AS device_type,
  timestamp, CAST(timestamp AS DATE) AS event_date, CAST(hour(timestamp) AS INTEGER) AS event_hour,
  lower(trim(event_type)) IN ('purchase','checkout','add_to_cart') AS is_conversion, 1 AS _silver_version
FROM {latest("raw_clickstream", "event_id", "timestamp, session_id, customer_id, event_type, device_type")} e
WHERE event_type IS NOT NULL""",
    "silver_reviews": f"""
SELECT review_id, product_id, customer_id, rating, review_text, helpful_votes,
  CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral' ELSE 'negative' END AS sentiment,
  CAST(length(review_text) AS INTEGER) AS review_length, 1 AS _silver_version
FROM {latest("raw_reviews", "review_id", "rating, helpful_votes, product_id, customer_id")} r WHERE rating BETWEEN 1 AND 5""",
    "reduced_customers": f"""
SELECT customer_id, first_name, last_name, email, phone, lower(trim(segment)) AS segment,
  coalesce(lower(trim(region)), 'unknown') AS region, city, country, created_at, _ingestion_timestamp,
  regexp_matches(email, '{_EMAIL}') AS email_valid, concat_ws(' ', first_name, last_name) AS full_name,
  1 AS _silver_version FROM {_CUSTOMERS} c""",
    "reduced_products": f"""
SELECT product_id, product_name, category, subcategory, brand, CAST(price AS DECIMAL(18,6)) AS price, CAST(cost AS DECIMAL(18,6)) AS cost, weight_kg,
  {pct("price - cost", "price")} AS profit_margin, {_PRICE_TIER} AS price_tier, 1 AS _silver_version
FROM {_PRODUCTS} p WHERE price > 0 AND cost > 0""",
    "reduced_orders": f"""
SELECT order_id, customer_id, order_date, status, total_amount, shipping_cost, payment_method,
  CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
  {_WEEKEND} AS is_weekend, CAST(total_amount - coalesce(shipping_cost, 0) AS DECIMAL(19,2)) AS net_amount,
  1 AS _silver_version FROM {_ORDERS} o WHERE total_amount >= 0""",
    "reduced_order_items": f"""
SELECT item_id, order_id, product_id, quantity, CAST(unit_price AS DECIMAL(18,6)) AS unit_price, CAST(coalesce(discount, 0) AS DECIMAL(9,6)) AS discount,
  _ingestion_timestamp,
  CAST(round(quantity * CAST(unit_price AS DECIMAL(18,6)) * (1 - CAST(coalesce(discount, 0) AS DECIMAL(9,6))), 2) AS DECIMAL(22,2)) AS line_total,
  1 AS _silver_version FROM {_ITEMS} i WHERE quantity > 0""",
    "stg_customers": """
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
  trim(first_name) || ' ' || trim(last_name) AS full_name, lower(trim(email)) AS email, phone,
  CASE WHEN lower(trim(segment)) IN ('premium','gold','vip') THEN 'premium'
       WHEN lower(trim(segment)) IN ('standard','regular') THEN 'standard'
       ELSE coalesce(lower(trim(segment)), 'unknown') END AS segment,
  coalesce(lower(trim(region)), 'unknown') AS region, coalesce(trim(city), 'unknown') AS city,
  coalesce(trim(country), 'unknown') AS country, created_at FROM raw_customers""",
    "stg_products": f"""
SELECT product_id, trim(product_name) AS product_name, lower(trim(category)) AS category,
  lower(trim(subcategory)) AS subcategory, lower(trim(brand)) AS brand, CAST(price AS DECIMAL(18,6)) AS price, CAST(cost AS DECIMAL(18,6)) AS cost,
  {pct("price - cost", "price")} AS profit_margin, {_PRICE_TIER} AS price_tier, weight_kg
FROM raw_products WHERE price > 0 AND cost > 0""",
    "stg_orders": f"""
SELECT order_id, customer_id, order_date, {_STATUS} AS status, total_amount,
  CAST(coalesce(shipping_cost, 0) AS DECIMAL(18,2)) AS shipping_cost,
  CAST(total_amount - coalesce(shipping_cost, 0) AS DECIMAL(18,2)) AS net_amount, payment_method,
  CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
  {_WEEKEND} AS is_weekend FROM raw_orders WHERE total_amount >= 0""",
    "stg_order_items": """
SELECT item_id, order_id, product_id, quantity, CAST(unit_price AS DECIMAL(18,6)) AS unit_price, CAST(coalesce(discount, 0) AS DECIMAL(9,6)) AS discount,
  CAST(round(quantity * CAST(unit_price AS DECIMAL(18,6)) * (1 - CAST(coalesce(discount, 0) AS DECIMAL(9,6))), 2) AS DECIMAL(22,2)) AS line_total
FROM raw_order_items WHERE quantity > 0 AND unit_price > 0""",
    "day_sales": f"""
SELECT CAST(order_date AS DATE) AS sale_date, order_year, order_month, order_day, is_weekend,
  count(order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(total_amount) AS DECIMAL(22,2)) AS gross_revenue, CAST(sum(net_amount) AS DECIMAL(23,2)) AS net_revenue,
  CAST(sum(shipping_cost) AS DECIMAL(22,2)) AS total_shipping, {mean("total_amount")} AS avg_order_value,
  min(total_amount) AS min_order_value, max(total_amount) AS max_order_value
FROM silver_orders WHERE status <> 'cancelled' GROUP BY 1, 2, 3, 4, 5""",
    "gold_daily_sales": f"""
SELECT *, CAST(sum(gross_revenue) {_YTD} AS DECIMAL(32,2)) AS ytd_revenue,
  CAST(sum(total_orders) {_YTD} AS BIGINT) AS ytd_orders,
  {mean("gross_revenue", _W7)} AS moving_avg_7d_revenue, {mean("gross_revenue", _W30)} AS moving_avg_30d_revenue,
  {mean("total_orders", _W7)} AS moving_avg_7d_orders FROM day_sales""",
    "order_metrics": f"""
SELECT customer_id, count(order_id) AS total_orders, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_spend,
  {mean("total_amount")} AS avg_order_value, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
  CAST(date_diff('day', CAST(max(order_date) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order
FROM silver_orders WHERE status <> 'cancelled' GROUP BY customer_id""",
    "review_metrics": f"""
SELECT customer_id, count(review_id) AS total_reviews, {mean("rating")} AS avg_rating_given
FROM silver_reviews GROUP BY customer_id""",
    "category_counts": """
SELECT o.customer_id, p.category, count(*) AS category_count FROM silver_order_items i
JOIN silver_products p ON i.product_id = p.product_id JOIN silver_orders o ON i.order_id = o.order_id GROUP BY 1, 2""",
    "favourite_category": """
SELECT customer_id, category AS favorite_category FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY category_count DESC, category NULLS LAST) AS pos FROM category_counts) WHERE pos = 1""",
    "customer_scores": f"""
SELECT c.*, coalesce(om.total_orders, 0) AS total_orders, CAST(coalesce(om.total_spend, 0) AS DECIMAL(22,2)) AS total_spend,
  om.avg_order_value, om.first_order_date, om.last_order_date, om.days_since_last_order,
  coalesce(rm.total_reviews, 0) AS total_reviews, rm.avg_rating_given, fc.favorite_category,
  CAST(round(om.total_spend * CAST(1.2 AS DECIMAL(2,1)), 2) AS DECIMAL(22,2)) AS lifetime_value_estimate,
  {_r("om.days_since_last_order")} AS rfm_recency_score, {_f("coalesce(om.total_orders, 0)")} AS rfm_frequency_score,
  {_m("coalesce(om.total_spend, 0)")} AS rfm_monetary_score
FROM silver_customers c LEFT JOIN order_metrics om ON c.customer_id = om.customer_id
LEFT JOIN review_metrics rm ON c.customer_id = rm.customer_id LEFT JOIN favourite_category fc ON c.customer_id = fc.customer_id""",
    "gold_customer_360": f"""
SELECT *, {_tier("rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score")} AS customer_tier FROM customer_scores""",
    "gold_customer_tier_simple": f"""
SELECT *, CASE WHEN rfm_recency >= 4 AND rfm_frequency >= 4 THEN 'champion' WHEN rfm_recency >= 3 THEN 'loyal'
  WHEN rfm_recency <= 2 THEN 'at_risk' ELSE 'regular' END AS customer_tier
FROM (SELECT c.*, coalesce(om.total_orders, 0) AS total_orders, CAST(coalesce(om.total_spend, 0) AS DECIMAL(22,2)) AS total_spend,
  om.avg_order_value, om.last_order_date, om.days_since_last_order, coalesce(rm.total_reviews, 0) AS total_reviews,
  rm.avg_rating_given AS avg_rating, {_r("om.days_since_last_order")} AS rfm_recency,
  {_f("coalesce(om.total_orders, 0)")} AS rfm_frequency
FROM silver_customers c LEFT JOIN order_metrics om ON c.customer_id = om.customer_id
LEFT JOIN review_metrics rm ON c.customer_id = rm.customer_id)""",
    "product_sales": """
SELECT product_id, CAST(sum(CASE WHEN status <> 'cancelled' THEN line_total ELSE 0 END) AS DECIMAL(38,2)) AS total_revenue,
  CAST(sum(CASE WHEN status <> 'cancelled' THEN quantity ELSE 0 END) AS BIGINT) AS units_sold,
  count(DISTINCT CASE WHEN status <> 'cancelled' THEN i.order_id END) AS order_count,
  count(DISTINCT CASE WHEN status = 'cancelled' THEN i.order_id END) AS cancelled_orders
FROM silver_order_items i JOIN silver_orders o ON i.order_id = o.order_id GROUP BY product_id""",
    "product_reviews": f"""
SELECT product_id, {mean("rating")} AS avg_rating, count(review_id) AS review_count,
  count(CASE WHEN sentiment = 'positive' THEN 1 END) AS positive_reviews,
  count(CASE WHEN sentiment = 'negative' THEN 1 END) AS negative_reviews
FROM silver_reviews GROUP BY product_id""",
    "gold_product_performance": f"""
SELECT *, CAST(rank() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS INTEGER) AS category_revenue_rank FROM (
SELECT p.*, CAST(coalesce(s.total_revenue, 0) AS DECIMAL(38,2)) AS total_revenue, coalesce(s.units_sold, 0) AS units_sold,
  coalesce(s.order_count, 0) AS order_count, s.cancelled_orders, r.avg_rating, coalesce(r.review_count, 0) AS review_count,
  r.positive_reviews, r.negative_reviews, CASE WHEN s.order_count + s.cancelled_orders > 0
    THEN {pct("s.cancelled_orders", "(s.order_count + s.cancelled_orders)")} ELSE 0 END AS cancellation_rate
FROM silver_products p LEFT JOIN product_sales s ON p.product_id = s.product_id
LEFT JOIN product_reviews r ON p.product_id = r.product_id)""",
    "gold_product_performance_all": """
SELECT *, CAST(rank() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS INTEGER) AS category_rank FROM (
SELECT p.*, CAST(coalesce(s.total_revenue, 0) AS DECIMAL(38,2)) AS total_revenue,
  CAST(coalesce(s.units_sold, 0) AS BIGINT) AS units_sold, s.order_count, r.avg_rating,
  coalesce(r.review_count, 0) AS review_count
FROM silver_products p LEFT JOIN (SELECT product_id, sum(line_total) AS total_revenue, sum(quantity) AS units_sold,
  count(DISTINCT order_id) AS order_count FROM silver_order_items GROUP BY product_id) s ON p.product_id = s.product_id
LEFT JOIN product_reviews r ON p.product_id = r.product_id)""",
    "gold_hourly_traffic": f"""
SELECT *, CASE WHEN unique_sessions > 0 THEN {pct("conversions", "unique_sessions")} ELSE 0 END AS conversion_rate FROM (
SELECT event_date, event_hour, device_type, count(event_id) AS total_events, count(DISTINCT session_id) AS unique_sessions,
  count(DISTINCT customer_id) AS unique_users, count(CASE WHEN event_type = 'page_view' THEN 1 END) AS page_views,
  count(CASE WHEN event_type = 'add_to_cart' THEN 1 END) AS add_to_carts,
  count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases, count(CASE WHEN is_conversion THEN 1 END) AS conversions
FROM silver_clickstream GROUP BY 1, 2, 3)""",
    "mart_days": f"""
SELECT CAST(order_date AS DATE) AS sale_date, order_year, order_month, is_weekend,
  count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(total_amount) AS DECIMAL(22,2)) AS gross_revenue, CAST(sum(net_amount) AS DECIMAL(22,2)) AS net_revenue,
  CAST(sum(shipping_cost) AS DECIMAL(22,2)) AS total_shipping, {mean("total_amount")} AS avg_order_value
FROM stg_orders WHERE status <> 'cancelled' GROUP BY 1, 2, 3, 4""",
    "mart_daily_sales": f"""
SELECT *, CAST(sum(gross_revenue) {_YTD} AS DECIMAL(32,2)) AS ytd_revenue,
  {mean("gross_revenue", _W7)} AS moving_avg_7d_revenue, {mean("gross_revenue", _W30)} AS moving_avg_30d_revenue,
  CAST(gross_revenue - lag(gross_revenue) OVER (ORDER BY sale_date) AS DECIMAL(23,2)) AS dod_change,
  CAST(rank() OVER (PARTITION BY order_year, order_month ORDER BY gross_revenue DESC) AS INTEGER) AS month_revenue_rank
FROM mart_days""",
    "mart_orders_by_customer": f"""
SELECT customer_id, count(DISTINCT order_id) AS total_orders, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_spend,
  {mean("total_amount")} AS avg_order_value, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
  CAST(date_sub('day', max(order_date), TIMESTAMP '{AS_OF} 00:00:00') AS INTEGER) AS days
FROM stg_orders WHERE status <> 'cancelled' GROUP BY customer_id""",
    "mart_items_by_customer": """
SELECT o.customer_id, CAST(sum(i.quantity) AS BIGINT) AS total_items_purchased, count(DISTINCT i.product_id) AS unique_products
FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id WHERE o.status <> 'cancelled' GROUP BY 1""",
    "mart_customer_scores": f"""
SELECT c.customer_id, c.full_name, c.email, c.segment, c.region, c.city, c.country, c.created_at AS customer_since,
  coalesce(om.total_orders, 0) AS total_orders, CAST(coalesce(om.total_spend, 0) AS DECIMAL(22,2)) AS total_spend,
  coalesce(om.avg_order_value, 0) AS avg_order_value, om.first_order_date, om.last_order_date,
  coalesce(om.days, 9999) AS days_since_last_order, coalesce(im.total_items_purchased, 0) AS total_items_purchased,
  coalesce(im.unique_products, 0) AS unique_products, {_r("om.days")} AS rfm_recency,
  {_f("coalesce(om.total_orders, 0)")} AS rfm_frequency, {_m("coalesce(om.total_spend, 0)")} AS rfm_monetary
FROM stg_customers c LEFT JOIN mart_orders_by_customer om ON c.customer_id = om.customer_id
LEFT JOIN mart_items_by_customer im ON c.customer_id = im.customer_id""",
    "mart_customer_360": f"""
SELECT *, {_tier("rfm_recency", "rfm_frequency", "rfm_monetary")} AS customer_tier,
  CAST(round(CAST(avg_order_value * total_orders * CAST(1.2 AS DOUBLE) AS DECIMAL(34,12)), 2) AS DECIMAL(22,2)) AS estimated_ltv
FROM mart_customer_scores""",
    "mart_product_performance": f"""
SELECT *, CAST(rank() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS INTEGER) AS category_revenue_rank,
  CAST(rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS overall_revenue_rank FROM (
SELECT p.product_id, p.product_name, p.category, p.subcategory, p.brand, p.price AS list_price, p.cost, p.profit_margin,
  p.price_tier, CAST(coalesce(s.total_revenue, 0) AS DECIMAL(38,2)) AS total_revenue,
  CAST(coalesce(s.units_sold, 0) AS BIGINT) AS units_sold, coalesce(s.order_count, 0) AS order_count,
  coalesce(s.avg_selling_price, CAST(p.price AS DOUBLE)) AS avg_selling_price
FROM stg_products p LEFT JOIN (SELECT i.product_id, sum(i.line_total) AS total_revenue, sum(i.quantity) AS units_sold,
  count(DISTINCT i.order_id) AS order_count, {mean("i.unit_price")} AS avg_selling_price
  FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id WHERE o.status <> 'cancelled' GROUP BY 1) s
ON p.product_id = s.product_id)""",
    "date_spine": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
  CAST(week(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
  strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)""",
    "dim_date": """
SELECT *, false AS is_holiday, CAST(year(full_date + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_year,
  CAST(quarter(full_date + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_quarter FROM date_spine""",
    "dim_customer": """
SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, first_name, last_name, full_name, email, phone,
  segment, region, city, country, customer_tier, created_at, true AS is_active FROM gold_customer_360
UNION ALL SELECT -1, NULL, NULL, NULL, 'unknown', NULL, NULL, 'unknown', 'unknown', 'unknown', 'unknown', 'unknown', NULL, false""",
    "dim_product": """
SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, category, subcategory, brand, price,
  cost, profit_margin, price_tier, CAST(weight_kg AS DECIMAL(8,2)) AS weight_kg, true AS is_active FROM silver_products
UNION ALL SELECT -1, NULL, 'unknown', 'unknown', 'unknown', 'unknown', NULL, NULL, NULL, 'unknown', NULL, false""",
    "keyed_customers": "SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM silver_customers",
    "fact_orders": """
SELECT row_number() OVER (ORDER BY o.order_id) AS order_key, o.order_id, coalesce(c.customer_key, -1) AS customer_key,
  o.order_date_key, o.status, o.total_amount, o.shipping_cost, o.net_amount, o.payment_method, o.order_year, o.order_month,
  o.is_weekend FROM silver_orders o LEFT JOIN keyed_customers c ON o.customer_id = c.customer_id
UNION ALL SELECT -1, NULL, -1, NULL, 'unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
    "fact_order_items": """
SELECT row_number() OVER (ORDER BY i.item_id) AS item_key, i.item_id, coalesce(o.order_key, -1) AS order_key,
  coalesce(p.product_key, -1) AS product_key, i.quantity, i.unit_price, i.discount, i.line_total
FROM silver_order_items i LEFT JOIN fact_orders o ON i.order_id = o.order_id
LEFT JOIN dim_product p ON i.product_id = p.product_id""",
}

_WORD = re.compile(r"[a-z_0-9]+")


def with_views(statement: str, replaced: dict[str, str] | None = None) -> str:
    """Put every view the statement needs in front of it, in order of definition; some views may be replaced.

    A view sees only views defined before it, so a name shared with a given table means the given table.
    """
    views = VIEWS | (replaced or {})
    names = list(views)
    needed: set[str] = set()
    pending = [(statement, len(names))]
    while pending:
        text, limit = pending.pop()
        for word in set(_WORD.findall(text)) & set(names[:limit]):
            if word not in needed:
                needed.add(word)
                pending.append((views[word], names.index(word)))
    chosen = [n for n in names if n in needed]
    if not chosen:
        return statement.strip()
    clauses = ",\n".join(f"{n} AS ({views[n].strip()})" for n in chosen)
    return f"WITH {clauses}\n{statement.strip()}"
