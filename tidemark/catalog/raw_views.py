"""Raw e-commerce tables derived from the given test tables.

The given tables are clean, so each view plants defects by rule: repeated keys, bad addresses, blanks and
mixed case, negative amounts, unknown statuses, missing values.  The text runs unchanged on Spark and on
DuckDB; braces mark the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SQL: dict[str, str] = {
    "raw_customers": """
SELECT 'C' || lpad(CAST(c_custkey AS STRING), 6, '0') AS customer_id, 'Customer' AS first_name, c_name AS last_name,
  CASE WHEN c_custkey % 10 = 3 THEN 'invalid-email' ELSE 'user' || CAST(c_custkey AS STRING) || '@example.com' END AS email,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '+' || CAST(c_custkey AS STRING) END AS phone,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '  PREMIUM ' WHEN 'BUILDING' THEN 'Gold' WHEN 'MACHINERY' THEN 'regular'
    WHEN 'FURNITURE' THEN 'budget' END AS segment,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE r_name END AS region, n_name AS city,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'US' END AS country,
  CAST(date '1994-01-01' + CAST(c_custkey % 365 AS INT) AS TIMESTAMP) AS created_at,
  CAST(date '2001-08-01' + v AS TIMESTAMP) AS _ingestion_timestamp
FROM (SELECT *, 0 AS v FROM {customer} UNION ALL SELECT *, 1 AS v FROM {customer} WHERE c_custkey % 20 = 0) c
JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "raw_products": """
SELECT product_id, product_name, category, subcategory, brand, price,
  CAST(round(price * CAST(0.30 + 0.01 * (p_partkey % 40) AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS cost, weight_kg
FROM (SELECT p_partkey, 'P' || lpad(CAST(p_partkey AS STRING), 6, '0') AS product_id, p_name AS product_name,
  ' ' || p_type || ' ' AS category, 'size-' || CAST(p_size % 5 AS STRING) AS subcategory, p_brand AS brand,
  CASE WHEN p_partkey % 50 = 0 THEN CAST(-5 AS DECIMAL(12,2)) ELSE
    CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(p_size AS DECIMAL(4,0)) * CAST(0.02 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) END AS price,
  CAST(p_size AS DOUBLE) AS weight_kg FROM {part}) p""",
    "raw_orders": """
SELECT 'O' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS order_id, 'C' || lpad(CAST(o_custkey AS STRING), 6, '0') AS customer_id,
  CAST(o_orderdate AS TIMESTAMP) AS order_date,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'canceled' WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'lost'
       WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'processing' END AS status,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)) - 5 AS DECIMAL(12,2)) AS total_amount,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CAST(o_orderkey % 25 AS INT) AS DECIMAL(12,2)) END AS shipping_cost,
  CASE WHEN o_orderkey % 2 = 0 THEN 'credit_card' ELSE 'paypal' END AS payment_method
FROM {orders}""",
    "raw_order_items": """
SELECT 'I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS item_id,
  'O' || lpad(CAST(l_orderkey AS STRING), 8, '0') AS order_id, 'P' || lpad(CAST(l_partkey AS STRING), 6, '0') AS product_id,
  CAST(l_quantity AS INT) AS quantity, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS unit_price,
  CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_discount AS DECIMAL(5,4)) END AS discount,
  CAST(l_shipdate AS TIMESTAMP) AS _ingestion_timestamp
FROM {lineitem}""",
    "raw_clickstream": """
SELECT CAST(event_id AS STRING) AS event_id, CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS session_id,
  CASE WHEN event_id % 10 < 3 THEN NULL ELSE 'C' || lpad(CAST(user_id AS STRING), 6, '0') END AS customer_id,
  CASE event_type WHEN 'view' THEN ' Page_View' WHEN 'click' THEN 'product_view' WHEN 'signup' THEN 'add_to_cart' WHEN 'purchase' THEN 'purchase' END AS event_type,
  CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'desktop' WHEN 1 THEN 'Mobile' ELSE 'tablet' END AS device_type,
  CAST(ts AS TIMESTAMP) AS timestamp
FROM {events}""",
    "raw_reviews": """
SELECT 'R' || CAST(doc_id AS STRING) AS review_id, 'P' || lpad(CAST(doc_id % 200 AS STRING), 6, '0') AS product_id,
  'C' || lpad(CAST(doc_id % 150 AS STRING), 6, '0') AS customer_id, CAST(doc_id % 7 AS INT) AS rating,
  text AS review_text, doc_id % 51 AS helpful_votes
FROM {documents}""",
    "raw_run_log": """
SELECT 'run-' || CAST(CAST(ts AS DATE) AS STRING) AS run_id, 'daily_etl' AS pipeline_name,
  CASE CAST(event_id % 4 AS INT) WHEN 0 THEN 'bronze_ingestion' WHEN 1 THEN 'silver_transformation' WHEN 2 THEN 'gold_aggregation' ELSE 'data_quality' END AS step,
  CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'customers' WHEN 1 THEN 'products' WHEN 2 THEN 'orders' WHEN 3 THEN 'order_items' WHEN 4 THEN 'clickstream' ELSE 'reviews' END AS table_name,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, event_id % 1000 AS rows_processed,
  CAST(event_id % 3600 AS INT) AS execution_time, CASE WHEN event_type = 'error' THEN props END AS error_message, CAST(ts AS TIMESTAMP) AS created_at
FROM {events}""",
}

GIVEN_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events", "documents")


class RawTables:
    """Raw views over one data folder, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        text = RAW_SQL[f"raw_{name}"]
        used = {t: self.given(t) for t in GIVEN_TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def duckdb_text(name: str) -> str:
    """The view for DuckDB, where the given tables are known by name."""
    text = RAW_SQL[name]
    for table in GIVEN_TABLES:
        text = text.replace("{" + table + "}", table)
    return text
