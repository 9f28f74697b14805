"""Whole-table queries: silver, staging, gold, marts, star schema, serving, profiles, run metrics."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.sql_views import AS_OF, LOG_AS_OF, latest, pct
from tidemark.catalog.tables import Tables
from tidemark.operators import profile
from tidemark.operators.ranking import dense_numbers
from tidemark.plans import gold, marts, metrics, serving, silver, staging, star
from tidemark.plans.validity import faults
from tidemark.schemas import SOURCES
from tidemark.sources.files import REASON

for _name in SOURCES:
    query(f"silver_{_name}", f"SELECT * FROM silver_{_name}")(lambda t, n=_name: t.silver(n))

for _name in ("customers", "products", "orders", "order_items"):
    query(f"silver_{_name}_reduced", f"SELECT * FROM reduced_{_name}")(lambda t, n=_name: t.reduced(n))
    query(f"stg_{_name}", f"SELECT * FROM stg_{_name}")(lambda t, n=_name: t.staging(n))


# Amounts as the source contract has them (DOUBLE), with values planted that no narrow type holds.

_N = "CAST(substr(order_id, 2) AS BIGINT)"
_PLANTED = {
    "orders": {
        "total_amount": f"CASE WHEN {_N} % 11 = 1 THEN 2e10 + {_N} WHEN {_N} % 11 = 2 THEN 1e20 WHEN {_N} % 11 = 3 THEN -0.004 ELSE CAST(total_amount AS DOUBLE) END",
        "shipping_cost": f"CASE WHEN {_N} % 13 = 1 THEN 3e18 ELSE CAST(shipping_cost AS DOUBLE) END",
    },
    "order_items": {
        "unit_price": f"CASE WHEN {_N} % 11 = 1 THEN 4e-3 WHEN {_N} % 11 = 2 THEN 1e15 ELSE CAST(unit_price AS DOUBLE) END",
        "discount": f"CASE WHEN {_N} % 13 = 1 THEN 15e0 WHEN {_N} % 13 = 2 THEN 2e5 ELSE CAST(discount AS DOUBLE) END",
    },
}


def _planted_sql(name: str) -> str:
    changed = ", ".join(f"{value} AS {column}" for column, value in _PLANTED[name].items())
    return f"(SELECT * REPLACE ({changed}) FROM raw_{name})"


def _limits_sql(orders: str, items: str) -> str:
    return f"""SELECT order_id AS key, CASE WHEN fault IS NULL THEN CAST(CAST(total_amount AS DECIMAL(18,2)) - CASE WHEN shipping_cost IS NULL THEN 0 ELSE
  CAST(shipping_cost AS DECIMAL(18,2)) END AS DECIMAL(24,2)) END AS amount, fault FROM (SELECT *, CASE WHEN total_amount IS NULL OR total_amount < 0
  THEN 'total_amount is missing or negative' WHEN total_amount >= 1e16 THEN 'total_amount does not fit' WHEN shipping_cost >= 1e16
  THEN 'shipping_cost does not fit' END AS fault FROM {orders} o) o
UNION ALL SELECT item_id, CASE WHEN fault IS NULL THEN CAST(round(quantity * CAST(unit_price AS DECIMAL(18,6)) * (1 - CASE WHEN discount IS NULL
  THEN 0 ELSE CAST(discount AS DECIMAL(9,6)) END), 2) AS DECIMAL(24,2)) END, fault FROM (SELECT *, CASE WHEN quantity IS NULL OR quantity <= 0
  THEN 'quantity is not positive' WHEN unit_price IS NULL OR unit_price <= 0 THEN 'unit_price is not positive' WHEN unit_price >= 1e12
  THEN 'unit_price does not fit' WHEN discount >= 1e3 THEN 'discount does not fit' END AS fault FROM {items} i) i"""


def _planted(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Raw orders and items with the planted amounts, otherwise as they are."""
    return tuple(t.raw(n).withColumns({c: F.expr(v) for c, v in _PLANTED[n].items()}) for n in ("orders", "order_items"))


def _judged(kept: list[tuple[DataFrame, str, str]], rejected: list[tuple[DataFrame, str]]) -> DataFrame:
    parts = [df.select(F.col(k).alias("key"), F.col(v).cast("decimal(24,2)").alias("amount"), F.lit(None).cast("string").alias("fault")) for df, k, v in kept]
    parts += [df.select(F.col(k).alias("key"), F.lit(None).cast("decimal(24,2)").alias("amount"), F.col(REASON).alias("fault")) for df, k in rejected]
    return reduce(DataFrame.unionByName, parts)


@query(
    "silver_amount_limits",
    _limits_sql(
        latest(_planted_sql("orders"), "order_id", "order_date, status, total_amount, customer_id, shipping_cost, payment_method"),
        latest(
            _planted_sql("order_items"), "item_id",
            "_ingestion_timestamp DESC NULLS LAST, order_id, product_id, quantity, unit_price, discount NULLS LAST",
        ),
    ),
)
def silver_amount_limits(t: Tables) -> DataFrame:
    """Every order and item is in silver with its exact amount, or rejected with a reason."""
    orders, items = _planted(t)
    return _judged(
        [(silver.orders(orders), "order_id", "net_amount"), (silver.order_items(items), "item_id", "line_total")],
        [(silver.rejected(orders, "orders"), "order_id"), (silver.rejected(items, "order_items"), "item_id")],
    )


@query("stg_amount_limits", _limits_sql(_planted_sql("orders"), _planted_sql("order_items")))
def stg_amount_limits(t: Tables) -> DataFrame:
    """The staged tables keep and leave out the same rows as silver."""
    orders, items = _planted(t)
    bad = [(df.withColumn(REASON, faults(n)).filter(F.col(REASON).isNotNull()), k) for df, n, k in ((orders, "orders", "order_id"), (items, "order_items", "item_id"))]
    return _judged([(staging.stg_orders(orders), "order_id", "net_amount"), (staging.stg_order_items(items), "item_id", "line_total")], bad)


# Gold


@query("gold_daily_sales", "SELECT * FROM gold_daily_sales")
def gold_daily_sales(t: Tables) -> DataFrame:
    return gold.daily_sales(t.silver("orders"))


@query(
    "gold_daily_sales_short",
    """SELECT sale_date, order_year, order_month, total_orders, unique_customers, gross_revenue, net_revenue, avg_order_value,
      ytd_revenue, moving_avg_7d_revenue AS moving_avg_7d FROM gold_daily_sales""",
)
def gold_daily_sales_short(t: Tables) -> DataFrame:
    return gold.daily_sales_short(t.silver("orders"))


def _customer_360(t: Tables) -> DataFrame:
    s = t.silver_set
    orders = t.stored("orders", "order_id", "customer_id", "order_date", "status", "total_amount")
    items = t.stored("order_items", "order_id", "product_id")
    return gold.customer_360(s["customers"], orders, items, s["products"], s["reviews"], AS_OF)


query("gold_customer_360", "SELECT * FROM gold_customer_360")(_customer_360)


@query("gold_customer_tier_simple", "SELECT * FROM gold_customer_tier_simple")
def gold_customer_tier_simple(t: Tables) -> DataFrame:
    return gold.customer_tier_simple(t.silver("customers"), t.silver("orders"), t.silver("reviews"), AS_OF)


@query("gold_product_performance", "SELECT * FROM gold_product_performance")
def gold_product_performance(t: Tables) -> DataFrame:
    s = t.silver_set
    items = t.stored("order_items", "order_id", "product_id", "quantity", "line_total")
    return gold.product_performance(s["products"], s["orders"], items, s["reviews"])


@query("gold_product_performance_all", "SELECT * FROM gold_product_performance_all")
def gold_product_performance_all(t: Tables) -> DataFrame:
    return gold.product_performance_all(t.silver("products"), t.silver("order_items"), t.silver("reviews"))


@query("gold_hourly_traffic", "SELECT * FROM gold_hourly_traffic")
def gold_hourly_traffic(t: Tables) -> DataFrame:
    used = ("event_id", "session_id", "customer_id", "event_type", "event_date", "event_hour", "device_type", "is_conversion")
    return gold.hourly_traffic(t.stored("clickstream", *used))


# Marts


def _mart_daily_sales(t: Tables) -> DataFrame:
    return marts.mart_daily_sales(t.staging("orders"))


def _mart_customer_360(t: Tables) -> DataFrame:
    return marts.mart_customer_360(t.staging("customers"), t.staging("orders"), t.staging("order_items"), AS_OF)


def _mart_product_performance(t: Tables) -> DataFrame:
    return marts.mart_product_performance(t.staging("products"), t.staging("orders"), t.staging("order_items"))


MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "mart_daily_sales": _mart_daily_sales,
    "mart_customer_360": _mart_customer_360,
    "mart_product_performance": _mart_product_performance,
}
for _name, _build in MARTS.items():
    query(_name, f"SELECT * FROM {_name}")(_build)


# Star schema


def _spine(t: Tables) -> DataFrame:
    return star.date_spine_of(t.raw("orders"), "order_date")


def _dim_customer(t: Tables) -> DataFrame:
    return star.dim_customer(t.silver("customers"), gold.customer_tiers(t.silver("customers"), t.silver("orders"), AS_OF))


def _dim_product(t: Tables) -> DataFrame:
    return star.dim_product(t.silver("products"))


def _keyed_customers(t: Tables) -> DataFrame:
    return dense_numbers(t.silver("customers").select("customer_id"), ["customer_id"], "customer_key")


def _fact_orders(t: Tables) -> DataFrame:
    # Customer keys depend on the customer table alone, so the tiers need not be built for the order fact.
    return star.fact_orders(t.silver("orders"), _keyed_customers(t))


query("date_spine", "SELECT * FROM date_spine")(_spine)
query("dim_date", "SELECT * FROM dim_date")(lambda t: star.dim_date(_spine(t), fiscal_start_month=7))
query("dim_customer", "SELECT * FROM dim_customer")(_dim_customer)
query("dim_product", "SELECT * FROM dim_product")(_dim_product)
query("fact_orders", "SELECT * FROM fact_orders")(_fact_orders)


@query("fact_order_items", "SELECT * FROM fact_order_items")
def fact_order_items(t: Tables) -> DataFrame:
    return star.fact_order_items(t.silver("order_items"), _fact_orders(t), _dim_product(t))


@query(
    "dim_customer_next",
    """SELECT customer_id, CASE WHEN customer_id IS NULL THEN -1 WHEN old THEN row_number() OVER (PARTITION BY old ORDER BY customer_id)
      ELSE row_number() OVER (PARTITION BY old ORDER BY customer_id) + count(*) FILTER (old) OVER () END AS customer_key
    FROM (SELECT customer_id, substr(customer_id, 7) <> '3' AS old FROM silver_customers UNION ALL SELECT NULL, NULL) c""",
)
def dim_customer_next(t: Tables) -> DataFrame:
    """A second load: customers whose number ends in 3 are new, all others keep the keys of the first."""
    customers = t.silver("customers")
    tiers = customers.select("customer_id", F.lit("regular").alias("customer_tier"))
    first = star.dim_customer(customers.filter(F.substring("customer_id", 7, 1) != "3"), tiers)
    return star.dim_customer(customers, tiers, previous=first).select("customer_id", "customer_key")


@query(
    "star_joins",
    """SELECT count(*) AS facts, count(*) FILTER (f.order_key < 0) AS without_order, count(*) FILTER (f.product_key < 0) AS without_product
    FROM fact_order_items f JOIN fact_orders o ON f.order_key = o.order_key JOIN dim_product p ON f.product_key = p.product_key""",
)
def star_joins(t: Tables) -> DataFrame:
    """Inner joins from the items to both sides keep every fact; the unknown members answer for the missing ones."""
    orders, products = _fact_orders(t), _dim_product(t)
    facts = star.fact_order_items(t.silver("order_items"), orders, products)
    joined = facts.join(orders.select("order_key"), "order_key").join(products.select("product_key"), "product_key")
    return joined.agg(
        F.count("*").alias("facts"),
        F.count_if(F.col("order_key") < 0).alias("without_order"),
        F.count_if(F.col("product_key") < 0).alias("without_product"),
    )


@query("dense_numbers_ranges", "SELECT row_number() OVER (ORDER BY item_id) AS item_key, item_id FROM silver_order_items")
def dense_numbers_ranges(t: Tables) -> DataFrame:
    """The range form of the surrogate key, whatever the size of the input."""
    return dense_numbers(t.silver("order_items").select("item_id"), ["item_id"], "item_key")


# Serving

_DAYS = (
    "SELECT sale_date, total_orders, unique_customers, gross_revenue, net_revenue, avg_order_value, ytd_revenue, "
    "moving_avg_7d_revenue FROM mart_daily_sales ORDER BY sale_date DESC LIMIT 30"
)
_CUSTOMERS = (
    "SELECT customer_id, full_name, segment, region, total_orders, total_spend, avg_order_value, customer_tier, rfm_recency, "
    "rfm_frequency, rfm_monetary FROM mart_customer_360 {where} ORDER BY total_spend DESC, customer_id, full_name, segment, region LIMIT 50"
)
_PRODUCTS = (
    "SELECT product_id, product_name, category, brand, total_revenue, units_sold, order_count, category_revenue_rank, "
    "overall_revenue_rank FROM mart_product_performance ORDER BY total_revenue DESC, product_id, product_name, category, brand LIMIT 50"
)

query("serve_daily_sales", _DAYS)(lambda t: serving.daily_sales(_mart_daily_sales(t)))
query("serve_customers", _CUSTOMERS.format(where="WHERE customer_tier = 'at_risk'"))(
    lambda t: serving.top_customers(_mart_customer_360(t), tier="at_risk")
)
query("serve_products", _PRODUCTS)(lambda t: serving.top_products(_mart_product_performance(t)))
query(
    "serve_run_status",
    """SELECT pipeline_name, table_name, rows_processed, status, execution_time, created_at FROM raw_run_log
    ORDER BY created_at DESC, pipeline_name, table_name, status, rows_processed, execution_time LIMIT 10""",
)(lambda t: serving.latest_runs(t.raw("run_log")))


# Profiles

_SIZES = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {n} AS column_count FROM raw_{t}"
    for t, n in (("customers", 11), ("products", 8), ("orders", 7), ("order_items", 7), ("clickstream", 6), ("reviews", 6))
)
query("profile_counts", _SIZES)(lambda t: profile.table_sizes({n: t.raw(n) for n in SOURCES}))


def _missing_sql() -> str:
    columns_of = {
        "customers": "customer_id first_name last_name email phone segment region city country created_at _ingestion_timestamp",
        "products": "product_id product_name category subcategory brand price cost weight_kg",
        "orders": "order_id customer_id order_date status total_amount shipping_cost payment_method",
        "order_items": "item_id order_id product_id quantity unit_price discount _ingestion_timestamp",
        "clickstream": "event_id session_id customer_id event_type device_type timestamp",
        "reviews": "review_id product_id customer_id rating review_text helpful_votes",
    }
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"{pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS null_percent FROM raw_{t}"
        for t, columns in columns_of.items()
        for c in columns.split()
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE null_count > 0"


query("profile_nulls", _missing_sql())(lambda t: profile.missing_values({n: t.raw(n) for n in SOURCES}))
_FIRST_PRODUCTS = ("product_id", "product_name", "category", "subcategory", "brand", "price", "cost")
query("profile_preview", f"SELECT {', '.join(_FIRST_PRODUCTS)} FROM raw_products ORDER BY product_id LIMIT 10")(
    lambda t: profile.preview(t.raw("products"), by=["product_id"]).select(*_FIRST_PRODUCTS)
)
query(
    "profile_segments",
    "SELECT segment, count(*) AS customer_count, count(DISTINCT region) AS regions FROM raw_customers GROUP BY 1",
)(lambda t: profile.segment_distribution(t.raw("customers")))
query(
    "profile_regions",
    """SELECT region, country, count(*) AS customer_count FROM raw_customers GROUP BY 1, 2
    ORDER BY customer_count DESC, region NULLS LAST, country NULLS LAST LIMIT 20""",
)(lambda t: profile.region_distribution(t.raw("customers")))
query(
    "profile_order_status",
    """SELECT status, count(*) AS order_count, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue,
      CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value FROM raw_orders GROUP BY 1""",
)(lambda t: profile.status_distribution(t.raw("orders")))
query(
    "profile_daily_orders",
    """SELECT CAST(order_date AS DATE) AS order_date, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(22,2)) AS revenue
    FROM raw_orders GROUP BY 1""",
)(lambda t: profile.daily_trend(t.raw("orders")))


def _describe_sql() -> str:
    parts = []
    for c in ("order_id", "customer_id", "status", "total_amount", "shipping_cost", "payment_method"):
        figures = "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev"
        if c in ("total_amount", "shipping_cost"):
            n, s = f"CAST(count({c}) AS DOUBLE)", f"CAST(sum({c}) AS DOUBLE)"
            figures = f"round({s} / {n}, 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS value_count, {figures}, CAST(min({c}) AS VARCHAR) AS min_value, "
            f"CAST(max({c}) AS VARCHAR) AS max_value FROM raw_orders"
        )
    return " UNION ALL ".join(parts)


query("describe_table", _describe_sql())(lambda t: profile.summary_figures(t.raw("orders")))


# Run metrics

query(
    "run_summary",
    """SELECT run_id, count(*) AS steps, count(*) FILTER (WHERE status = 'success') AS successful,
      count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(execution_time) AS BIGINT) AS total_seconds
    FROM raw_run_log GROUP BY 1""",
)(lambda t: metrics.run_summary(t.raw("run_log")))
query(
    "layer_row_counts",
    """SELECT layer, table_name, rows_processed AS row_count, created_at AS loaded_at FROM (
    SELECT *, row_number() OVER (PARTITION BY layer, table_name ORDER BY created_at DESC, rows_processed DESC) AS pos FROM (
    SELECT *, CASE step WHEN 'bronze_ingestion' THEN 'bronze' WHEN 'silver_transformation' THEN 'silver'
      WHEN 'gold_aggregation' THEN 'gold' END AS layer FROM raw_run_log WHERE status = 'success' AND step <> 'data_quality'))
    WHERE pos = 1""",
)(lambda t: metrics.layer_row_counts(t.raw("run_log")))
query(
    "quality_score",
    f"""SELECT *, {pct("checks_passed", "(checks_passed + checks_failed)")} AS score, checks_failed > 0 AS alert FROM (
    SELECT run_id, count(*) FILTER (WHERE status = 'success') AS checks_passed,
      count(*) FILTER (WHERE status <> 'success') AS checks_failed
    FROM raw_run_log WHERE step = 'data_quality' GROUP BY 1)""",
)(lambda t: metrics.quality_score(t.raw("run_log")))
query(
    "run_staleness",
    f"""SELECT pipeline_name, last_success, CAST(date_sub('hour', last_success, TIMESTAMP '{LOG_AS_OF} 00:00:00') AS INTEGER) AS hours_since_success,
      coalesce(last_success < TIMESTAMP '{LOG_AS_OF} 00:00:00' - INTERVAL 25 HOUR, true) AS is_stale FROM (
    SELECT pipeline_name, max(created_at) FILTER (WHERE status = 'success') AS last_success FROM raw_run_log GROUP BY 1)""",
)(lambda t: metrics.run_staleness(t.raw("run_log"), LOG_AS_OF))
query(
    "run_metrics",
    f"""SELECT l.pipeline_name, l.step, l.status AS current_status, l.execution_time AS last_duration, recent_runs, recent_failures,
      recent_rows, {pct("recent_failures", "recent_runs")} AS failure_rate
    FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name, step ORDER BY created_at DESC, run_id DESC, table_name DESC,
        rows_processed DESC, execution_time DESC, status DESC) AS pos FROM raw_run_log) l
    JOIN (SELECT pipeline_name, step, count(*) FILTER (WHERE recent) AS recent_runs,
        count(*) FILTER (WHERE recent AND status = 'failed') AS recent_failures,
        CAST(coalesce(sum(rows_processed) FILTER (WHERE recent), 0) AS BIGINT) AS recent_rows
      FROM (SELECT *, created_at > TIMESTAMP '{LOG_AS_OF} 00:00:00' - INTERVAL 24 HOUR
        AND created_at <= TIMESTAMP '{LOG_AS_OF} 00:00:00' AS recent FROM raw_run_log) GROUP BY 1, 2) r
    ON l.pipeline_name = r.pipeline_name AND l.step = r.step WHERE pos = 1""",
)(lambda t: metrics.run_metrics(t.raw("run_log"), LOG_AS_OF))
