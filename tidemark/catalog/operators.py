"""Single-operator queries: filters, projections, joins, aggregates, windows, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.sql_views import AS_OF, mean
from tidemark.catalog.tables import Tables
from tidemark.functions.dates import days_since
from tidemark.functions.numbers import below, mean_of
from tidemark.functions.text import is_email, relabel, standardize_strings
from tidemark.operators import joins, running
from tidemark.operators.dedup import latest_of
from tidemark.operators.ranking import dense_numbers, rank_by
from tidemark.operators.topk import top_rows
from tidemark.plans import gold, star
from tidemark.schemas import SOURCES

# Filters and projections


@query(
    "filter_valid_rows",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
    WHERE l_quantity > 10 AND l_extendedprice >= 1000 AND l_discount < 0.05 AND l_tax <= 0.06 AND l_returnflag <> 'R'""",
)
def filter_valid_rows(t: Tables) -> DataFrame:
    return (
        t.given("lineitem")
        .filter(
            (F.col("l_quantity") > 10)
            & (F.col("l_extendedprice") >= 1000)
            & (F.col("l_discount") < 0.05)
            & (F.col("l_tax") <= 0.06)
            & (F.col("l_returnflag") != "R")
        )
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )


@query(
    "filter_not_null",
    "SELECT event_id, event_type, timestamp FROM raw_clickstream WHERE event_type IS NOT NULL AND customer_id IS NULL",
)
def filter_not_null(t: Tables) -> DataFrame:
    rows = t.raw("clickstream").filter(F.col("event_type").isNotNull() & F.col("customer_id").isNull())
    return rows.select("event_id", "event_type", "timestamp")


@query(
    "filter_isin",
    """SELECT status, status IN ('delivered', 'pending') AS is_open, count(*) AS order_count FROM raw_orders
    WHERE status NOT IN ('lost') GROUP BY 1, 2""",
)
def filter_isin(t: Tables) -> DataFrame:
    return (
        t.raw("orders")
        .filter(~F.col("status").isin("lost"))
        .groupBy("status", F.col("status").isin("delivered", "pending").alias("is_open"))
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


@query("filter_between", "SELECT review_id, rating FROM raw_reviews WHERE rating BETWEEN 1 AND 5")
def filter_between(t: Tables) -> DataFrame:
    return t.raw("reviews").filter(F.col("rating").between(1, 5)).select("review_id", "rating")


@query(
    "email_valid",
    r"""SELECT customer_id, email, regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') AS email_valid
    FROM raw_customers""",
)
def email_valid(t: Tables) -> DataFrame:
    return t.raw("customers").select("customer_id", "email", is_email("email").alias("email_valid"))


@query(
    "case_buckets",
    """SELECT product_id, price, CASE WHEN price < 25 THEN 'budget' WHEN price < 100 THEN 'mid-range'
      WHEN price < 500 THEN 'premium' ELSE 'luxury' END AS price_tier FROM raw_products""",
)
def case_buckets(t: Tables) -> DataFrame:
    tier = below(F.col("price"), ((25, "budget"), (100, "mid-range"), (500, "premium")), "luxury")
    return t.raw("products").select("product_id", "price", tier.alias("price_tier"))


@query(
    "fill_defaults",
    """SELECT customer_id, coalesce(region, 'unknown') AS region, coalesce(country, 'unknown') AS country,
      coalesce(phone, 'none') AS phone FROM raw_customers""",
)
def fill_defaults(t: Tables) -> DataFrame:
    rows = t.raw("customers").select("customer_id", "region", "country", "phone")
    return rows.fillna("unknown", subset=["region", "country"]).fillna({"phone": "none"})


@query(
    "typed_cast",
    """SELECT customer_id, try_cast(phone AS BIGINT) AS phone_number, try_cast(region AS INTEGER) AS region_number,
      try_cast(substr(customer_id, 2) AS INTEGER) AS customer_number, CAST(created_at AS DATE) AS created_on FROM raw_customers""",
)
def typed_cast(t: Tables) -> DataFrame:
    return t.raw("customers").select(
        "customer_id",
        F.col("phone").try_cast("bigint").alias("phone_number"),
        F.col("region").try_cast("int").alias("region_number"),
        F.substring("customer_id", 2, 100).try_cast("int").alias("customer_number"),
        F.col("created_at").cast("date").alias("created_on"),
    )


@query(
    "standardize_strings",
    """SELECT event_id, lower(trim(event_type)) AS event_type, lower(trim(device_type)) AS device_type FROM raw_clickstream""",
)
def standardised(t: Tables) -> DataFrame:
    rows = t.raw("clickstream").select("event_id", "event_type", "device_type")
    return standardize_strings(rows, ("event_type", "device_type", "browser"))


@query(
    "map_values",
    """SELECT order_id, CASE WHEN status IN ('completed','delivered','shipped') THEN 'done'
      WHEN status IN ('cancelled','canceled','refunded') THEN 'cancelled' ELSE 'open' END AS state FROM raw_orders""",
)
def map_values(t: Tables) -> DataFrame:
    labels = {"done": ("completed", "delivered", "shipped"), "cancelled": ("cancelled", "canceled", "refunded")}
    return t.raw("orders").select("order_id", relabel(F.col("status"), labels, F.lit("open")).alias("state"))


@query(
    "date_parts",
    """SELECT order_id, CAST(year(order_date) AS INTEGER) AS y, CAST(quarter(order_date) AS INTEGER) AS q,
      CAST(month(order_date) AS INTEGER) AS m, CAST(day(order_date) AS INTEGER) AS d, CAST(hour(order_date) AS INTEGER) AS h,
      CAST(week(order_date) AS INTEGER) AS iso_week, CAST(dayofweek(order_date) AS INTEGER) AS dow,
      CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, strftime(order_date, '%B') AS month_name,
      strftime(order_date, '%A') AS day_name FROM raw_orders""",
)
def date_parts(t: Tables) -> DataFrame:
    d = F.col("order_date")
    return t.raw("orders").select(
        "order_id",
        F.year(d).alias("y"),
        F.quarter(d).alias("q"),
        F.month(d).alias("m"),
        F.dayofmonth(d).alias("d"),
        F.hour(d).alias("h"),
        F.weekofyear(d).alias("iso_week"),
        (F.dayofweek(d) - 1).alias("dow"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
    )


@query(
    "string_concat",
    """SELECT customer_id, concat_ws(' ', first_name, phone) AS skips_nulls, first_name || ' ' || phone AS keeps_nulls,
      CAST(length(email) AS INTEGER) AS email_length FROM raw_customers""",
)
def string_concat(t: Tables) -> DataFrame:
    return t.raw("customers").select(
        "customer_id",
        F.concat_ws(" ", "first_name", "phone").alias("skips_nulls"),
        F.concat("first_name", F.lit(" "), "phone").alias("keeps_nulls"),
        F.length("email").alias("email_length"),
    )


# Joins


@query(
    "join_inner",
    """SELECT i.item_id, i.order_id, i.product_id, p.category, i.quantity FROM silver_order_items i
    JOIN silver_products p ON i.product_id = p.product_id""",
)
def join_inner(t: Tables) -> DataFrame:
    items = t.silver("order_items").select("item_id", "order_id", "product_id", "quantity")
    return joins.salted_lookup(items, t.silver("products").select("product_id", "category"), "product_id", ["item_id"])


@query(
    "join_left",
    """SELECT c.customer_id, c.segment, om.total_orders, om.total_spend, rm.total_reviews FROM silver_customers c
    LEFT JOIN order_metrics om ON c.customer_id = om.customer_id LEFT JOIN review_metrics rm ON c.customer_id = rm.customer_id""",
)
def join_left(t: Tables) -> DataFrame:
    ordered = gold.order_metrics(t.silver("orders"), AS_OF).select("customer_id", "total_orders", "total_spend")
    reviewed = gold.review_metrics(t.silver("reviews")).select("customer_id", "total_reviews")
    customers = t.silver("customers").select("customer_id", "segment")
    return customers.join(ordered, "customer_id", "left").join(reviewed, "customer_id", "left")


@query(
    "join_anti",
    """SELECT DISTINCT customer_id FROM raw_clickstream e
    WHERE NOT EXISTS (SELECT 1 FROM raw_orders o WHERE o.customer_id = e.customer_id)""",
)
def join_anti(t: Tables) -> DataFrame:
    return joins.orphan_keys(t.raw("clickstream"), "customer_id", t.raw("orders"), "customer_id")


@query(
    "star_lookup",
    """SELECT o.order_id, coalesce(c.customer_key, -1) AS customer_key, o.order_date_key FROM silver_orders o
    LEFT JOIN (SELECT * FROM keyed_customers WHERE customer_key > 10) c ON o.customer_id = c.customer_id""",
)
def star_lookup(t: Tables) -> DataFrame:
    keyed = dense_numbers(t.silver("customers").select("customer_id"), ["customer_id"], "customer_key")
    # Ten customers are left out so that some orders point to the unknown member.
    known = keyed.filter(F.col("customer_key") > 10)
    return star.with_customer_key(t.silver("orders"), known).select("order_id", "customer_key", "order_date_key")


# Aggregates


@query(
    "agg_group",
    """SELECT CAST(order_date AS DATE) AS sale_date, status, count(*) AS order_count, CAST(sum(total_amount) AS DECIMAL(22,2)) AS revenue
    FROM raw_orders GROUP BY 1, 2""",
)
def agg_group(t: Tables) -> DataFrame:
    return (
        t.raw("orders")
        .groupBy(F.to_date("order_date").alias("sale_date"), "status")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("revenue"))
    )


@query(
    "agg_count",
    "SELECT device_type, count(*) AS all_rows, count(customer_id) AS known_customers FROM raw_clickstream GROUP BY 1",
)
def agg_count(t: Tables) -> DataFrame:
    return (
        t.raw("clickstream")
        .groupBy("device_type")
        .agg(F.count(F.lit(1)).alias("all_rows"), F.count("customer_id").alias("known_customers"))
    )


@query(
    "agg_count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""",
)
def agg_count_distinct(t: Tables) -> DataFrame:
    return (
        t.given("lineitem")
        .groupBy("l_returnflag")
        .agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"))
    )


@query(
    "agg_sum",
    """SELECT payment_method, CAST(sum(total_amount) AS DECIMAL(22,2)) AS amount, CAST(sum(shipping_cost) AS DECIMAL(22,2)) AS shipping
    FROM raw_orders GROUP BY 1""",
)
def agg_sum(t: Tables) -> DataFrame:
    return (
        t.raw("orders")
        .groupBy("payment_method")
        .agg(F.sum("total_amount").alias("amount"), F.sum("shipping_cost").alias("shipping"))
    )


@query(
    "agg_avg",
    f"SELECT product_id, {mean('quantity')} AS avg_quantity, {mean('unit_price')} AS avg_price FROM raw_order_items GROUP BY 1",
)
def agg_avg(t: Tables) -> DataFrame:
    return (
        t.raw("order_items")
        .groupBy("product_id")
        .agg(mean_of("quantity").alias("avg_quantity"), mean_of("unit_price").alias("avg_price"))
    )


@query(
    "agg_min_max",
    """SELECT customer_id, min(order_date) AS first_order, max(order_date) AS last_order, min(total_amount) AS smallest,
      max(total_amount) AS largest FROM raw_orders GROUP BY 1""",
)
def agg_min_max(t: Tables) -> DataFrame:
    return (
        t.raw("orders")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
            F.min("total_amount").alias("smallest"),
            F.max("total_amount").alias("largest"),
        )
    )


@query(
    "agg_sum_if",
    """SELECT payment_method, CAST(sum(CASE WHEN status = 'canceled' THEN total_amount ELSE 0 END) AS DECIMAL(22,2)) AS lost_revenue,
      count(CASE WHEN status = 'canceled' THEN 1 END) AS lost_orders FROM raw_orders GROUP BY 1""",
)
def agg_sum_if(t: Tables) -> DataFrame:
    lost = F.col("status") == "canceled"
    return (
        t.raw("orders")
        .groupBy("payment_method")
        .agg(
            F.sum(F.when(lost, F.col("total_amount")).otherwise(F.lit(0).cast("decimal(12,2)"))).alias("lost_revenue"),
            F.count_if(lost).alias("lost_orders"),
        )
    )


@query(
    "agg_count_distinct_if",
    """SELECT payment_method, count(DISTINCT CASE WHEN status = 'canceled' THEN customer_id END) AS cancelling_customers,
      count(DISTINCT CASE WHEN status <> 'canceled' THEN customer_id END) AS buying_customers FROM raw_orders GROUP BY 1""",
)
def agg_count_distinct_if(t: Tables) -> DataFrame:
    lost = F.col("status") == "canceled"
    return (
        t.raw("orders")
        .groupBy("payment_method")
        .agg(
            F.count_distinct(F.when(lost, F.col("customer_id"))).alias("cancelling_customers"),
            F.count_distinct(F.when(~lost, F.col("customer_id"))).alias("buying_customers"),
        )
    )


@query(
    "recency_days",
    f"""SELECT customer_id, CAST(date_diff('day', CAST(max(order_date) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days
    FROM raw_orders GROUP BY 1""",
)
def recency_days(t: Tables) -> DataFrame:
    return t.raw("orders").groupBy("customer_id").agg(days_since(F.max("order_date"), AS_OF).alias("days"))


@query("distinct_keys", "SELECT DISTINCT product_id FROM raw_order_items")
def distinct_keys(t: Tables) -> DataFrame:
    return joins.distinct_keys(t.raw("order_items"), "product_id")


# Windows


@query(
    "dedup_latest",
    """SELECT item_id, order_id, product_id, quantity, unit_price, discount, _ingestion_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY _ingestion_timestamp DESC NULLS LAST, order_id, product_id,
      quantity, unit_price, discount NULLS LAST) AS pos FROM raw_order_items) WHERE pos = 1""",
)
def dedup_latest(t: Tables) -> DataFrame:
    return latest_of(t.raw("order_items"), SOURCES["order_items"])


@query("top1_per_group", "SELECT customer_id, favorite_category FROM favourite_category")
def top1_per_group(t: Tables) -> DataFrame:
    items = t.stored("order_items", "order_id", "product_id")
    return gold.favourite_category(items, t.silver("orders"), t.silver("products"))


@query("window_ytd", "SELECT sale_date, ytd_revenue, ytd_orders FROM gold_daily_sales")
def window_ytd(t: Tables) -> DataFrame:
    return gold.sales_per_day(t.silver("orders")).select(
        "sale_date",
        running.year_to_date("gross_revenue", "order_year", "sale_date").alias("ytd_revenue"),
        running.year_to_date("total_orders", "order_year", "sale_date").alias("ytd_orders"),
    )


@query("window_ma7", "SELECT sale_date, moving_avg_7d_revenue, moving_avg_7d_orders FROM gold_daily_sales")
def window_ma7(t: Tables) -> DataFrame:
    return gold.sales_per_day(t.silver("orders")).select(
        "sale_date",
        running.moving_average("gross_revenue", "sale_date", 7).alias("moving_avg_7d_revenue"),
        running.moving_average("total_orders", "sale_date", 7).alias("moving_avg_7d_orders"),
    )


@query("window_ma30", "SELECT sale_date, moving_avg_30d_revenue FROM gold_daily_sales")
def window_ma30(t: Tables) -> DataFrame:
    average = running.moving_average("gross_revenue", "sale_date", 30)
    return gold.sales_per_day(t.silver("orders")).select("sale_date", average.alias("moving_avg_30d_revenue"))


@query(
    "window_lag",
    """SELECT sale_date, CAST(gross_revenue - lag(gross_revenue) OVER (ORDER BY sale_date) AS DECIMAL(23,2)) AS dod_change
    FROM day_sales""",
)
def window_lag(t: Tables) -> DataFrame:
    change = running.change_from_previous("gross_revenue", "sale_date")
    return gold.sales_per_day(t.silver("orders")).select("sale_date", change.alias("dod_change"))


@query(
    "window_rank_month",
    """SELECT sale_date, CAST(rank() OVER (PARTITION BY order_year, order_month ORDER BY gross_revenue DESC) AS INTEGER) AS month_revenue_rank
    FROM day_sales""",
)
def window_rank_month(t: Tables) -> DataFrame:
    rank = running.rank_in_month("gross_revenue", "order_year", "order_month")
    return gold.sales_per_day(t.silver("orders")).select("sale_date", rank.alias("month_revenue_rank"))


@query(
    "window_rank_category",
    """SELECT product_id, category, price, CAST(rank() OVER (PARTITION BY category ORDER BY price DESC) AS INTEGER) AS category_rank
    FROM silver_products""",
)
def window_rank_category(t: Tables) -> DataFrame:
    rows = t.silver("products").select("product_id", "category", "price")
    return rank_by(rows, [("category_rank", ["category"], "price")])


@query(
    "window_rank_global",
    """SELECT product_id, price, CAST(rank() OVER (ORDER BY price DESC) AS INTEGER) AS overall_rank FROM silver_products""",
)
def window_rank_global(t: Tables) -> DataFrame:
    return rank_by(t.silver("products").select("product_id", "price"), [("overall_rank", [], "price")])


@query(
    "window_rank_ranges",
    """SELECT item_id, quantity, CAST(rank() OVER (PARTITION BY product_id ORDER BY quantity DESC) AS INTEGER) AS product_rank,
      CAST(rank() OVER (ORDER BY quantity DESC) AS INTEGER) AS overall_rank FROM silver_order_items""",
)
def window_rank_ranges(t: Tables) -> DataFrame:
    """The range form of the ranks on heavily tied values, whatever the size of the input."""
    rows = t.silver("order_items").select("item_id", "product_id", "quantity")
    ranks = [("product_rank", ["product_id"], "quantity"), ("overall_rank", [], "quantity")]
    return rank_by(rows, ranks).drop("product_id")


@query(
    "topk",
    "SELECT order_id, customer_id, total_amount FROM silver_orders ORDER BY total_amount DESC NULLS LAST, order_id LIMIT 100",
)
def topk(t: Tables) -> DataFrame:
    rows = t.silver("orders").select("order_id", "customer_id", "total_amount")
    return top_rows(rows, "total_amount", ["order_id"], 100, 500)
