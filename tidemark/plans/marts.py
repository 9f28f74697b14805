"""Reporting marts built from the staging views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import full_days_since
from tidemark.functions.numbers import average, mean_of
from tidemark.operators.joins import beside, folded_lookup
from tidemark.operators.ranking import rank_by
from tidemark.operators.running import change_from_previous, moving_average, rank_in_month, year_to_date
from tidemark.plans.gold import (
    CANCELLED,
    frequency_score,
    monetary_score,
    recency_score,
    rfm_tier,
)
from tidemark.sources.scratch import materialise

# Fixed value: days shown for a customer without orders.
NEVER_ORDERED_DAYS = 9999


def _stamped(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("updated_at", F.current_timestamp()) if stamp else df


def mart_daily_sales(stg_orders: DataFrame, stamp: bool = False) -> DataFrame:
    group = ("sale_date", "order_year", "order_month", "is_weekend")
    # Versions of one order are folded first; customers are counted on a second reading of few columns, so that no row
    # is copied for a distinct count.
    open_orders = stg_orders.filter(F.col("status") != CANCELLED).withColumn("sale_date", F.to_date("order_date"))
    folded = open_orders.groupBy(*group, "order_id").agg(
        F.sum("total_amount").alias("gross"),
        F.sum("net_amount").alias("net"),
        F.sum("shipping_cost").alias("shipping"),
        F.count("total_amount").alias("amounts"),
    )
    customers = open_orders.select(*group, "customer_id").distinct().groupBy(*group).agg(F.count("customer_id").alias("unique_customers"))
    by_order = folded.groupBy(*group).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("gross").cast("decimal(28,2)").alias("gross_revenue"),
        F.sum("net").cast("decimal(28,2)").alias("net_revenue"),
        F.sum("shipping").cast("decimal(28,2)").alias("total_shipping"),
        average(F.sum("gross"), F.sum("amounts")).alias("avg_order_value"),
    )
    first = [*group, "total_orders", "unique_customers"]
    daily = beside(by_order, customers, group).select(*first, *[c for c in by_order.columns if c not in first])
    day = "sale_date"
    running = {
        "ytd_revenue": year_to_date("gross_revenue", "order_year", day),
        "moving_avg_7d_revenue": moving_average("gross_revenue", day, 7),
        "moving_avg_30d_revenue": moving_average("gross_revenue", day, 30),
        "dod_change": change_from_previous("gross_revenue", day),
        "month_revenue_rank": rank_in_month("gross_revenue", "order_year", "order_month"),
    }
    return _stamped(daily.withColumns(running), stamp).orderBy(day)


def _customer_orders(stg_orders: DataFrame, as_of: date | str) -> DataFrame:
    """Order figures per customer; repeated versions of one order count once in the order count."""
    return (
        stg_orders.filter(F.col("status") != CANCELLED)
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("total_amount").alias("total_spend"),
            mean_of("total_amount").alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            full_days_since(F.max("order_date"), as_of).alias("recency"),
        )
    )


def _open_orders(stg_orders: DataFrame, *columns: str) -> DataFrame:
    """Orders that were not cancelled, one row each, with the number of their versions.

    Staging keeps repeated versions of an order and every version counts.  Folding them before the join means
    that an order with very many copies meets its items once, and its sums are multiplied afterwards.
    """
    kept = stg_orders.filter(F.col("status") != CANCELLED)
    return kept.groupBy("order_id", *columns).agg(F.count(F.lit(1)).alias("versions"))


def _customer_items(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    items = stg_order_items.select("order_id", "product_id", "quantity")
    units = F.sum("quantity").alias("units")
    return (
        folded_lookup(items, _open_orders(stg_orders, "customer_id"), "order_id", "product_id", [units])
        .groupBy("customer_id")
        .agg(
            F.sum(F.col("units") * F.col("versions")).alias("total_items_purchased"),
            F.count_distinct("product_id").alias("unique_products"),
        )
    )


def mart_customer_360(
    stg_customers: DataFrame,
    stg_orders: DataFrame,
    stg_order_items: DataFrame,
    as_of: date | str,
    stamp: bool = False,
) -> DataFrame:
    """Customer profile over the staging views, one row per staged customer version.

    The figures per customer are stored before the last join.  That join then has a plain shuffle on both
    sides, so adaptive execution can split a customer with very many staged versions.
    """
    figures, _ = materialise(
        _customer_orders(stg_orders, as_of).join(_customer_items(stg_order_items, stg_orders), "customer_id", "left"),
        "customer-figures",
    )
    joined = stg_customers.withColumnRenamed("created_at", "customer_since").join(figures, "customer_id", "left")

    def zero(column: str, of: str):
        return F.coalesce(column, F.lit(0).cast(of)).alias(column)

    profile = joined.select(
        "customer_id", "full_name", "email", "segment", "region", "city", "country", "customer_since",
        zero("total_orders", "bigint"),
        zero("total_spend", "decimal(22,2)"),
        zero("avg_order_value", "double"),
        "first_order_date",
        "last_order_date",
        F.coalesce("recency", F.lit(NEVER_ORDERED_DAYS)).alias("days_since_last_order"),
        zero("total_items_purchased", "bigint"),
        zero("unique_products", "bigint"),
        recency_score(F.col("recency")).alias("rfm_recency"),
    ).withColumns(
        {
            "rfm_frequency": frequency_score(F.col("total_orders")),
            "rfm_monetary": monetary_score(F.col("total_spend")),
            # With several versions of an order the average is over versions, hence average x orders here.
            "estimated_ltv": F.round(
                (F.col("avg_order_value") * F.col("total_orders") * F.lit(1.2)).cast("decimal(34,12)"), 2
            ).cast("decimal(22,2)"),
        }
    )
    tier = rfm_tier(F.col("rfm_recency"), F.col("rfm_frequency"), F.col("rfm_monetary"))
    return _stamped(profile.withColumn("customer_tier", tier), stamp)


def mart_product_performance(
    stg_products: DataFrame,
    stg_orders: DataFrame,
    stg_order_items: DataFrame,
    stamp: bool = False,
) -> DataFrame:
    """Product figures with the rank inside the category and overall.

    The sales per product are stored before they meet the staged products, for the reason given above.
    """
    items = stg_order_items.select("order_id", "product_id", "line_total", "quantity", "unit_price")
    figures = [
        F.sum("line_total").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.sum("unit_price").alias("prices"),
        F.count("unit_price").alias("lines"),
    ]
    versions = F.col("versions")
    sales, _ = materialise(
        folded_lookup(items, _open_orders(stg_orders), "order_id", "product_id", figures)
        .groupBy("product_id")
        .agg(
            F.sum(F.col("revenue") * versions).alias("total_revenue"),
            F.sum(F.col("units") * versions).alias("units_sold"),
            # One row per order and product is left, so counting rows counts distinct orders.
            F.count("order_id").alias("order_count"),
            average(F.sum(F.col("prices") * versions), F.sum(F.col("lines") * versions)).alias("avg_selling_price"),
        ),
        "product-sales",
    )
    figures = stg_products.join(sales, "product_id", "left").select(
        "product_id", "product_name", "category", "subcategory", "brand",
        F.col("price").alias("list_price"),
        "cost", "profit_margin", "price_tier",
        F.coalesce("total_revenue", F.lit(0).cast("decimal(32,2)")).alias("total_revenue"),
        F.coalesce("units_sold", F.lit(0).cast("bigint")).alias("units_sold"),
        F.coalesce("order_count", F.lit(0).cast("bigint")).alias("order_count"),
        F.coalesce("avg_selling_price", F.col("price").cast("double")).alias("avg_selling_price"),
    )
    ranked = rank_by(
        figures,
        [
            ("category_revenue_rank", ["category"], "total_revenue"),
            ("overall_revenue_rank", [], "total_revenue"),
        ],
        "mart_product_performance",
    )
    return _stamped(ranked, stamp)
