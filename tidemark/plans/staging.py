"""Typed views over the raw tables, without deduplication: narrow transformations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import weekend
from tidemark.functions.numbers import AMOUNT, DISCOUNT, PRICE, below, money, money_or_zero, percent
from tidemark.functions.text import or_unknown, relabel, tidy
from tidemark.plans.silver import CANCELLED_SYNONYMS, KEPT_STATUSES, PRICE_TIERS, TOP_PRICE_TIER, line_total
from tidemark.plans.validity import valid

# This variant does not count "normal" as a standard customer.
STAGING_SEGMENTS = {"premium": ("premium", "gold", "vip"), "standard": ("standard", "regular")}


def stg_customers(raw: DataFrame) -> DataFrame:
    segment = tidy("segment")
    return raw.select(
        "customer_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.concat(F.trim("first_name"), F.lit(" "), F.trim("last_name")).alias("full_name"),
        tidy("email").alias("email"),
        "phone",
        relabel(segment, STAGING_SEGMENTS, or_unknown(segment)).alias("segment"),
        or_unknown(tidy("region")).alias("region"),
        or_unknown(F.trim("city")).alias("city"),
        or_unknown(F.trim("country")).alias("country"),
        "created_at",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    price, cost = money("price", PRICE), money("cost", PRICE)
    optional = [c for c in ("weight_kg", "created_at") if c in raw.columns]
    return valid(raw, "products").select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        *[tidy(c).alias(c) for c in ("category", "subcategory", "brand")],
        price.alias("price"),
        cost.alias("cost"),
        percent(price - cost, price).alias("profit_margin"),
        below(price, PRICE_TIERS, TOP_PRICE_TIER).alias("price_tier"),
        *optional,
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    total = money("total_amount")
    shipping = money_or_zero("shipping_cost")
    labels = {s: (s,) for s in KEPT_STATUSES} | {"cancelled": CANCELLED_SYNONYMS}
    return valid(raw, "orders").select(
        "order_id",
        "customer_id",
        "order_date",
        relabel(F.col("status"), labels, F.lit("unknown")).alias("status"),
        total.alias("total_amount"),
        shipping.alias("shipping_cost"),
        (total - shipping).cast(AMOUNT).alias("net_amount"),
        "payment_method",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        weekend("order_date").alias("is_weekend"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return (
        valid(raw, "order_items")
        .select(
            "item_id",
            "order_id",
            "product_id",
            "quantity",
            money("unit_price", PRICE).alias("unit_price"),
            money_or_zero("discount", DISCOUNT).alias("discount"),
        )
        .withColumn("line_total", line_total())
    )
