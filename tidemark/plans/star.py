"""Star schema: date, customer and product dimensions, order and item facts.

Surrogate keys of a first build are dense numbers in natural-key order.  A later build is given the previous table: known
natural keys keep their number, new ones are numbered behind the largest, so facts stored before stay valid.  Facts
whose natural key the dimension does not have point to its unknown member, which both dimensions and the order fact hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, weekend
from tidemark.operators.joins import salted_lookup
from tidemark.operators.ranking import dense_numbers
from tidemark.sources.scratch import materialise

# Surrogate key and label of the unknown member.
UNKNOWN_KEY = -1
UNKNOWN_LABEL = "unknown"


def date_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Every day from start to end, both included, with its calendar attributes."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("first_day"), F.lit(str(end)).cast("date").alias("last_day")
    )
    return _days(bounds)


def date_spine_of(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date of a column."""
    day = F.to_date(column)
    return _days(df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))


def _days(bounds: DataFrame) -> DataFrame:
    step = F.expr("interval 1 day")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", step)).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekend(d).alias("is_weekend"),
    )


def dim_date(spine: DataFrame, fiscal_start_month: int = 1) -> DataFrame:
    """Adds the holiday flag (nothing is known to be a holiday) and the fiscal calendar."""
    shifted = F.add_months("full_date", (13 - fiscal_start_month) % 12)
    return spine.withColumns(
        {
            "is_holiday": F.lit(False),
            "fiscal_year": F.year(shifted),
            "fiscal_quarter": F.quarter(shifted),
        }
    )


def _updated(df: DataFrame, stamp: bool, column: str = "updated_at") -> DataFrame:
    return df.withColumn(column, F.current_timestamp()) if stamp else df


def _numbered(rows: DataFrame, natural: str, surrogate: str, label: str, previous: DataFrame | None) -> DataFrame:
    """Rows with their surrogate key, those of the previous table unchanged."""
    if previous is None:
        return dense_numbers(rows, [natural], surrogate, label)
    known = previous.filter(F.col(surrogate) > 0).select(natural, surrogate)
    rows, _ = materialise(rows, f"{label}-rows")
    old = rows.join(known, natural).select(surrogate, *rows.columns)
    largest = known.agg(F.max(surrogate)).first()[0] or 0
    new = dense_numbers(rows.join(known, natural, "left_anti").select(rows.columns), [natural], surrogate, label, after=largest)
    return old.unionByName(new)


def _with_unknown(df: DataFrame, surrogate: str, labelled: Sequence[str] = (), **others: object) -> DataFrame:
    """Adds the unknown member: its key, the label in descriptive columns, null elsewhere."""
    values = {surrogate: UNKNOWN_KEY, **{c: UNKNOWN_LABEL for c in labelled}, **others}
    member = df.sparkSession.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(member)


def dim_customer(customers: DataFrame, tiers: DataFrame, stamp: bool = False, previous: DataFrame | None = None) -> DataFrame:
    """Silver customers with the tier from the gold profile."""
    described = customers.join(tiers.select("customer_id", "customer_tier"), "customer_id", "left").select(
        "customer_id", "first_name", "last_name", "full_name", "email", "phone", "segment", "region", "city",
        "country", "customer_tier", "created_at", F.lit(True).alias("is_active"),
    )
    numbered = _numbered(described, "customer_id", "customer_key", "dim_customer", previous)
    labelled = ("full_name", "segment", "region", "city", "country", "customer_tier")
    return _updated(_with_unknown(numbered, "customer_key", labelled, is_active=False), stamp)


def dim_product(products: DataFrame, stamp: bool = False, previous: DataFrame | None = None) -> DataFrame:
    optional = [c for c in ("created_at",) if c in products.columns]
    described = products.select(
        "product_id", "product_name", "category", "subcategory", "brand", "price", "cost", "profit_margin",
        "price_tier", F.col("weight_kg").cast("decimal(8,2)").alias("weight_kg"), *optional,
        F.lit(True).alias("is_active"),
    )
    numbered = _numbered(described, "product_id", "product_key", "dim_product", previous)
    labelled = ("product_name", "category", "subcategory", "brand", "price_tier")
    return _updated(_with_unknown(numbered, "product_key", labelled, is_active=False), stamp)


def _known(key: str) -> Column:
    return F.coalesce(key, F.lit(UNKNOWN_KEY).cast("bigint")).alias(key)


def with_customer_key(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the surrogate key of their customer; one customer may own a large share of the orders."""
    found = salted_lookup(orders, customers.select("customer_id", "customer_key"), "customer_id", ["order_id"], "left")
    return found.withColumn("customer_key", _known("customer_key"))


def fact_orders(orders: DataFrame, customers: DataFrame, stamp: bool = False, previous: DataFrame | None = None) -> DataFrame:
    rows = with_customer_key(orders, customers).select(
        "order_id", "customer_key", F.col("order_date_key"), "status", "total_amount", "shipping_cost",
        "net_amount", "payment_method", "order_year", "order_month", "is_weekend",
    )
    numbered = _numbered(rows, "order_id", "order_key", "fact_orders", previous)
    return _updated(_with_unknown(numbered, "order_key", ("status",), customer_key=UNKNOWN_KEY), stamp, "created_at")


def fact_order_items(
    order_items: DataFrame, orders: DataFrame, products: DataFrame, stamp: bool = False, previous: DataFrame | None = None
) -> DataFrame:
    """``orders`` is the order fact and ``products`` the product dimension.

    The order lookup has fact size on both sides, so it is a plain shuffle join whose hot keys adaptive
    execution splits; the product lookup is salted by item.
    """
    with_order = order_items.join(orders.select("order_id", "order_key"), "order_id", "left")
    with_product = salted_lookup(
        with_order, products.select("product_id", "product_key"), "product_id", ["item_id"], "left", keys=order_items
    )
    rows = with_product.select(
        "item_id", _known("order_key"), _known("product_key"), "quantity", "unit_price", "discount", "line_total"
    )
    return _updated(_numbered(rows, "item_id", "item_key", "fact_order_items", previous), stamp, "created_at")
