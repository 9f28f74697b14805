"""Cleaned tables, one function per source.

Each keeps the newest version of a key, tidies text, drops invalid rows and derives columns.  The keyword
options give the reduced variants of the interactive runs.  ``stamp=True`` adds the load time; it is off by
default so that a builder returns the same rows whenever it runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, weekend
from tidemark.functions.numbers import AMOUNT, DISCOUNT, PRICE, below, money, money_or_zero, percent
from tidemark.functions.text import is_email, or_unknown, relabel, standardize_strings, tidy
from tidemark.operators.dedup import latest_of
from tidemark.plans.validity import faults, valid
from tidemark.schemas import SOURCES
from tidemark.sources.files import REASON
from tidemark.sources.scratch import materialise

# Synonyms, statuses, price limits, events.
SEGMENT_SYNONYMS = {"premium": ("premium", "gold", "vip"), "standard": ("standard", "regular", "normal")}
KEPT_STATUSES = ("completed", "delivered", "shipped", "pending", "processing")
CANCELLED_SYNONYMS = ("cancelled", "canceled", "refunded")
PRICE_TIERS = ((25, "budget"), (100, "mid-range"), (500, "premium"))
TOP_PRICE_TIER = "luxury"
CONVERSION_EVENTS = ("purchase", "checkout", "add_to_cart")

SILVER_VERSION = 1


def silver_metadata(df: DataFrame, stamp: bool = False) -> DataFrame:
    columns = {"_silver_version": F.lit(SILVER_VERSION)}
    if stamp:
        columns["_silver_timestamp"] = F.current_timestamp()
    return df.withColumns(columns)


def customers(raw: DataFrame, *, map_segments: bool = True, tidy_places: bool = True, stamp: bool = False) -> DataFrame:
    """``map_segments`` folds segment synonyms; ``tidy_places`` also cleans city and country."""
    rows = latest_of(raw, SOURCES["customers"])
    segment = tidy("segment")
    derived = {
        "segment": relabel(segment, SEGMENT_SYNONYMS, or_unknown(segment)) if map_segments else segment,
        "region": or_unknown(tidy("region")),
        "email_valid": is_email("email"),
        "full_name": F.concat_ws(" ", "first_name", "last_name"),
    }
    if tidy_places:
        derived |= {c: or_unknown(tidy(c)) for c in ("city", "country")}
    return silver_metadata(rows.withColumns(derived), stamp)


def products(raw: DataFrame, *, tidy_labels: bool = True, stamp: bool = False) -> DataFrame:
    rows = latest_of(raw, SOURCES["products"])
    if tidy_labels:
        rows = standardize_strings(rows, ("category", "subcategory", "brand"))
    priced = valid(rows, "products").withColumns({"price": money("price", PRICE), "cost": money("cost", PRICE)})
    derived = {
        "profit_margin": percent(F.col("price") - F.col("cost"), F.col("price")),
        "price_tier": below(F.col("price"), PRICE_TIERS, TOP_PRICE_TIER),
    }
    return silver_metadata(priced.withColumns(derived), stamp)


def orders(raw: DataFrame, *, normalise_status: bool = True, stamp: bool = False) -> DataFrame:
    """Without ``normalise_status`` the raw status stays and only year, month and weekend are derived."""
    rows = latest_of(raw, SOURCES["orders"])
    amounts = valid(rows, "orders").withColumns({"total_amount": money("total_amount"), "shipping_cost": money("shipping_cost")})
    when = F.col("order_date")
    derived = {
        "order_year": F.year(when),
        "order_month": F.month(when),
        "is_weekend": weekend(when),
        "net_amount": F.col("total_amount") - F.coalesce("shipping_cost", F.lit(0).cast(AMOUNT)),
    }
    if normalise_status:
        status = F.col("status")
        labels = {s: (s,) for s in KEPT_STATUSES} | {"cancelled": CANCELLED_SYNONYMS}
        derived |= {
            "status": relabel(status, labels, F.lit("unknown")),
            "order_date_key": date_key(when),
            "order_day": F.dayofmonth(when),
            "order_dayofweek": F.dayofweek(when),
            "order_hour": F.hour(when),
        }
    return silver_metadata(amounts.withColumns(derived), stamp)


def order_items(raw: DataFrame, *, require_price: bool = True, stamp: bool = False) -> DataFrame:
    rows = latest_of(raw, SOURCES["order_items"])
    kept = valid(rows, "order_items" if require_price else "order_items_unpriced")
    amounts = kept.withColumns({"unit_price": money("unit_price", PRICE), "discount": money_or_zero("discount", DISCOUNT)})
    return silver_metadata(amounts.withColumns({"line_total": line_total()}), stamp)


def line_total() -> Column:
    """Quantity by price less discount, rounded once."""
    net = F.col("quantity") * F.col("unit_price") * (F.lit(1).cast(DISCOUNT) - F.col("discount"))
    return F.round(net, 2).cast("decimal(22,2)")


def rejected(raw: DataFrame, table: str) -> DataFrame:
    """Newest versions that the cleaned table leaves out, each with its first fault as ``_reject_reason``."""
    rows = latest_of(raw, SOURCES[table])
    return rows.withColumn(REASON, faults(table)).filter(F.col(REASON).isNotNull())


def rejected_beside(raw: DataFrame, table: str, cleaned: DataFrame) -> DataFrame:
    """``rejected`` where the cleaned table of these keys is stored: rows without a fault are not ordered once more.

    A key whose newest version has a fault is not in the cleaned table, and that version is the newest of those with
    a fault (faults depend on columns that order versions).  The faulty ones are stored first: where there are few,
    the keys of the cleaned table are not shuffled, and where there are none, not read.
    """
    key = SOURCES[table].key
    faulty = rejected(raw.filter(faults(table).isNotNull()), table)
    found, rows = materialise(faulty, f"{table}-faulty")
    if not rows:
        return found
    kept = cleaned.select(F.col(key).alias("_kept"))
    return found.join(kept, F.col(key).eqNullSafe(F.col("_kept")), "left_anti")


def clickstream(raw: DataFrame, *, stamp: bool = False) -> DataFrame:
    rows = standardize_strings(latest_of(raw, SOURCES["clickstream"]), ("event_type", "device_type", "browser"))
    derived = {
        "event_date": F.to_date("timestamp"),
        "event_hour": F.hour("timestamp"),
        "is_conversion": F.col("event_type").isin(*CONVERSION_EVENTS),
    }
    return silver_metadata(rows.filter(F.col("event_type").isNotNull()).withColumns(derived), stamp)


def reviews(raw: DataFrame, *, stamp: bool = False) -> DataFrame:
    rows = latest_of(raw, SOURCES["reviews"]).filter(F.col("rating").between(1, 5))
    rating = F.col("rating")
    sentiment = F.when(rating >= 4, "positive").when(rating == 3, "neutral").otherwise("negative")
    return silver_metadata(
        rows.withColumns({"sentiment": sentiment, "review_length": F.length("review_text")}), stamp
    )


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "clickstream": clickstream,
    "reviews": reviews,
}

# The four tables of the interactive run with their reduced options.
REDUCED_OPTIONS: dict[str, dict[str, bool]] = {
    "customers": {"map_segments": False, "tidy_places": False},
    "products": {"tidy_labels": False},
    "orders": {"normalise_status": False},
    "order_items": {"require_price": False},
}
