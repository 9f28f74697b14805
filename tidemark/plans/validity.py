"""What makes a row of a source table unusable: conditions in the order they are named, on the raw values.

The cleaned and the staged tables leave out the same rows, and every row left out has a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import DISCOUNT, PRICE, not_negative, positive, unfit

_ITEM = {"quantity is not positive": lambda: ~F.coalesce(F.col("quantity") > 0, F.lit(False))}
_ITEM_FIT = {"unit_price does not fit": lambda: unfit("unit_price", PRICE), "discount does not fit": lambda: unfit("discount", DISCOUNT)}

FAULTS = {
    "products": {
        "price is not positive": lambda: ~positive("price"),
        "cost is not positive": lambda: ~positive("cost"),
        "price does not fit": lambda: unfit("price", PRICE),
        "cost does not fit": lambda: unfit("cost", PRICE),
    },
    "orders": {
        "total_amount is missing or negative": lambda: ~not_negative("total_amount"),
        "total_amount does not fit": lambda: unfit("total_amount"),
        "shipping_cost does not fit": lambda: unfit("shipping_cost"),
    },
    "order_items": _ITEM | {"unit_price is not positive": lambda: ~positive("unit_price")} | _ITEM_FIT,
    "order_items_unpriced": _ITEM | _ITEM_FIT,
    "clickstream": {"event_type is missing": lambda: F.col("event_type").isNull()},
    "reviews": {"rating is not from 1 to 5": lambda: ~F.coalesce(F.col("rating").between(1, 5), F.lit(False))},
}


def faults(table: str) -> Column:
    """The first fault of a row, null for a valid one."""
    reason = F.lit(None).cast("string")
    for text, condition in reversed(FAULTS.get(table, {}).items()):
        reason = F.when(condition(), F.lit(text)).otherwise(reason)
    return reason


def valid(df: DataFrame, table: str) -> DataFrame:
    for condition in FAULTS[table].values():
        df = df.filter(~condition())
    return df
