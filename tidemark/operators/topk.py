"""The k first rows in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_rows(df: DataFrame, by: str, ties: Sequence[str], k: int, largest: int) -> DataFrame:
    """Highest ``by`` first.  Each task keeps k rows, so only k rows per task reach the final step."""
    if not 1 <= k <= largest:
        raise ValueError(f"row limit must be between 1 and {largest}, got {k}")
    order = [F.col(by).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in ties]
    return df.orderBy(*order).limit(k)
