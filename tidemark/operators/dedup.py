"""One row per key.

Both functions keep the ``row_number() <= 1`` form on purpose: Spark turns it into a window group
limit that keeps one row per key inside every map task *before* the shuffle.  A key that holds a third
of the table therefore sends one row per map task over the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import INGESTED_AT, SourceTable

_POSITION = "_position"


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each group in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_POSITION, F.row_number().over(window)).filter(F.col(_POSITION) == 1).drop(_POSITION)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ties: Sequence[str] | None = None,
    hashed_ties: Sequence[str] = (),
    newest: str = INGESTED_AT,
) -> DataFrame:
    """Keep the most recently ingested version of each key.

    Versions from one batch share their ingest time, so ``ties`` (default: every other column) fix
    which one survives.
    """
    present = set(df.columns)
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != newest]
    order = [F.col(newest).desc_nulls_last()] if newest in present else []
    order += [F.col(c).asc_nulls_last() for c in ties if c in present]
    order += [F.xxhash64(c).asc_nulls_last() for c in hashed_ties if c in present]
    if not order:
        return df.dropDuplicates(list(keys))
    return first_per_group(df, keys, order)


def latest_of(df: DataFrame, table: SourceTable) -> DataFrame:
    """``latest_per_key`` with the key and tie order of a source table."""
    return latest_per_key(df, [table.key], table.ties, table.hashed_ties)
