"""Ranks and dense numbers without a one-task sort.

``rank().over(Window.orderBy(..))`` sorts all rows in one task, and a partitioned rank sorts a whole
category in one task.  Here the work is done in ordered ranges, at every size:

* equal values are first folded into one row with a count (a value shared by a third of the rows becomes
  one row), the folded rows are range-partitioned and sorted, every range adds up its own counts, and the
  totals of earlier ranges are added;
* ranks then go back to the rows by an equi-join on the value.

What is sorted and written for ranks is narrow: the values.  Rows to be numbered are sorted themselves, once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise

_ROW_BITS = 33  # monotonically_increasing_id(): partition number above, row position below


def rank_by(
    df: DataFrame,
    ranks: Sequence[tuple[str, Sequence[str], str]],
    label: str = "rank",
) -> DataFrame:
    """Add one rank column per ``(name, partition columns, value column)``, highest value first.

    The input is written once, because it is read for every rank.
    """
    table, _ = materialise(df, label)
    result = table
    for name, groups, value in ranks:
        result = _attach_rank(result, _ranked_values(table, name, list(groups), value), name, [*groups, value])
    return result


def _attach_rank(rows: DataFrame, ranked: DataFrame, name: str, keys: list[str]) -> DataFrame:
    side = ranked.select(*[F.col(c).alias(f"_r_{c}") for c in keys], name)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys])
    # A value shared by very many rows is one hot join key on the row side only; both sides come straight
    # from a shuffle, so adaptive execution splits it.
    return rows.join(side, same, "inner").drop(*[f"_r_{c}" for c in keys])


def _ranked_values(table: DataFrame, name: str, groups: list[str], value: str) -> DataFrame:
    folded = table.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(c).asc_nulls_first() for c in groups] + [F.col(value).desc_nulls_last()]
    placed, _ = materialise(number_in_ranges(folded, order), f"{name}-values")

    inside = (
        Window.partitionBy("_slot", *groups)
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))

    # One row per (range, group): groups are contiguous in the ranges, so at most ranges + groups rows,
    # and at most one row per range inside a group.
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = placed.groupBy("_slot", *groups).agg(F.sum("_n").alias("_t"))
    totals = totals.select(
        F.col("_slot").alias("_o_slot"),
        *[F.col(c).alias(f"_o_{c}") for c in groups],
        (F.sum("_t").over(earlier) - F.col("_t")).alias("_offset"),
    )
    same = reduce(
        Column.__and__,
        [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in groups],
        F.col("_slot") == F.col("_o_slot"),
    )
    rank = (F.lit(1) + F.col("_offset") + F.col("_before")).cast("int")
    return local.join(totals, same, "inner").select(*groups, value, rank.alias(name))


def dense_numbers(
    df: DataFrame, order_by: Sequence[str], name: str, label: str = "numbers", after: DataFrame | int = 0
) -> DataFrame:
    """Number the rows in the order of a unique key, from 1 or behind ``after`` (a number, or one row with it).

    The rows pass one shuffle, by ranges of the key, and are written in that order; a row's number is its place in the
    range and the rows of earlier ranges.  The bounds of the ranges are sampled, so the last stage before runs twice.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    placed, _ = materialise(number_in_ranges(df, order), label)
    sizes = placed.groupBy("_slot").agg(F.count(F.lit(1)).alias("_t"))
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per range, so the broadcast is as small as the number of shuffle partitions.
    offsets = sizes.select("_slot", (F.sum("_t").over(earlier) - F.col("_t")).alias("_offset"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), "_slot")
    before: Column = F.lit(0)
    if isinstance(after, DataFrame):
        numbered = numbered.join(F.broadcast(after.toDF("_after")))
        before = F.coalesce("_after", F.lit(0))
    elif after:
        before = F.lit(after)
    number = F.col("_offset") + inside + F.lit(1) + before
    return numbered.select(number.cast("bigint").alias(name), *df.columns)


def number_in_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort into ordered ranges; ``_slot`` is the range, ``_place`` grows along it."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.withColumn("_slot", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
