"""Rollup, cube and pivot from one partial aggregate.

``GROUP BY ROLLUP`` copies every input row once per level before it aggregates, and a distinct count copies them once
more.  Here the rows are folded once to the finest groups (and, for a distinct count, the finest groups and counted
value); every level is an aggregate of that stored, much smaller table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise

ROW_COUNT = "row_count"


def _fold(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    folded = rows.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias(ROW_COUNT))
    return materialise(folded, "grouping")[0]


def grouping_sets(
    rows: DataFrame, levels: Sequence[Sequence[str]], sums: Mapping[str, Column], distinct: tuple[str, str] | None = None
) -> DataFrame:
    """One row per group of each level: all grouping columns (null where a level leaves one out), ``grouping_id``,
    the sums, ``row_count`` and, for ``distinct=(name, column)``, the number of different non-null values.

    ``grouping_id`` has one bit per grouping column, the first column the highest; it is set where the level leaves the
    column out, which tells that null from a null in the data.
    """
    keys = list(dict.fromkeys(c for level in levels for c in level))
    counted = [distinct[1]] if distinct else []
    folded = _fold(rows, [*keys, *counted], sums)
    added = [*sums, ROW_COUNT]

    def level_of(level: Sequence[str]) -> DataFrame:
        part = folded
        if counted:  # one row per group and value, so the count of values is a plain one
            part = part.groupBy(*level, *counted).agg(*[F.sum(n).alias(n) for n in added])
        measures = [F.sum(n).alias(n) for n in added] + ([F.count(distinct[1]).alias(distinct[0])] if distinct else [])
        part = part.groupBy(*level).agg(*measures)
        if not level:  # no group of an empty table
            part = part.where(F.col(ROW_COUNT).isNotNull())
        number = sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in level)
        names = [F.col(c) if c in level else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in keys]
        return part.select(*names, F.lit(number).alias("grouping_id"), *added, *([distinct[0]] if distinct else []))

    return reduce(DataFrame.unionByName, map(level_of, levels))


def rollup(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], distinct: tuple[str, str] | None = None) -> DataFrame:
    return grouping_sets(rows, [keys[:n] for n in range(len(keys), -1, -1)], sums, distinct)


def cube(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], distinct: tuple[str, str] | None = None) -> DataFrame:
    return grouping_sets(rows, [list(c) for n in range(len(keys), -1, -1) for c in combinations(keys, n)], sums, distinct)


def pivot(rows: DataFrame, keys: Sequence[str], column: str, values: Mapping[str, object], measure: Column) -> DataFrame:
    """One row per group with one column per named value: the sum of ``measure``, 0 where there is none.

    Rows with another value count towards no column but keep their group.
    """
    folded = _fold(rows, [*keys, column], {"_measure": measure})
    zero = F.lit(0).cast(folded.schema["_measure"].dataType)
    each = [F.coalesce(F.sum(F.when(F.col(column).eqNullSafe(F.lit(v)), F.col("_measure"))), zero).alias(n) for n, v in values.items()]
    return folded.groupBy(*keys).agg(*each)
