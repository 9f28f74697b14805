"""Exact quantiles by refining histograms, and equal-sized groups in the order of a value.

Neither sorts the rows in one task: a quantile needs a few passes of counting, and the groups follow from a range sort
of the narrow keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import dense_numbers

BINS = 4096


def exact_quantiles(rows: DataFrame, column: str, shares: Sequence[str], bins: int = BINS) -> list[int | None]:
    """For each share (a decimal number as text) the smallest value that at least that share of the values does not exceed.

    The column holds whole numbers; nulls are left out, and without a value every quantile is None.  Each pass counts the
    values of each quantile's range in ``bins`` bins and goes on with the bin that holds the wanted rank; the driver gets
    one row per quantile and bin at most.  64-bit values need six passes with 4096 bins.
    """
    known = rows.where(F.col(column).isNotNull()).select(F.col(column).cast("long").alias("_v"))
    low, high, n = known.agg(F.min("_v"), F.max("_v"), F.count("_v")).head()
    if not n:
        return [None] * len(shares)
    # Rank of each, from 0, within its range of values (both ends included).
    open_ = {q: (max(-(-(Fraction(q) * n).numerator // (Fraction(q) * n).denominator), 1) - 1, low, high) for q in set(shares)}
    while any(lo < hi for _, lo, hi in open_.values()):
        ranges = sorted({(lo, hi) for _, lo, hi in open_.values() if lo < hi})
        cells = F.array(*[_cell(i, lo, hi, bins) for i, (lo, hi) in enumerate(ranges)])
        found = known.select(F.explode(F.filter(cells, lambda c: c.isNotNull())).alias("cell")).groupBy("cell").count()
        counts: dict[tuple[int, int], int] = {(r["cell"]["range"], r["cell"]["bin"]): r["count"] for r in found.collect()}
        for q, (rank, lo, hi) in open_.items():
            if lo < hi:
                i, width = ranges.index((lo, hi)), _width(lo, hi, bins)
                for b in sorted(b for r, b in counts if r == i):
                    if rank < counts[i, b]:
                        open_[q] = (rank, lo + b * width, min(lo + (b + 1) * width - 1, hi))
                        break
                    rank -= counts[i, b]
    return [open_[q][1] for q in shares]


def _width(low: int, high: int, bins: int) -> int:
    return -(-(high - low + 1) // bins)


def _cell(number: int, low: int, high: int, bins: int) -> Column:
    place = F.expr(f"CAST((CAST(_v AS DECIMAL(20,0)) - {low}) div {_width(low, high, bins)} AS INT)")
    return F.when(F.col("_v").between(low, high), F.struct(F.lit(number).alias("range"), place.alias("bin")))


def ntile(rows: DataFrame, order_by: Sequence[str], groups: int, name: str = "ntile") -> DataFrame:
    """The rows with the number of their group, from 1, in the order of a unique key; the first groups are the larger ones."""
    numbered = dense_numbers(rows, order_by, "_number", "ntile")
    n = numbered.count()
    small, larger = divmod(n, groups)
    before = larger * (small + 1)  # rows of the larger groups
    place = F.col("_number") - 1
    group = F.when(place < before, F.expr(f"(_number - 1) div {small + 1}")).otherwise(larger + F.expr(f"(_number - 1 - {before}) div {max(small, 1)}"))
    return numbered.withColumn(name, (group + 1).cast("int")).drop("_number")
