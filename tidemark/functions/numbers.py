"""Money, averages, percentages and value bands.

Money is decimal from the silver layer on, so sums do not depend on the order of rows.  Averages are
``sum / count`` with the exact decimal sum converted once.  All layers use the same three types: amounts in cents, prices
and discounts with the digits they came with.  A value that is present but does not fit makes its row a rejected
one; it never turns into a null or a zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


AMOUNT, PRICE, DISCOUNT = "decimal(18,2)", "decimal(18,6)", "decimal(9,6)"


def money(column: Column | str, kind: str = AMOUNT) -> Column:
    """Decimal value; text that is no number and values that do not fit become null (see ``unfit``)."""
    value = F.col(column) if isinstance(column, str) else column
    return value.try_cast(kind)


def money_or_zero(column: str, kind: str = AMOUNT) -> Column:
    """Zero where the raw value is missing, and only there."""
    return F.when(F.col(column).isNull(), F.lit(0).cast(kind)).otherwise(money(column, kind))


def unfit(column: str, kind: str = AMOUNT) -> Column:
    """The raw value is there but is no value of the type."""
    return F.col(column).isNotNull() & money(column, kind).isNull()


def positive(column: str) -> Column:
    """Above zero by the raw value, whatever scale the stored value has; false for a missing one."""
    return F.coalesce(F.col(column).try_cast("double") > 0, F.lit(False))


def not_negative(column: str) -> Column:
    return F.coalesce(F.col(column).try_cast("double") >= 0, F.lit(False))


def average(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


def mean_of(column: str | Column) -> Column:
    """Average as an aggregate expression; nulls are left out of both parts."""
    value = F.col(column) if isinstance(column, str) else column
    return average(F.sum(value), F.count(value))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` to two places, null where the whole is zero or null.

    The ratio is taken to twelve places first: that absorbs the noise of binary division (so a true half
    rounds up) and is fine enough not to round twice.
    """
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
    return F.round(ratio.cast("decimal(34,12)"), 2).cast("decimal(18,2)")


def at_most(value: Column, steps: Sequence[tuple[object, object]], otherwise: object) -> Column:
    """First step whose limit is not below the value."""
    return _banded([(value <= F.lit(limit), out) for limit, out in steps], otherwise)


def below(value: Column, steps: Sequence[tuple[object, object]], otherwise: object) -> Column:
    """First step whose limit is above the value."""
    return _banded([(value < F.lit(limit), out) for limit, out in steps], otherwise)


def at_least(value: Column, steps: Sequence[tuple[object, object]], otherwise: object) -> Column:
    """First step whose limit the value reaches."""
    return _banded([(value >= F.lit(limit), out) for limit, out in steps], otherwise)


def _banded(cases: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    condition, out = cases[0]
    chain = F.when(condition, F.lit(out))
    for condition, out in cases[1:]:
        chain = chain.when(condition, F.lit(out))
    return chain.otherwise(F.lit(otherwise))
