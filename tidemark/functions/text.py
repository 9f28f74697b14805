"""Text clean-up and relabelling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what counts as an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def tidy(column: Column | str) -> Column:
    """Lower-case without surrounding blanks; null stays null."""
    return F.trim(F.lower(F.col(column) if isinstance(column, str) else column))


def standardize_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Tidy the named columns; names the frame does not have are skipped."""
    present = set(df.columns)
    return df.withColumns({c: tidy(c) for c in columns if c in present})


def is_email(column: str) -> Column:
    """Null stays null, everything else is a yes or no."""
    return F.col(column).rlike(EMAIL_PATTERN)


def relabel(value: Column, labels: Mapping[str, Iterable[str]], otherwise: Column) -> Column:
    """Replace each listed synonym by its label.  A null value is no synonym and takes ``otherwise``."""
    result: Column | None = None
    for label, synonyms in labels.items():
        hit = value.isin(*synonyms)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return otherwise if result is None else result.otherwise(otherwise)


def or_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit("unknown"))
