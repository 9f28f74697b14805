"""Sessions by inactivity gaps.

The events are sorted in ranges of visitor and time, so a visitor with any share of the events lies in several ranges
and no task holds more than one range of it.  Each range finds the sessions inside it; a session that goes on over a
border is stitched from one row per range and visitor.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import number_in_ranges
from tidemark.sources.scratch import materialise


def sessions(
    events: DataFrame,
    visitor: str,
    time: str,
    gap_seconds: int,
    sums: Mapping[str, Column] | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """One row per session: the visitor, ``session_start``, ``session_end``, ``events`` and the named sums.

    A new session begins when more than ``gap_seconds`` have passed since the visitor's event before.  ``spread_by``
    tells events of one visitor and time apart, so that ranges can cut between them.  Events without a visitor or a
    time belong to no session.
    """
    added = {"events": F.lit(1).cast("long")} | dict(sums or {})
    known = events.where(F.col(visitor).isNotNull() & F.col(time).isNotNull())
    rows = known.select(F.col(visitor).alias("_visitor"), F.col(time).alias("_at"), F.xxhash64(visitor, *spread_by).alias("_tie"), *[c.alias(n) for n, c in added.items()])
    placed, _ = materialise(number_in_ranges(rows, [F.col("_visitor"), F.col("_at"), F.col("_tie")]), "sessions")

    inside = Window.partitionBy("_slot", "_visitor").orderBy("_place")
    opens = F.coalesce(_after(F.lag("_at").over(inside), F.col("_at"), gap_seconds), F.lit(True))
    number = F.sum(F.col("_opens").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = (
        placed.withColumn("_opens", opens)
        .withColumn("_no", number)
        .groupBy("_slot", "_visitor", "_no")
        .agg(F.min("_at").alias("_start"), F.max("_at").alias("_end"), *[F.sum(n).alias(n) for n in added])
    )
    parts, _ = materialise(parts, "session-parts")
    heads = _heads(parts, gap_seconds)

    goes_on = (F.col("_no") == 1) & F.col("_head").isNotNull()
    whole = parts.join(heads, ["_slot", "_visitor"], "left").withColumn(
        "_session", F.when(goes_on, F.col("_head")).otherwise(F.struct(F.col("_slot").alias("slot"), F.col("_no").alias("no")))
    )
    found = whole.groupBy("_visitor", "_session").agg(
        F.min("_start").alias("session_start"), F.max("_end").alias("session_end"), *[F.sum(n).alias(n) for n in added]
    )
    return found.select(F.col("_visitor").alias(visitor), "session_start", "session_end", *added)


def _after(before: Column, at: Column, gap_seconds: int) -> Column:
    return F.unix_micros(at) - F.unix_micros(before) > gap_seconds * 1_000_000


def _heads(parts: DataFrame, gap_seconds: int) -> DataFrame:
    """(_slot, _visitor, _head): where the session that a range goes on with began, for ranges that go on with one.

    One row per range and visitor enters the window, so at most as many rows per visitor as there are ranges.
    """
    edges = parts.groupBy("_slot", "_visitor").agg(F.max("_no").alias("_n"), F.min("_start").alias("_first"), F.max("_end").alias("_last"))
    by_slot = Window.partitionBy("_visitor").orderBy("_slot")
    so_far = by_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    goes_on = F.coalesce(~_after(F.lag("_last").over(by_slot), F.col("_first"), gap_seconds), F.lit(False))
    edges = edges.withColumn("_goes_on", goes_on)
    # The last session of a range began there unless it is also the first one and came over the border.
    began = F.when(~F.col("_goes_on") | (F.col("_n") > 1), F.struct(F.col("_slot").alias("slot"), F.col("_n").alias("no")))
    edges = edges.withColumn("_began", F.last(began, ignorenulls=True).over(so_far))
    return edges.withColumn("_head", F.lag("_began").over(by_slot)).where("_goes_on").select("_slot", "_visitor", "_head")
