"""As-of join: to each row the version that was valid at its time.

Rows and versions are sorted together in ranges of key and time, and the last version before a row is carried along
the range; over a border it is carried by one row per range and key.  Nothing is paired, so the cost does not depend on
how many versions or rows a key has, and a key with any share of the rows lies in several ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import number_in_ranges
from tidemark.sources.scratch import materialise


def asof_join(rows: DataFrame, versions: DataFrame, key: str, time: str, valid_from: str, columns: Sequence[str]) -> DataFrame:
    """All ``rows`` with ``columns`` of the version of their key that has the latest ``valid_from`` not after ``time``.

    A row without a key or a time, or before the first version, gets nulls.  Of versions with one key and time the
    one with the greatest content counts.  ``columns`` must not occur among the rows.  Versions without a key or a
    time are not valid at any.
    """
    wanted = list(columns)
    kind = F.struct(*[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in wanted]).alias("_version")
    own = F.struct(*rows.columns)
    left = rows.select(F.col(key).alias("_key"), F.col(time).alias("_at"), F.lit(1).alias("_side"), F.xxhash64(*rows.columns).alias("_tie"), own.alias("_row"), F.when(F.lit(False), kind).alias("_version"))
    content = F.struct(*wanted)
    known = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    # One version per key and time, so a version sorts before the rows of its time and needs no order of its own.
    newest = known.groupBy(F.col(key).alias("_key"), F.col(valid_from).cast(rows.schema[time].dataType).alias("_at")).agg(F.max(content).alias("_version"))
    right = newest.select("_key", "_at", F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_tie"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), "_version")
    order = [F.col(c).asc_nulls_first() for c in ("_key", "_at", "_side", "_tie")]
    placed, _ = materialise(number_in_ranges(left.unionByName(right), order), "asof")

    along = Window.partitionBy("_slot", "_key").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.withColumn("_here", F.last("_version", ignorenulls=True).over(along)).where("_side = 1")
    # One row per range and key.
    ends = placed.groupBy("_slot", "_key").agg(F.max_by("_version", F.when(F.col("_side") == 0, F.col("_place"))).alias("_end"))
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_slot").alias("_c_slot"), F.col("_key").alias("_c_key"), F.last("_end", ignorenulls=True).over(before).alias("_carried")).where("_carried IS NOT NULL")
    joined = inside.join(carried, (F.col("_slot") == F.col("_c_slot")) & (F.col("_key") == F.col("_c_key")), "left")
    found = joined.select("_row", F.coalesce("_here", "_carried").alias("_found"))
    return found.select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in wanted])
