"""What has changed between two states of a table, and the history of versions that such changes make."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.keyed import BUCKETS, keyed_exists, read_keyed, upsert_keyed
from tidemark.sources.scratch import materialise


def multiset_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that occur more often on one side: their columns and ``copies``, above zero where ``after`` has more.

    Copies are counted within each task first, so a row of any multiplicity is a few rows of the shuffle.  Nulls are
    equal to each other.
    """
    columns = before.columns
    both = before.withColumn("copies", F.lit(-1)).unionByName(after.select(columns).withColumn("copies", F.lit(1)))
    return both.groupBy(*columns).agg(F.sum("copies").alias("copies")).where("copies <> 0")


def table_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The difference with ``change``: ``updated`` rows belong to a key of both states (with the old content, copies
    below zero, and the new), ``inserted`` and ``deleted`` rows to a key of one state alone."""
    changed, _ = materialise(multiset_difference(before, after), "changes")
    keys = [side.select(F.col(key).alias("_key")).distinct() for side in (before, after)]
    touched = changed.select(F.col(key).alias("_key")).distinct()
    had, has = (touched.join(side, touched["_key"].eqNullSafe(side["_key"]), "left_semi").withColumn(n, F.lit(True)) for side, n in zip(keys, ("_had", "_has"), strict=True))
    known = had.withColumnRenamed("_key", "_h").join(has.withColumnRenamed("_key", "_n"), F.col("_h").eqNullSafe(F.col("_n")), "full_outer")
    same = changed[key].eqNullSafe(F.coalesce("_h", "_n"))
    what = F.when(F.col("_had").isNull(), "inserted").when(F.col("_has").isNull(), "deleted").otherwise("updated")
    return changed.join(known, same).select(*changed.columns, what.alias("change"))


def apply_to_history(
    changes: DataFrame, path: str, key: str, since: str, attributes: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Put a batch of changes into the versions at ``path`` and return all versions.

    A version has the key, ``valid_from``, ``valid_to`` (null while it is the newest) and the attributes.  A change closes
    the version of its time and opens one; a late change is inserted between the versions it lies between.  Of changes of
    one key and time the newer batch counts, inside a batch the greatest content.  A change that repeats the content
    before it is no version, but is stored (``is_version`` false): a later batch may put another content between.  Only
    the buckets of the batch's keys are rewritten, and a repeated batch changes nothing.
    """
    spark, content = changes.sparkSession, [F.col(a) for a in attributes]
    own = changes.where(F.col(key).isNotNull() & F.col(since).isNotNull())
    new = own.groupBy(key, F.col(since).alias("valid_from")).agg(F.max(F.struct(*content)).alias("_content"))
    staged, _ = materialise(new, "history-changes")
    known = staged.withColumn("_batch", F.lit(1))
    if keyed_exists(spark, path):
        held = read_keyed(spark, path).join(staged.select(key).distinct(), key, "left_semi")
        known = known.unionByName(held.select(key, "valid_from", F.struct(*content).alias("_content"), F.lit(0).alias("_batch")))
    times = known.groupBy(key, "valid_from").agg(F.max_by("_content", "_batch").alias("_content"))
    # All changes of one key come together: as many as it has had.
    in_time = Window.partitionBy(key).orderBy("valid_from")
    told = times.withColumn("_before", F.lag("_content").over(in_time)).withColumn("is_version", F.expr("_before IS NULL OR NOT (_content <=> _before)"))
    next_version = F.min(F.when(F.col("is_version"), F.col("valid_from"))).over(in_time.rowsBetween(1, Window.unboundedFollowing))
    versions = told.select(key, "valid_from", F.when(F.col("is_version"), next_version).alias("valid_to"), "_content.*", "is_version")
    upsert_keyed(versions, path, key, replaces=staged.select(key), buckets=buckets)
    return read_keyed(spark, path).where("is_version").drop("is_version")
