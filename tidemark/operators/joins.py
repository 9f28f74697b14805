"""Lookups from facts to a dimension, and keys without a partner."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT, _HEAVY = "_salt", "_heavy_key"
DEFAULT_SALTS = 16
#: Keys that hold about one row in so many are heavy.
HEAVY_ONE_IN = 1000
_MERGERS = 64


def heavy_keys(keys: DataFrame, column: str, one_in: int = HEAVY_ONE_IN, name: str = _HEAVY) -> DataFrame:
    """At most ``2 * one_in`` keys, among them every key that holds more than two rows in ``one_in``; no null.

    Frequent-items sketches of bounded size are merged, in ``_MERGERS`` tasks and then in one: neither keys nor rows
    are shuffled.  A sketch of ``4 * one_in`` items errs by less than one row in ``2 * one_in``.
    """
    held = keys.select(F.col(column).alias("item"), F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("merger")).where("item IS NOT NULL")
    often = F.expr(f"approx_top_k(item, {2 * one_in}, {4 * one_in})")
    merged = held.groupBy("merger").agg(often.alias("top"), F.count(F.lit(1)).alias("rows"))
    # The number of all rows goes along as the count of no item.
    total = F.struct(F.lit(None).cast(held.schema["item"].dataType).alias("item"), F.col("rows").alias("count"))
    counted = merged.select(F.inline(F.concat("top", F.array(total))))
    summed = counted.groupBy("item").agg(F.sum("count").alias("n"), F.max(F.lit(0)).alias("all"))
    # The one row of all rows goes beside each item: no aggregate over all items in one task.
    whole = summed.where("item IS NULL").select("all", F.col("n").alias("rows"))
    often = summed.where("item IS NOT NULL").join(F.broadcast(whole), "all")
    return often.where(F.col("n") * one_in > F.col("rows")).select(F.col("item").alias(name))


def salted_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Join facts to a dimension that has one row per key, where one key may hold a large share of the facts.

    Facts of a heavy key (see ``heavy_keys``) or without a key are spread over ``salts`` groups by a hash of
    ``spread_by`` (columns that tell facts of one key apart), and the dimension rows of heavy keys are offered once
    to each group; all other rows are in one group and are copied nowhere.  Each fact meets its dimension row in
    exactly one group, so no result row is lost or doubled, whatever is taken for heavy.  ``keys`` is a cheaper frame
    with the facts' key column to find heavy keys in.  The list of heavy keys is broadcast: its length is bounded
    by the sketch.  Both inputs reach the join straight from a shuffle, which lets adaptive execution split a group
    further, or broadcast the dimension when its measured size is small.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported lookup type: {how}")
    heavy = F.broadcast(heavy_keys(facts if keys is None else keys, key))
    return _salted(facts, heavy, key, spread_by, salts).join(_offered(dimension, heavy, key, salts), [key, _SALT], how).drop(_SALT)


def folded_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    fold_by: str,
    aggregates: Sequence[Column],
    salts: int = DEFAULT_SALTS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Facts folded to one row per ``key`` and ``fold_by``, beside the dimension rows of their key (inner).

    The facts are dealt by key before the fold, so that the fold and the join need one shuffle of them, whatever size
    the dimension has.  Heavy keys are spread as in ``salted_lookup``, by ``fold_by``, which keeps a folded row in one group.
    """
    heavy = F.broadcast(heavy_keys(facts if keys is None else keys, key))
    dealt = _salted(facts.where(F.col(key).isNotNull()), heavy, key, [fold_by], salts).repartition(key, _SALT)
    folded = dealt.groupBy(key, _SALT, fold_by).agg(*aggregates)
    return folded.join(_offered(dimension, heavy, key, salts), [key, _SALT]).drop(_SALT)


def _salted(facts: DataFrame, heavy: DataFrame, key: str, spread_by: Sequence[str], salts: int) -> DataFrame:
    group = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    spread = F.col(_HEAVY).isNotNull() | F.col(key).isNull()
    return facts.join(heavy, F.col(key) == F.col(_HEAVY), "left").withColumn(_SALT, F.when(spread, group).otherwise(0)).drop(_HEAVY)


def _offered(dimension: DataFrame, heavy: DataFrame, key: str, salts: int) -> DataFrame:
    last = F.when(F.col(_HEAVY).isNotNull(), salts - 1).otherwise(0)
    return dimension.join(heavy, F.col(key) == F.col(_HEAVY), "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), last))).drop(_HEAVY)


def beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of ``right`` (one row per key) beside the rows of ``left``; null keys are equal."""
    own = right.select(*[F.col(c).alias(f"_b_{c}") for c in keys], *[c for c in right.columns if c not in keys])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in keys])
    return left.join(own, same, "left").drop(*[f"_b_{c}" for c in keys])


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def orphan_keys(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Distinct keys without a row in the reference table; a null key has no partner.

    Keys are made distinct first, so a hot key is one row when it reaches the join.
    """
    known = reference.select(F.col(reference_column).alias(column)).distinct()
    return distinct_keys(df, column).join(known, column, "left_anti")
