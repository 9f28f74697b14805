"""Mixing sources to target weights by hierarchical budgets.

The leaves are (domain, lang, source).  A budget of tokens goes down the tree: each node shares its budget among
its children by weight, no child gets more than its subtree can give (tokens times ``max_epochs``), and what a
child cannot take goes to its siblings by their weights.  As a subtree's own limit is known before, a shortage
is made up inside the smallest family that can, and only the rest reaches the relatives of an ancestor.

A leaf with budget b and t tokens gives b // t whole epochs and of one more epoch the prefix nearest to the rest, in an
order that depends on the seed and the epoch.  The end of the prefix is found from sums over slices of the
order; only the slice it falls into is sorted, so a leaf that holds most rows is never in one task.  Texts are not
shuffled: what passes through shuffles is a hash and a count per document.

The budgets are worked out as tables, level by level: within a family, sums over members in the order of limit per
weight (members with the same are one row) give the level to which all are filled.  The driver gets the number of
leaves and of tokens.  The budget table has one row per leaf and is met by a broadcast up to ``BROADCAST_LEAVES`` rows,
beyond by a plain join.  Tokens are words (runs without white space).

Null domains, languages or sources are nodes of their own; a null text has no tokens and stays out unless its
leaf gives a whole epoch; rows that repeat id and text stand or go together; an empty table gives an empty result; extra
columns are carried along (``epoch``, ``tokens`` and ``domain`` are replaced).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.llm.common import stored

LEAF = ("domain", "lang", "source")
BROADCAST_LEAVES = 100_000
SLICE_ROWS, SLICE_BITS = 4096, 16
SEED = 17


def _equal(columns: Sequence[str]) -> Column:
    """Join condition on columns of the left side and their ``__`` twins of the right; nulls are equal."""
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns])


def _twins(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__{c}") for c in columns], *[c for c in df.columns if c not in columns])


def _without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[f"__{c}" for c in columns])


def _weighted(nodes: DataFrame, path: Sequence[str], weights: Mapping[tuple, float]) -> DataFrame:
    given = [(*p, float(w)) for p, w in weights.items() if len(p) == len(path)]
    if not given:
        return nodes.withColumn("weight", F.lit(1.0))
    schema = ", ".join(f"__{c} string" for c in path) + ", weight double"
    joined = nodes.join(nodes.sparkSession.createDataFrame(given, schema), _equal(path), "left")
    return _without(joined, path).withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def _levels(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Per family, and apart for members without weight: tokens per unit of weight that a member gets unless it holds less.

    Members are filled from the least limit per weight on; the level is what is left for a unit of weight of those that
    are not full, and null where all are.  Members without weight get what the others cannot take.
    """
    folded = nodes.groupBy(*parent, "idle", "ratio").agg(F.sum("limit").alias("held"), F.sum("unit").alias("units"), F.first("budget").alias("budget"))
    family, kind = Window.partitionBy(*parent), Window.partitionBy(*parent, "idle")
    earlier = kind.orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.when(~F.col("idle"), F.col("held"))).over(family), F.lit(0))
    filled = (
        folded.withColumn("to_share", F.when(F.col("idle"), F.greatest(F.lit(0.0), F.col("budget") - taken)).otherwise(F.col("budget")))
        .withColumn("held_before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
        .withColumn("units_left", F.sum("units").over(kind) - F.coalesce(F.sum("units").over(earlier), F.lit(0.0)))
        .withColumn("full", F.col("ratio") * F.col("units_left") <= F.col("to_share") - F.col("held_before"))
    )
    held = F.coalesce(F.sum(F.when(F.col("full"), F.col("held"))), F.lit(0))
    units = F.sum(F.when(~F.col("full"), F.col("units")))
    return filled.groupBy(*parent, "idle").agg((F.try_divide(F.first("to_share") - held, units)).alias("level"))


def leaf_budgets(leaves: DataFrame, total: float, weights: Mapping[tuple, float], max_epochs: int) -> DataFrame:
    """``leaves`` (a row per leaf with its ``tokens``) with ``budget``, its tokens of the total.

    ``weights`` is by path (a prefix of a leaf); a path without one weighs 1.
    """
    above = None
    for depth in range(1, len(LEAF) + 1):
        path, parent = LEAF[:depth], LEAF[: depth - 1]
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("limit"))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(float(total)))
        else:
            nodes = _without(nodes.join(_twins(above, parent), _equal(parent)), parent)
        idle = F.col("weight") <= 0
        unit = F.when(idle, 1.0).otherwise(F.col("weight"))
        nodes = _weighted(nodes, path, weights).withColumns({"idle": idle, "unit": unit, "ratio": F.col("limit") / unit})
        met = nodes.join(_twins(_levels(nodes, parent), (*parent, "idle")), _equal((*parent, "idle")))
        share = F.least(F.col("limit").cast("double"), F.col("level") * F.col("unit"))
        # Read by the next level's sums and by its nodes.
        above = stored(met.select(*path, share.alias("budget")), "mixing-budgets")
    found = above.select(*LEAF, F.floor(F.col("budget") + 1e-6).alias("budget"))
    return _without(leaves.join(_twins(found, LEAF), _equal(LEAF)), LEAF)


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(
    documents: DataFrame,
    domain: Column,
    weights: Mapping[tuple, float],
    share: float,
    max_epochs: int,
    seed: int = SEED,
) -> DataFrame:
    """The selected rows, once per epoch: the columns of ``documents`` with domain, tokens and epoch.

    ``share`` is the budget as a part of all tokens (it may be above 1 with several epochs).
    """
    # The given columns stay apart from the ones made here, whatever their names.
    named = documents.select(
        domain.alias("domain"), "lang", "source", F.xxhash64("doc_id", "text").alias("key"), _words(F.col("text")).alias("tokens"), F.struct("*").alias("row")
    )
    rows = stored(named.select(*LEAF, "key", "tokens"), "mixing-rows")
    leaves = stored(rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "mixing-leaves")
    everything = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.count("*").alias("leaves")).head()
    few = everything["leaves"] <= BROADCAST_LEAVES
    whole = F.when(F.col("tokens") > 0, F.least(F.lit(max_epochs), F.expr("budget div tokens"))).otherwise(0)
    slices_needed = F.expr(f"n div {SLICE_ROWS}")
    bits = F.when(slices_needed > 0, F.least(F.lit(SLICE_BITS), F.length(F.bin(slices_needed)))).otherwise(0)
    planned = leaf_budgets(leaves, share * everything["tokens"], weights, max_epochs).withColumn("whole", whole.cast("int"))
    plan = stored(planned.select(*LEAF, "whole", (F.col("budget") - F.col("whole") * F.col("tokens")).alias("rest"), bits.cast("int").alias("bits")), "mixing-plan")
    if few:
        plan = F.broadcast(plan)

    def with_plan(df: DataFrame, other: DataFrame) -> DataFrame:
        return _without(df.join(_twins(other, LEAF), _equal(LEAF)), LEAF)

    order = F.xxhash64(F.col("key"), F.lit(seed), F.col("whole"))
    # Shifting right keeps the sign, so slices are ordered as the hashes are.
    piece = F.expr("shiftright(place, 63 - bits)")
    placed = with_plan(rows, plan).where("rest > 0").withColumn("place", order).withColumn("slice", piece)
    slices = placed.groupBy(*LEAF, "slice").agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"))
    # At most 2 ** (SLICE_BITS + 1) rows per leaf.
    before = F.sum("sum").over(_window(LEAF, "slice")) - F.col("sum")
    ends = slices.withColumn("before", before).where("before <= rest AND before + sum > rest").select(*LEAF, "slice", "before")
    ends = stored(ends, "mixing-ends")
    in_end = with_plan(placed, F.broadcast(ends.withColumnRenamed("slice", "end")) if few else ends.withColumnRenamed("slice", "end"))
    cut = (
        in_end.where("slice = end")
        .groupBy(*LEAF, "place").agg(F.sum("tokens").alias("sum"), F.first("before").alias("before"), F.first("rest").alias("rest"))
        .withColumn("until", F.sum("sum").over(_window(LEAF, "place")) + F.col("before"))
        .where("until - sum / 2 <= rest")
        .groupBy(*LEAF).agg(F.max("place").alias("cut"))
    )
    # One row per leaf: rows of earlier slices are in, rows of the end slice up to the cut.
    ends_cut = _outer(ends, cut)
    schedule = stored(_outer(plan, ends_cut), "mixing-schedule")
    if few:
        schedule = F.broadcast(schedule)
    chosen = with_plan(named, schedule).withColumn("place", order).withColumn("slice", piece)
    # A leaf with a rest but no end slice holds nothing beyond it: that can only be a leaf without tokens.
    partial = (F.col("rest") > 0) & F.coalesce((F.col("slice") < F.col("end")) | ((F.col("slice") == F.col("end")) & (F.col("place") <= F.col("cut"))), F.lit(False))
    times = F.col("whole") + partial.cast("int")
    kept = [F.col("row")[c].alias(c) for c in documents.columns if c not in ("epoch", "tokens", "domain")]
    return (
        chosen.withColumn("times", times)
        .where("times > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
        .select(*kept, "domain", "tokens", "epoch")
    )


def _window(leaf: Sequence[str], by: str) -> WindowSpec:
    return Window.partitionBy(*leaf).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _outer(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the leaf, nulls equal; ``slice`` of the end is called ``end``."""
    named = right.withColumnRenamed("slice", "end")
    return _without(left.join(_twins(named, LEAF), _equal(LEAF), "left"), LEAF)
