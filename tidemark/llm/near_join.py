"""N-gram Jaccard join: MinHash bands propose, exact set comparison decides.

1. *Texts.*  Rows with one text are folded to one node (by digest), so copies never meet as pairs.
2. *Bands.*  Each node's set of five-word shingles gets ``trees`` signatures of MinHash values.  The length of the
   prefix that must agree is fixed before the data is read: ``depth`` values, shortened until the chance that two sets
   at the threshold agree in some signature reaches ``recall``.  No trie is built and no prefix is shortened by the data.
3. *Candidates.*  Nodes with one prefix are linked to its smallest node (a star, one edge per node and tree,
   never all pairs).  The connected components of these stars are the candidate groups.
4. *Verification.*  Small groups are gathered in bundles, larger ones cut into blocks of ``BLOCK`` nodes of which
   each two meet in one task.  A task counts the common shingles of its sets with array products and keeps per node
   the number of linked nodes and, for what hangs together, one edge per node.
5. *Classes.*  Components of the kept edges.

The result is exact for every pair within a candidate group.  Every link between different texts counts; copies
count as one text.  A group of n different near copies costs n * n / BLOCK rows of text in step 4; nothing is capped.

Words are what white space separates; a text of fewer than five words has one shingle of all its words, a text
without words (or null) is linked to nothing.  A null id is allowed, repeated rows are copies, extra columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import Words, mixed, pieces
from tidemark.llm.common import fresh, stored
from tidemark.llm.components import components
from tidemark.llm.tokens import let_go

WIDTH, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 30, 10, 0.999
BLOCK, BUNDLE = 256, 200


def matched_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Longest prefix at which pairs of the threshold's similarity are found with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _multipliers(count: int) -> np.ndarray:
    return (mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)).astype(np.uint32)


def signatures(texts: list[bytes], trees: int, depth: int, width: int = WIDTH) -> np.ndarray:
    """Per text and tree a hash of the first ``depth`` MinHash values; 0 where a text has no shingle."""
    out = np.zeros((len(texts), trees), np.int64)
    owner, shingles = Words(texts).shingles(width)
    if not len(owner):
        return out
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    there = owner[first]
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    multipliers = _multipliers(trees * depth)
    work = np.empty_like(low)
    for tree in range(trees):
        path = np.full(len(first), tree + 1, np.uint64)
        for level in range(depth):
            k = tree * depth + level
            np.multiply(low, multipliers[k], out=work)
            np.bitwise_xor(work, high, out=work)
            np.multiply(work, multipliers[-1 - k], out=work)
            path = mixed(path * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(work, first))
        out[there, tree] = path.view(np.int64)
    return out


def common_counts(owner: np.ndarray, shingles: np.ndarray, n: int) -> np.ndarray:
    """Number of common shingles of each two of ``n`` sets given as distinct (set, shingle) pairs."""
    order = np.argsort(shingles, kind="stable")
    owner, shingles = owner[order], shingles[order]
    start = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1]))) if len(shingles) else np.zeros(0, np.int64)
    held = np.diff(np.append(start, len(shingles)))
    counts = np.zeros(n * n, np.int64)
    for f in range(2, 9):  # rare shingles: their few pairs
        rows = start[held == f]
        members = [owner[rows + i] for i in range(f)]
        for i in range(f):
            for j in range(i):
                counts += np.bincount(members[j] * n + members[i], minlength=n * n) if len(rows) else 0
    counts = counts.reshape(n, n)
    counts += counts.T
    often = np.flatnonzero(held > 8)  # common shingles: products of 0/1 columns
    for at in range(0, len(often), 4096):
        chosen = often[at : at + 4096]
        column = np.repeat(np.arange(len(chosen)), held[chosen])
        rows = np.concatenate([owner[s : s + h] for s, h in zip(start[chosen], held[chosen], strict=True)])
        table = np.zeros((n, len(chosen)), np.float32)
        table[rows, column] = 1
        counts += (table @ table.T).astype(np.int64)
    np.fill_diagonal(counts, 0)
    return counts


def _verified(group: pd.DataFrame) -> pd.DataFrame:
    """Links and local component of each node of a bundle or of two blocks."""
    let_go()
    n = len(group)
    texts = [t.encode("utf-8", "surrogatepass") for t in group["text"]]
    owner, shingles = Words(texts).shingles(WIDTH)
    size = np.bincount(owner, minlength=n)
    common = common_counts(owner, shingles, n)
    linked = (common > 0) & (common * (1 + THRESHOLD) >= THRESHOLD * (size[:, None] + size[None, :]) - 1e-9)
    part = group["part"].to_numpy()
    linked &= group["candidate"].to_numpy()[:, None] == group["candidate"].to_numpy()[None, :]
    if group["bi"].iloc[0] != group["bj"].iloc[0]:
        linked &= part[:, None] != part[None, :]
    node = group["node"].to_numpy()
    root = node.copy()
    while True:
        least = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        after = np.minimum(root, least)
        if (after == root).all():
            break
        root = after
    return pd.DataFrame({"node": node, "links": linked.sum(1).astype("int64"), "root": root})


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _classes(documents: DataFrame, trees: int, depth: int, recall: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, same) of every row; (node, same, least_id, copies, component) of every text; (node, links)."""
    depth = matched_depth(THRESHOLD, trees, depth, recall)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for batch in batches:
            for first, texts in pieces(batch["text"]):
                rows = batch.iloc[first : first + len(texts)]
                paths = signatures(texts, trees, depth)
                yield pd.DataFrame({"doc_id": rows["doc_id"].array, "same": rows["same"].array, "paths": list(paths)})

    # A nullable id is carried as text: pandas would turn it into a float.
    inputs = documents.select(F.col("doc_id").cast("string").alias("doc_id"), _digest(F.col("text")).alias("same"), "text")
    signed = stored(
        inputs.mapInPandas(sign, "doc_id string, same binary, paths array<long>").withColumn("doc_id", F.col("doc_id").cast("long")), "join-signatures"
    )
    folded = signed.groupBy("same").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_id"), F.any_value("paths").alias("paths"))
    nodes = stored(folded.withColumn("node", F.monotonically_increasing_id()), "join-nodes")
    under = nodes.select("node", F.posexplode("paths").alias("tree", "prefix")).where("prefix != 0")
    stars = under.groupBy("tree", "prefix").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("tree", "prefix", "hub")
    edges = under.join(stars, ["tree", "prefix"]).where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    groups = components(edges)
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    placed = stored(groups.join(sizes, "component").join(nodes.select("node", "same"), "node"), "join-groups")
    bundles = max(1, placed.count() // BUNDLE)
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    small = F.col("size") <= BLOCK
    # Block i meets every block j: as the lower of the two or as the upper.
    keyed = (
        placed.withColumn("parts", parts)
        .withColumn("part", F.when(small, 0).otherwise(part))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(small, 0).otherwise(F.col("parts") - 1))))
        .select(
            "same", "node", F.col("component").alias("candidate"), "part",
            F.when(small, F.pmod(F.xxhash64("component"), F.lit(bundles))).otherwise(-1 - F.col("component")).alias("task"),
            F.least("part", "other").alias("bi"), F.greatest("part", "other").alias("bj"),
        )
    )
    texts = documents.select(_digest(F.col("text")).alias("same"), "text")
    wanted = placed.select("same")
    # Copies are folded here, before texts are dealt to their tasks.
    # The same join at every size: a broadcast that only small inputs get would hide what large ones move.
    chosen = texts.join(wanted.hint("merge"), "same", "left_semi").distinct()
    verified = stored(
        keyed.join(chosen, "same").drop("same").groupBy("task", "bi", "bj").applyInPandas(_verified, "node long, links long, root long"),
        "join-verified",
    )
    counted = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.where("root != node").select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "same", "least_id", "copies").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return signed.select("doc_id", "same"), named, counted


def links(documents: DataFrame, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, links, copies.

    ``class_id`` is the smallest id of the document's class (documents linked directly or through others),
    ``links`` the number of different other texts of at least the threshold's similarity, ``copies`` the number of
    documents with this very text.
    """
    rows, named, counted = _classes(documents, trees, depth, recall)
    least = named.groupBy("component").agg(F.min("least_id").alias("class_id"))
    result = named.join(least, "component").join(counted, "node", "left").select("same", "class_id", "copies", F.coalesce("links", F.lit(0).cast("long")).alias("links"))
    return rows.join(result, "same").select("doc_id", "class_id", "links", "copies")


def keep_one(documents: DataFrame, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """One row of each class: of the text with the smallest id (a missing id is greater than all), the row with that id.

    Rows are told apart by id and text, so a row that shares its id with one of another class stays or goes with its
    own text, and of rows that repeat id and text one stays.
    """
    _, named, _ = _classes(documents, trees, depth, recall)
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", "same")).alias("first")
    chosen = named.groupBy("component").agg(first).select("first.same")
    same, nth = fresh(documents, "_same"), fresh(documents, "_nth")
    held = documents.withColumn(same, _digest(F.col("text"))).join(chosen.withColumnRenamed("same", same), same, "left_semi")
    of_text = Window.partitionBy(same).orderBy(F.col("doc_id").asc_nulls_last())
    return held.withColumn(nth, F.row_number().over(of_text)).where(F.col(nth) == 1).select(documents.columns)
