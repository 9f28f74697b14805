"""Exact duplicates by an extendible-hash index in shared files that holds every text.

Texts are equal when they are identical after white space is deleted.  A text's key is a 64-bit hash of what is
left.

1. *Directory.*  It starts with one bucket for all keys and doubles: a bucket with more than ``capacity`` keys is
   split by the next leading bit of the key, until every bucket fits or ``max_depth`` is reached.  The counts it
   works from are one row per cell of the finest directory (at most ``2 ** max_depth``), so its size is bounded.
2. *Bytes.*  All texts are grouped by key and text, which compares the bytes: copies are one row, different texts with
   one key stay apart.  Copies are folded in each task before the shuffle, so a group of any size sends one row per task.
3. *Index.*  Each different text, also one that occurs once, goes as (bucket, key, digest, row to keep, size) to the owner
   task of its bucket, that is of one range of keys.  The owner numbers the texts of one key as links of that key's
   chain and writes its rows in order.
4. *Lookup.*  A text's narrow entry goes to its key's bucket and follows the chain to the link with its digest
   (``Index.lookup``); the documents' own entries are looked up so.  Both sides come straight from a shuffle, so
   adaptive execution splits a hot key.

Of equal texts the row with the most code points in the original text, then the smallest id stays.  Only
DataFrame functions run; nothing but the bounded directory reaches the driver.

A null text counts as empty and all empty texts are equal.  A null id sorts last.  Of rows that repeat id and
text one stays.  An empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, stored

CAPACITY, MAX_DEPTH = 4096, 16
SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def directory(keys_per_cell: dict[int, int], capacity: int, max_depth: int) -> list[int]:
    """Bucket (its first cell) of every cell after doubling from one bucket on."""
    cells = 1 << max_depth
    sums = [0]
    for cell in range(cells):
        sums.append(sums[-1] + keys_per_cell.get(cell, 0))
    bucket, open_buckets = [0] * cells, [(0, cells)]
    while open_buckets:
        split = []
        for start, width in open_buckets:
            if width > 1 and sums[start + width] - sums[start] > capacity:
                split += [(start, width // 2), (start + width // 2, width // 2)]
            else:
                bucket[start : start + width] = [start] * width
        open_buckets = split
    return bucket


def _bucket(key: Column, cells: list[int], max_depth: int) -> Column:
    # One constant array in the plan; the bound of its size is max_depth.
    listed = F.from_json(F.lit(str(cells)), "array<int>")
    return F.element_at(listed, F.shiftrightunsigned(key, 64 - max_depth).cast("int") + 1)


def _entries(documents: DataFrame) -> DataFrame:
    text = normalised(F.col("text"))
    return documents.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(text).alias("key"),
        F.sha2(text, 256).alias("text_sha256"),
    )


@dataclass(frozen=True)
class Index:
    """``rows`` (bucket, key, link, text_sha256, keep_id, group_size; one row per different text) and the directory."""

    rows: DataFrame
    cells: list[int]
    max_depth: int

    def found(self, entries: DataFrame) -> DataFrame:
        """Entries (key, text_sha256 and others) with keep_id and group_size of their text, null where it is unknown."""
        known = self.rows.drop("link")
        return entries.withColumn("bucket", _bucket(F.col("key"), self.cells, self.max_depth)).join(known, ["bucket", "key", "text_sha256"], "left").drop("bucket")

    def lookup(self, texts: DataFrame, text: str = "text") -> DataFrame:
        """The rows of ``texts`` with ``keep_id`` and ``group_size`` of the indexed text that equals theirs, or nulls."""
        key, digest = fresh(texts, "_key"), fresh(texts, "_digest")
        content = normalised(F.col(text))
        asked = texts.withColumns({key: F.xxhash64(content), digest: F.sha2(content, 256)})
        pairs = asked.select(F.col(key).alias("key"), F.col(digest).alias("text_sha256")).distinct()
        met = self.found(pairs).select(F.col("key").alias(key), F.col("text_sha256").alias(digest), "keep_id", "group_size")
        kept = [c for c in texts.columns if c not in ("keep_id", "group_size")]
        return asked.select(*kept, key, digest).join(met, [key, digest]).select(*kept, "keep_id", "group_size")


def build_index(documents: DataFrame, entries: DataFrame | None = None, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> Index:
    """The index of all texts; ``entries`` are the documents' keys where they are stored already."""
    keys = (_entries(documents) if entries is None else entries).select("key")
    cells = keys.groupBy("key").count().groupBy(F.shiftrightunsigned("key", 64 - max_depth).cast("int").alias("cell")).agg(F.count("*").alias("keys"))
    layout = directory({r["cell"]: r["keys"] for r in cells.collect()}, capacity, max_depth)
    best = F.max(F.struct(F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"), _descending(), F.col("doc_id")))
    texts = (
        documents.select("doc_id", "text", normalised(F.col("text")).alias("content"))
        .withColumn("key", F.xxhash64("content"))
        .groupBy("key", "content")
        .agg(best.alias("best"), F.count("*").alias("group_size"))
        .select("key", F.sha2("content", 256).alias("text_sha256"), F.col("best.doc_id").alias("keep_id"), "group_size")
    )
    owned = texts.withColumn("bucket", _bucket(F.col("key"), layout, max_depth)).repartition("bucket")
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    return Index(stored(owned.withColumn("link", F.row_number().over(chain)), "dedup-index"), layout, max_depth)


def duplicates(documents: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, key."""
    entries = stored(_entries(documents), "dedup-entries")
    index = build_index(documents, entries, capacity, max_depth)
    # Rows that repeat an id and a text: the first of them stands for all.
    same = Window.partitionBy("doc_id", "key", "text_sha256").orderBy(F.col("chars").desc(), "row")
    looked_up = index.found(entries.withColumn("nth", F.row_number().over(same)))
    return looked_up.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
        "key",
    )


def _descending() -> Column:
    """Orders ids downwards without overflow; a null id comes after all others."""
    return F.coalesce(F.bitwise_not("doc_id"), F.lit(-(2**63)).cast("long")).alias("order")


def keep_one(documents: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns."""
    kept = duplicates(documents, capacity, max_depth).where("kept").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    keyed = documents.withColumn("__own_key", F.xxhash64(normalised(F.col("text"))))
    held = keyed.join(kept, keyed["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__own_key") == F.col("__key")), "left_semi")
    first = Window.partitionBy("doc_id", "__own_key").orderBy(F.length("text").desc_nulls_last())
    return held.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").select(documents.columns)
