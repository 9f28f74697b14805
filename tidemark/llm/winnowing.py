"""Benchmark decontamination by winnowing.

Words are lower-cased.  A window is ``window`` consecutive words of a benchmark item; an item of fewer words is one
window of its own length.  A document word inside any occurrence of a window is hit.

1. *Fingerprints.*  All k-grams of words are hashed; of every ``window - k + 1`` consecutive ones the least, and of
   equal ones the last, is selected.  Two texts that share a window select the same k-gram hash inside it, so every
   shared span of ``window`` words or more has a fingerprint in common.  Shorter items are winnowed by their own length.
2. *Meeting.*  The benchmark's fingerprints are a bit table of a fixed size (``bitmaps.BITS``); a document's selected
   k-grams that it does not hold are dropped in the task that reads the text.
3. *Extension.*  A k-gram that is left is extended to the windows that selected it, and those meet the distinct benchmark
   windows in a join on fingerprint and words.  Equal words decide, so neither the table nor the hashes can add a hit; a
   place of a document matches one distinct window at most, so frequent windows give no pairs.
4. *Spans and items.*  The union of a document's spans gives its hit words; its distinct windows, joined with the items
   that hold them, its items.

A null text has no words.  Every row of ``documents`` gives one row, also where ids repeat or are null.  A benchmark row
without an id marks words but is no item in the list; rows with one id are one item.  Without benchmark rows, nothing is
hit.  Further columns are ignored.  Repeated rows and ties of hashes change nothing.  A very long text is read whole by
one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import mixed, pieces
from tidemark.llm.bitmaps import BITS, bit_table, perhaps
from tidemark.llm.common import stored
from tidemark.llm.spans import LowerWords, bytes_of

WINDOW, K = 10, 5
_INSIDE = bytes_of("0123456789abcdefghijklmnopqrstuvwxyz")
_INSIDE[128:] = True


class _Text:
    """Texts laid end to end with their words, one blank between two words."""

    def __init__(self, texts: list[bytes]):
        self.words = LowerWords(texts, _INSIDE)
        lengths = self.words.end - self.words.start
        self.end = np.cumsum(lengths + 1)
        self.start = self.end - lengths - 1
        flat = np.full(int(self.end[-1]) if len(lengths) else 0, 0x20, np.uint8)
        gap = np.ones(len(flat), bool)
        gap[self.end - 1] = False
        flat[gap] = self.words.buffer[self.words.inner]
        self.flat = flat
        self.hashes = self.words.hashes()

    def selected(self, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, place of the k-gram it selects, that k-gram's hash) of every window."""
        grams = self.words.windows(self.hashes, k)
        hashes = np.zeros(len(self.hashes), np.uint64)
        hashes[grams[0]] = mixed(grams[1] + np.uint64(window))
        total = len(hashes) - window + 1
        if total <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.words.owner[:total] == self.words.owner[window - 1 :])
        place, least = at.copy(), hashes[at]
        for step in range(1, window - k + 1):
            later = hashes[at + step]
            better = later <= least
            place[better], least[better] = at[better] + step, later[better]
        return at, place, least

    def said(self, at: np.ndarray, window: int) -> pa.Array:
        """The words of the windows that start at ``at``."""
        lengths = self.end[at + window - 1] - 1 - self.start[at]
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        source = np.arange(offsets[-1]) + np.repeat(self.start[at] - offsets[:-1], lengths)
        data = self.flat[source]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


_ITEM_WINDOWS = "item_id string, size int, fingerprint long, words binary"


def _item_windows(benchmark: DataFrame, window: int, k: int) -> DataFrame:
    """All windows of all items with the fingerprint each selects."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id")
            for first, texts in pieces(batch.column("text").to_pylist()):
                text = _Text(texts)
                for size in range(1, window + 1):
                    at, _, hashes = text.selected(size, min(k, size))
                    if size < window:  # only of items that have no more words
                        whole = text.words.count[text.words.owner[at]] == size
                        at, hashes = at[whole], hashes[whole]
                    if len(at):
                        owner = pa.array(text.words.owner[at] + first)
                        sizes = pa.array(np.full(len(at), size, np.int32))
                        yield pa.RecordBatch.from_arrays([ids.take(owner), sizes, pa.array(hashes.view(np.int64)), text.said(at, size)], ["item_id", "size", "fingerprint", "words"])

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(run, _ITEM_WINDOWS)


_FOUND = "document long, doc_id long, n_words long, start long, size int, fingerprint long, words binary"


def _document_windows(documents: DataFrame, table: np.ndarray, sizes: list[int], k: int) -> DataFrame:
    """One row per document (size null), and one per window whose fingerprint the benchmark may have."""
    shared = documents.sparkSession.sparkContext.broadcast(table)
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column("document"), batch.column("doc_id")
            for first, texts in pieces(batch.column("text").to_pylist()):
                n = len(texts)
                text = _Text(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, n), ids.slice(first, n), pa.array(text.words.count.astype(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                    names,
                )
                for size in sizes:
                    at, _, hashes = text.selected(size, min(k, size))
                    found = np.flatnonzero(perhaps(shared.value, hashes))
                    if not len(found):
                        continue
                    at, hashes = at[found], hashes[found]
                    owner = text.words.owner[at]
                    m = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [rows.take(pa.array(owner + first)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(at - text.words.first[owner]), pa.array(np.full(m, size, np.int32)), pa.array(hashes.view(np.int64)), text.said(at, size)],
                        names,
                    )

    return documents.mapInArrow(run, _FOUND)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(document, doc_id, n_words) of every row, and (document, start, size, window, items follow by ``window``) of every hit.

    Returns the frames ``rows`` (document, doc_id, n_words), ``spans`` (document, start, size, window) and ``items``
    (window, item_id); ``document`` numbers the rows of the table.
    """
    items = stored(_item_windows(benchmark, window, k), "winnow-items")
    windows = items.select("size", "fingerprint", "words").distinct().withColumn("window", F.monotonically_increasing_id())
    windows = stored(windows, "winnow-windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # ``window`` numbers at most
    table = bit_table(windows, F.col("fingerprint"), bits)
    numbered = documents.select(F.monotonically_increasing_id().alias("document"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(_document_windows(numbered, table, sizes, k), "winnow-found")
    rows = found.where("size IS NULL").select("document", "doc_id", "n_words")
    key = ["size", "fingerprint", "words"]
    spans = found.where("size IS NOT NULL").select("document", "start", *key).join(windows, key).select("document", "start", "size", "window")
    held = items.where("item_id IS NOT NULL").join(windows, key).select("window", "item_id").distinct()
    return rows, stored(spans, "winnow-spans"), held


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated."""
    rows, spans, held = contamination(documents, benchmark, window, k, bits)
    # Words that a span adds behind all earlier spans of its document.
    before = Window.partitionBy("document").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = spans.select("document", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    reached = reached.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = reached.groupBy("document").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "done"))).alias("n_hit"))
    of_document = spans.select("document", "window").distinct().join(held, "window").groupBy("document")
    listed = of_document.agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    nothing = F.array().cast("array<string>")
    return (
        rows.join(hit, "document", "left")
        .join(listed, "document", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", nothing).alias("item_ids"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
