"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a row of terms: hashed byte trigrams (case kept) with logarithmic weights, and as further terms the
shares of its words that repeat the word before or an earlier run of words, of its lines that repeat a line, of
capitals, symbols and of its few distinct words.  A truncated singular value decomposition of the labelled sample gives
the latent space.  The labelled vectors are broadcast (``2 * PER_CLASS`` rows of ``RANK`` numbers); every document's cosine to
each of them is computed exactly, block by block, and its ``NEIGHBOURS`` nearest vote with weights that grow with the
cosine.  The score is the share of the votes for label 1.

The sample holds at most ``PER_CLASS`` rows of each label, chosen by a hash of the id; every document is scored from its
whole text.  Null and empty texts are scored by the same rule (their vector is that of an empty text).  Null labels or ids teach
nothing.  Without labelled rows the score is 0.5.  Repeated rows are scored each, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import Words, pieces
from tidemark.llm.features import SPACED, collected, ngram_counts, unit

SIZE, WIDTH = 2048, 3
PER_CLASS, RANK, NEIGHBOURS, SHARPNESS = 1500, 48, 15, 8.0
SHAPE_WEIGHT = 1.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>!{}[]=\\^~_@"]] = True


@dataclass
class Space:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def shapes(texts: list[bytes]) -> np.ndarray:
    """Shares (0 to 1) that describe a text's form: its further terms."""
    n = len(texts)
    words = Words(texts)
    hashes = words.hashes()
    count = np.maximum(words.count, 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.owner[1:] == words.owner[:-1])
    at, run = words.windows(hashes, 3)
    order = np.lexsort((run, words.owner[at]))
    o, r = words.owner[at][order], run[order]
    again = np.zeros(len(o), bool)
    again[1:] = (o[1:] == o[:-1]) & (r[1:] == r[:-1])
    order = np.lexsort((hashes, words.owner))
    distinct = np.ones(len(hashes), bool)
    distinct[1:] = (words.owner[order][1:] != words.owner[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    kinds = np.bincount(words.owner[order][distinct], minlength=n)
    lines = np.array([1 - len(set(held)) / len(held) if (held := [x for x in t.split(b"\n") if x.strip()]) else 0.0 for t in texts])
    owner = np.repeat(np.arange(n), np.diff(words.text_start))
    size = np.maximum(np.diff(words.text_start) - 1, 1)
    capital = (words.buffer >= 65) & (words.buffer <= 90)
    out = np.column_stack(
        [
            np.bincount(words.owner[same], minlength=n) / count,
            np.bincount(o[again], minlength=n) / count,
            lines,
            np.bincount(owner[capital], minlength=n) / size * 1.2,
            np.minimum(1, 6 * np.bincount(owner[SYMBOLS[words.buffer]], minlength=n) / size),
            np.minimum(1, 1 - kinds / count ** 0.9) * (words.count >= 10),
            (words.count == 0),
        ]
    )
    return np.sqrt(np.clip(out, 0, 1)).astype(np.float32)


def terms(texts: list[bytes]) -> np.ndarray:
    return np.concatenate([np.log1p(ngram_counts(texts, WIDTH, SIZE, SPACED)), shapes(texts)], axis=1)


def _weighted(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.concatenate([unit(x[:, :SIZE] * idf), SHAPE_WEIGHT * x[:, SIZE:]], axis=1)


def fit(documents: DataFrame, labels: DataFrame, training: Column | None = None, per_class: int = PER_CLASS, rank: int = RANK) -> Space | None:
    """The latent space and the labelled vectors, from rows for which ``training`` (a condition on ``doc_id``) holds."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    if training is not None:
        marks = marks.where(training)
    order = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = marks.select("doc_id", F.col("quality").cast("int").alias("quality")).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_class)
    # Bounded by 2 * per_class.
    rows = documents.select("doc_id", "text").join(F.broadcast(ids.select("doc_id", "quality")), "doc_id")
    x, tags = collected(rows, terms, "quality")
    if not tags:
        return None
    idf = (np.log((1 + len(x)) / (1 + (x[:, :SIZE] > 0).sum(0))) + 0.1).astype(np.float32)
    x = _weighted(x, idf)
    # The right singular vectors, from the small side's product.
    values, basis = np.linalg.eigh(x.T @ x)
    basis = basis[:, ::-1][:, : min(rank, len(x))].astype(np.float32)
    return Space(idf, basis, unit(x @ basis).astype(np.float32), np.array(tags, np.float32))


def votes(vectors: np.ndarray, space: Space, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of the nearest neighbours' weighted votes for label 1."""
    cosine = vectors @ space.vectors.T
    k = min(neighbours, cosine.shape[1])
    nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.exp(SHARPNESS * (np.take_along_axis(cosine, nearest, 1) - 1))
    return (weight * space.labels[nearest]).sum(1) / weight.sum(1)


def score(documents: DataFrame, space: Space | None) -> DataFrame:
    """doc_id, score."""
    shipped = documents.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shipped.value
        for batch in batches:
            for first, texts in pieces(batch.column("text").to_pylist()):
                made = np.full(len(texts), 0.5) if s is None else votes(unit(_weighted(terms(texts), s.idf) @ s.basis), s)
                ids = batch.column("doc_id").slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.clip(made.astype(np.float64), 0, 1))], names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
