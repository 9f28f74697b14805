"""Language identification by the nearest of several centroids per language.

A text is the TF-IDF vector of its hashed byte trigrams, scaled to length one.  The training vectors of each language
are clustered by spherical k-means, so one language may have several kinds of text; a document gets the language
of the centroid with the largest cosine.  A centroid rejects what lies farther from it than nearly all of its own
training texts: the language is still named, ``rejected`` says that it is doubtful.

The centroids are fitted on at most ``FIT_ROWS`` labelled documents (shared evenly among the languages, chosen by a
hash of the id); every document is classified.  Null and letterless texts are ``und`` with score 0.  Rows without
language or id teach nothing.  Without training rows all texts are ``und``.  Repeated rows are classified each;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import pieces
from tidemark.llm.features import collected, ngram_counts, unit

SIZE, WIDTH = 4096, 3
FIT_ROWS, CLUSTERS, STEPS = 4000, 4, 12
REJECT_QUANTILE = 0.002
UNKNOWN = "und"


@dataclass
class Centroids:
    names: list[str]
    of: np.ndarray
    vectors: np.ndarray
    idf: np.ndarray
    least: np.ndarray


def _counts(texts: list[bytes]) -> np.ndarray:
    return ngram_counts(texts, WIDTH, SIZE)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts) * idf)


def spherical_means(x: np.ndarray, k: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and the one each row belongs to; the first centroids lie far from one another."""
    chosen = [unit(x.mean(0, keepdims=True))[0]]
    nearest = x @ chosen[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(x[int(nearest.argmin())])
        nearest = np.maximum(nearest, x @ chosen[-1])
    centres = np.stack(chosen)
    for _ in range(steps):
        of = (x @ centres.T).argmax(1)
        held = np.unique(of)
        centres = unit(np.stack([x[of == c].mean(0) for c in held]))
    return centres, (x @ centres.T).argmax(1)


def fit(documents: DataFrame, training: Column | None = None, fit_rows: int = FIT_ROWS, clusters: int = CLUSTERS) -> Centroids | None:
    """Centroids from the rows with a language for which ``training`` (a condition on ``doc_id``) holds."""
    known = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if training is not None:
        known = known.where(training)
    languages = max(1, known.select("lang").distinct().count())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= max(8, fit_rows // languages))
    # Bounded by fit_rows.
    rows = documents.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids.select("doc_id", "lang")), "doc_id")
    counts, tags = collected(rows, _counts, "lang")
    if not tags:
        return None
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 0.1
    x = _weighted(counts, idf)
    names, of, vectors, least = sorted(set(tags)), [], [], []
    tags_ = np.array(tags)
    for i, name in enumerate(names):
        own = x[tags_ == name]
        centres, member = spherical_means(own, clusters)
        cosine = (own * centres[member]).sum(1)
        for c in range(len(centres)):
            of.append(i)
            vectors.append(centres[c])
            least.append(np.quantile(cosine[member == c], REJECT_QUANTILE) if (member == c).any() else 0.0)
    return Centroids(names, np.array(of), np.stack(vectors).astype(np.float32), idf, np.array(least))


def classify(documents: DataFrame, model: Centroids | None) -> DataFrame:
    """doc_id, lang_pred, score (cosine to the centroid), rejected."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, raw in pieces(texts):
                own = texts[first : first + len(raw)]
                lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in own]) & (m is not None)
                name, score, rejected = np.full(len(raw), UNKNOWN, object), np.zeros(len(raw)), np.zeros(len(raw), bool)
                if lettered.any():
                    cosine = _weighted(_counts(raw), m.idf) @ m.vectors.T
                    best = cosine.argmax(1)
                    top = np.clip(cosine[np.arange(len(raw)), best], 0, 1)
                    name[lettered] = np.array(m.names, object)[m.of[best]][lettered]
                    score[lettered] = top[lettered]
                    rejected = lettered & (top < m.least[best])
                ids = batch.column("doc_id").slice(first, len(raw))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(list(name), pa.string()), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
