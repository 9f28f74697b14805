"""Toxicity: class-conditional Kneser-Ney models compared by length-normalised log-likelihood.

An expression is a word or its first five or four letters (lower case); a word's history is its own prefix, so
a rare inflection backs off to its stem and a rare stem to what all classes share.  As in Kneser-Ney smoothing
an expression is counted by the contexts it occurs in (distinct documents of distinct text), not by its
occurrences: neither a text that repeats a word nor a thousand copies of one text count as evidence.  In class c

    p_c(e) = max(n_c(e) - d(e), 0) / N_c  +  (1 - sum of the first part) * p_shared(e)

with p_shared from the counts of both classes.  The discount d(e) removes what the shared model already expects
of the class, its sampling noise and a constant, so rare expressions have the shared probability in both models
and add nothing to the comparison.  A document's figures are the mean log ratio per word and that mean times the
root of the number of words; a logistic curve turns them into a score.

The counts are Spark aggregations over all labelled texts.  The curve is fitted on scores of a bounded sample by a
calibration model, which counts all texts but that sample; the model that is returned counts the sample too.  The model holds every expression whose class count exceeds the discount.  It is
broadcast while its measured size is at most ``broadcast_bytes``; beyond that it stays a Spark table, and the distinct
words of the texts look their expressions up by joins before they are summed per text.  Log ratios are whole
multiples of 2^-30, so their sums are exact in any order and both ways give the same scores.

Nulls: a null text is an empty one; rows with a null label or id teach nothing; every row is scored.  Empty texts
and texts without words get the score of a zero ratio.  Repeated rows are scored each.  Without both classes in
the training rows the score is their share of toxic rows (0 without any).  Extra columns do no harm.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, fresh, logistic_fit, stored
from tidemark.llm.tokens import let_go
from tidemark.operators.joins import salted_lookup

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (5, 4)
DISCOUNT, DEVIATIONS = 0.75, 4.5
CALIBRATION_FOLDS, CALIBRATION_ROWS = 4, 20_000
BROADCAST_BYTES = 64 << 20
#: Memory of one expression in a worker besides its letters.
ENTRY_BYTES = 150
GRAIN = 2.0**30
TEXT_KEY = "_text_key"
#: Chunks and counted expressions that a worker holds at most, about 200 bytes each.
CACHE = 100_000
FLUSH = 100_000


@dataclass
class ToxicityModel:
    ratios: dict[str, float] = field(default_factory=dict)
    #: expression, ratio: in place of ``ratios`` where these are too many to broadcast
    table: DataFrame | None = None
    #: log ratio of the two shared parts, for expressions without evidence
    rest: float = 0.0
    weights: tuple[float, ...] | None = None
    prior: float = 0.0

    def probability(self, figures: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(figures), self.prior)
        w = np.asarray(self.weights)
        return 1 / (1 + np.exp(-np.clip(figures @ w[:-1] + w[-1], -30, 30)))


class _Chunks(dict):
    """Blank-separated chunk to log ratio of its words (real part) and their number (imaginary part)."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def __missing__(self, chunk: str) -> complex:
        ratios, rest = self.model.ratios, self.model.rest
        total, words = 0.0, WORD.findall(chunk)
        for word in words:
            found = ratios.get(word)
            for n in PREFIXES:
                if found is not None:
                    break
                found = ratios.get(word[:n])
            total += rest if found is None else found
        out = complex(total, len(words))
        if len(self) >= CACHE:
            self.clear()
        self[chunk] = out
        return out


def figures(texts: pd.Series, chunks: _Chunks) -> np.ndarray:
    """Mean log ratio per word, and the mean times the root of the number of words."""
    sums = [0j if t is None else sum(map(chunks.__getitem__, t.lower().split()), 0j) for t in texts]
    sums = np.asarray(sums, complex)
    return _of_sums(sums.real, sums.imag)


def _of_sums(ratios: np.ndarray, words: np.ndarray) -> np.ndarray:
    n = np.maximum(words, 1)
    return np.column_stack([ratios / n, ratios / np.sqrt(n)]) * [20.0, 1.0]


COUNTS = ("ordinary", "toxic", "sample_ordinary", "sample_toxic")


def _expressions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents that hold each expression, by class and apart for the sample, summed over a task's rows in parts."""
    let_go()
    counts = tuple(Counter() for _ in COUNTS)

    def part() -> pd.DataFrame:
        keys = list(set().union(*counts))
        out = pd.DataFrame({"expression": keys} | {name: [c[k] for k in keys] for name, c in zip(COUNTS, counts, strict=True)})
        for c in counts:
            c.clear()
        return out.astype(dict.fromkeys(COUNTS, "int64"))

    for batch in batches:
        for text, label, sampled in zip(batch["text"], batch["toxic"], batch["sampled"], strict=True):
            words = set(WORD.findall((text or "").lower()))
            held = words.union(*({w[:n] for w in words} for n in PREFIXES))
            count = counts[label + 2 * sampled]
            count.update(held)
            count[""] += len(words)
            if sum(map(len, counts)) > FLUSH:
                yield part()
    if any(counts):
        yield part()


def fit(documents: DataFrame, labels: DataFrame, training: Column | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> ToxicityModel:
    """Learn from the labelled rows for which ``training`` (a condition on ``doc_id``) holds; all without it."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    if training is not None:
        marks = marks.where(training)
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    hashed = documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("same"))
    # One row of equal texts, by ids and hashes only; then its text is fetched.
    chosen = hashed.join(marks, "doc_id").groupBy("same", "toxic").agg(F.min("doc_id").alias("doc_id"))
    texts = documents.select("doc_id", "text") if training is None else documents.where(training).select("doc_id", "text")
    rows = stored(
        texts.join(chosen.select("doc_id", "toxic"), "doc_id").withColumn(
            "fold", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("calibration")), F.lit(CALIBRATION_FOLDS))
        ),
        "toxicity-rows",
    )
    drawn = bounded(rows.where("fold = 0").select("doc_id"), F.col("doc_id"), CALIBRATION_ROWS)
    last = drawn.agg(F.max(F.xxhash64("doc_id"))).first()[0]
    sampled = (F.col("fold") == 0) & (F.xxhash64("doc_id") <= F.lit(last)) if last is not None else F.lit(False)
    counts = stored(
        rows.select("text", "toxic", sampled.alias("sampled")).mapInPandas(_expressions, "expression string, " + ", ".join(f"{c} long" for c in COUNTS))
        .groupBy("expression").agg(*[F.sum(c).alias(c) for c in COUNTS]),
        "toxicity-counts",
    )
    seen = rows.groupBy("toxic").count().collect()
    held = {r["toxic"]: r["count"] for r in seen}
    prior = held.get(1, 0) / max(1, sum(held.values()))
    model = _learnt(counts.select("expression", *[(F.col(c) + F.col(f"sample_{c}")).alias(c) for c in COUNTS[:2]]), prior, broadcast_bytes)
    before = _learnt(counts, prior, broadcast_bytes)
    if model is None or before is None:
        return ToxicityModel(prior=prior)
    calibration = _with_figures(rows.where(sampled), before).select("a", "b", "toxic").toPandas()
    y = calibration["toxic"].to_numpy(float)
    if len(y) and 0 < y.sum() < len(y):
        model.weights = tuple(logistic_fit(calibration[["a", "b"]].to_numpy(float), y, ridge=1e-2))
    return model


def _learnt(counts: DataFrame, prior: float, broadcast_bytes: int) -> ToxicityModel | None:
    """The model of these counts, without a curve; None where a class has no words."""
    total = counts.where("expression = ''").agg(F.sum("ordinary"), F.sum("toxic")).first()
    n = (float(total[0] or 0), float(total[1] or 0))
    if not (n[0] and n[1]):
        return None
    shared = (F.col("ordinary") + F.col("toxic")) / F.lit(n[0] + n[1])
    excess = []
    for name, size in (("ordinary", n[0]), ("toxic", n[1])):
        expected = shared * size
        excess.append(F.greatest(F.col(name) - expected - DISCOUNT - DEVIATIONS * F.sqrt(expected), F.lit(0.0)) / size)
    evidence = stored(
        counts.where("expression != ''")
        .select("expression", shared.alias("shared"), excess[0].alias("more_ordinary"), excess[1].alias("more_toxic"))
        .where("more_ordinary > 0 OR more_toxic > 0"),
        "toxicity-evidence",
    )
    measured = evidence.agg(
        F.sum("more_ordinary"), F.sum("more_toxic"), F.sum(F.octet_length("expression") + F.lit(ENTRY_BYTES))
    ).first()
    # A word lies on one level only (the longest with evidence), so the mass of a level is at most one.
    kept = [max(0.1, 1 - (mass or 0) / (1 + len(PREFIXES))) for mass in measured[:2]]
    p_ordinary = F.col("more_ordinary") + F.lit(kept[0]) * F.col("shared")
    p_toxic = F.col("more_toxic") + F.lit(kept[1]) * F.col("shared")
    table = evidence.select("expression", (F.rint(F.log(p_toxic / p_ordinary) * GRAIN) / GRAIN).alias("ratio"))
    model = ToxicityModel(rest=round(math.log(kept[1] / kept[0]) * GRAIN) / GRAIN, prior=prior)
    if (measured[2] or 0) <= broadcast_bytes:
        ratios = table.toPandas()
        model.ratios = dict(zip(ratios["expression"], ratios["ratio"].tolist(), strict=True))
    else:
        model.table = table
    return model


def _with_figures(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    if model.table is not None:
        keyed = rows.select("toxic", _text_key(F.col("text")).alias(TEXT_KEY))
        return keyed.join(_sums(rows, model), TEXT_KEY).mapInPandas(_figures_of_sums, "a double, b double, toxic int")
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        chunks = _Chunks(shipped.value)
        for batch in batches:
            out = figures(batch["text"], chunks)
            yield pd.DataFrame({"a": out[:, 0], "b": out[:, 1], "toxic": batch["toxic"].to_numpy()})

    return rows.select("text", "toxic").mapInPandas(run, "a double, b double, toxic int")


def _figures_of_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = _of_sums(batch["ratios"].to_numpy(float), batch["words"].to_numpy(float))
        yield pd.DataFrame({"a": out[:, 0], "b": out[:, 1], "toxic": batch["toxic"].to_numpy()})


def _text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _words_of_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct words of each text and how often it has them; the word '' for a text without words."""
    let_go()
    for batch in batches:
        for at in range(0, len(batch), 100):
            part = batch.iloc[at : at + 100]
            found = [(key, w, n) for key, text in zip(part[TEXT_KEY], part["text"], strict=True) for w, n in (Counter(WORD.findall((text or "").lower())) or {"": 0}).items()]
            yield pd.DataFrame(found, columns=[TEXT_KEY, "word", "times"])


def _sums(rows: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Text key, sum of log ratios and number of words of each distinct text, by joins with the model's table."""
    texts = rows.select(_text_key(F.col(text)).alias(TEXT_KEY), F.col(text).alias("text"))
    held = stored(
        # Equal texts share a key; their words are kept once.
        texts.mapInPandas(_words_of_texts, f"{TEXT_KEY} string, word string, times long").groupBy(TEXT_KEY, "word").agg(F.max("times").alias("times")),
        "toxicity-words",
    )
    levels = F.array(
        F.struct(F.lit(0).alias("level"), F.col("word").alias("expression")),
        *[F.struct(F.lit(i).alias("level"), F.substring("word", 1, n).alias("expression")) for i, n in enumerate(PREFIXES, 1)],
    )
    tried = held.select("word").distinct().select("word", F.inline(levels))
    ratios = tried.join(model.table, "expression").groupBy("word").agg(F.min_by("ratio", "level").alias("ratio"))
    # One row per word on the right; a common word's texts are spread over groups.
    met = salted_lookup(held, ratios, "word", [TEXT_KEY], "left")
    ratio = F.coalesce("ratio", F.lit(model.rest))
    return met.groupBy(TEXT_KEY).agg(F.sum(ratio * F.col("times")).alias("ratios"), F.sum("times").alias("words"))


def scored(documents: DataFrame, model: ToxicityModel, column: str = "score", text: str = "text") -> DataFrame:
    """The documents with the probability that their text is toxic, by broadcast or by joins as the model's size asks."""
    if model.table is None:
        return documents.withColumn(column, score_column(documents, model, text))
    sums, plain = _sums(documents, model, text), ToxicityModel(weights=model.weights, prior=model.prior)

    @F.pandas_udf("double")
    def probability(ratios: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series(plain.probability(_of_sums(ratios.to_numpy(float), words.to_numpy(float))))

    key, ratios, words = (fresh(documents, c) for c in (TEXT_KEY, "_ratios", "_words"))
    figures_of = sums.select(F.col(TEXT_KEY).alias(key), F.col("ratios").alias(ratios), F.col("words").alias(words))
    met = documents.withColumn(key, _text_key(F.col(text))).join(figures_of, key, "left")
    kept = [c for c in documents.columns if c != column]
    return met.select(*kept, probability(ratios, words).alias(column))


def score_column(documents: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """Probability that a row's text is toxic; the model travels by broadcast, once per executor."""
    if model.table is not None:
        raise ValueError("the model is too large to broadcast: use scored()")
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        chunks = _Chunks(shipped.value)
        for texts in batches:
            yield pd.Series(chunks.model.probability(figures(texts, chunks)))

    return toxicity(F.col(text))
