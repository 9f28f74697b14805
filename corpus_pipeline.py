"""Corpus preparation: toxicity, exact copies, near copies, source mixture, packing.

Each stage takes all rows its predecessor kept and, but for the last, returns the columns of ``documents``;
between stages the rows lie as Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, near_join, packing, toxicity
from tidemark.llm.common import fold_of, fresh, stored, table
from tidemark.llm.queries import MIXTURE, TOXIC_FROM, domain_of_source, word_tokenizer

#: Every document of the mixture is used once at most: its copies have just been removed.
MIXTURE_SHARE, MIXTURE_EPOCHS = 0.9, 1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go; labels of two thirds of the ids teach them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold_of(F.col("doc_id"), 3) != 1)
    score = fresh(docs, "_toxicity")
    return toxicity.scored(docs, model, score).where(F.col(score) < TOXIC_FROM).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents that share four fifths of their five-word shingles one stays."""
    return near_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, chosen by the weights of the domain-language-source tree."""
    mixed = mixing.mix(docs, domain_of_source(), MIXTURE, MIXTURE_SHARE, MIXTURE_EPOCHS)
    return mixed.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the Hilbert curve."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: The token ids of the last stage come from a tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
