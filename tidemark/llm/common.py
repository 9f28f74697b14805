"""Small helpers that several of these operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as files in the shared folder: written once, read as often as needed, safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal digits modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def bounded(df: DataFrame, by: Column, rows: int) -> DataFrame:
    """The ``rows`` first rows in the order of a hash: a repeatable sample whose size does not follow the input."""
    return df.orderBy(F.xxhash64(by), by).limit(rows)


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + penalty @ w
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + penalty, gradient)
        w -= step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return w
