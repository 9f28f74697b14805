"""Hashed byte n-gram counts of whole texts, and vectors collected from a bounded sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.arrays import SPACE, mixed, pieces

#: Letters only: lower case (also the accented letters of Latin-1), all other ASCII characters to a blank.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[:65] = FOLDED[91:97] = FOLDED[123:128] = 32
FOLDED[0x80:0x9F] += 32
SPACED = np.arange(256, dtype=np.uint8)
SPACED[48:58] = 48
SPACED[SPACE] = 32


def ngram_counts(texts: list[bytes], width: int, size: int, fold: np.ndarray = FOLDED) -> np.ndarray:
    """(text, hash) counts of byte runs of ``width``; every text has a blank at both ends, runs of blanks count as one."""
    joined = fold[np.frombuffer(b" " + b"  ".join(texts) + b" ", np.uint8)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    owner = np.repeat(np.arange(len(texts)), lengths)
    again = np.zeros(len(joined), bool)
    again[1:] = (joined[1:] == 32) & (joined[:-1] == 32) & (owner[1:] == owner[:-1])
    joined, owner = joined[~again], owner[~again]
    n = len(joined) - width + 1
    if n <= 0:
        return np.zeros((len(texts), size), np.float32)
    gram = np.zeros(n, np.uint64)
    for i in range(width):
        gram = (gram << np.uint64(8)) | joined[i : i + n]
    inside = owner[:n] == owner[width - 1 :]
    cell = owner[:n][inside] * size + (mixed(gram[inside]) % np.uint64(size)).astype(np.int64)
    return np.bincount(cell, minlength=len(texts) * size).reshape(len(texts), size).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero."""
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def collected(rows: DataFrame, vectors: Callable[[list[bytes]], np.ndarray], tag: str) -> tuple[np.ndarray, list]:
    """Vectors and tags of a sample that the caller has bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = batch.column("tag")
            for first, texts in pieces(batch.column("text").to_pylist()):
                made = [v.tobytes() for v in vectors(texts).astype(np.float32)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), tags.slice(first, len(texts))], names=["vector", "tag"])

    kind = rows.schema[tag].dataType.simpleString()
    found = rows.selectExpr("text", f"`{tag}` AS tag").mapInArrow(run, f"vector binary, tag {kind}").collect()
    if not found:
        return np.zeros((0, 0), np.float32), []
    return np.stack([np.frombuffer(r["vector"], np.float32) for r in found]), [r["tag"] for r in found]
