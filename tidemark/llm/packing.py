"""Packing along a space-filling curve.

1. Each text becomes token ids; its hashed bag of tokens is projected to ``DIMENSIONS`` numbers by a seeded
   random table.  The ids are written to the shared folder once, 16 or 32 bits each.
2. The projections are brought to the unit cube by their mean and deviation over all documents, and a
   document's place is its Hilbert key, so neighbours along the curve use similar words.
3. The keys (not the texts) are sorted by range.  Sums per range give every document its start in one
   gapless stream of all ids; sequences are cut from the stream every ``length`` ids.  A document may be cut, a
   sequence holds neighbours, and only the last sequence of all can need padding.
4. Ids meet their start by the row's number, and each task cuts its documents into pieces.

No step sees more than one document at a time whole; the driver gets one row of sums.  A null text is empty (one
piece of the end id); a null id and repeated rows are packed like any row; extra columns are ignored; an
empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.tokens import chunk_ids

LENGTH, END_ID = 2048, 1
DIMENSIONS, BITS = 4, 12
SEED = 7
PIECE_CHARS = 1 << 20


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of integer points (n, d) with ``bits`` bits each (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations of all levels
        low = bit - 1
        for i in range(d):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, d):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn = np.where((x[d - 1] & bit) != 0, turn ^ (bit - 1), turn)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _chunked(texts: list[str]) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= PIECE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _tokenised(documents: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, ids (binary, little-endian 32 bits), n, projection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_ids(path, end_id)
        table = np.random.default_rng(SEED).standard_normal((encoder.tokenizer.get_vocab_size() + 1, DIMENSIONS), np.float32)
        for batch in batches:
            done = 0
            for texts in _chunked([t or "" for t in batch.column("text").to_pylist()]):
                ids, counts = encoder.encode(texts)
                starts = np.cumsum(counts) - counts
                sums = np.add.reduceat(table[ids], starts) / np.sqrt(counts)[:, None]
                narrow = ids.astype("<u2") if encoder.tokenizer.get_vocab_size() <= 1 << 16 else ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(done, len(texts)),
                        pa.array([narrow[s : s + c].tobytes() for s, c in zip(starts, counts, strict=True)], pa.binary()),
                        pa.array(counts, pa.int64()),
                        pa.array(list(sums.astype(np.float64)), pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "ids", "n", "projection"],
                )
                done += len(texts)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, n long, projection array<double>")


def _placed(tokenised: DataFrame) -> DataFrame:
    """row, n, key: the Hilbert key of each document, in the cube that mean and deviation of all documents span."""
    axes = [F.col("projection")[i] for i in range(DIMENSIONS)]
    spread = tokenised.agg(*[F.avg(a) for a in axes], *[F.stddev_pop(a) for a in axes]).first()
    mean = np.array([v or 0.0 for v in spread[:DIMENSIONS]])
    deviation = np.array([v or 1.0 for v in spread[DIMENSIONS:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("projection").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            unit = 1 / (1 + np.exp(-1.702 * np.clip((flat - mean) / deviation, -20, 20)))  # close to the normal distribution function
            points = np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n"), pa.array(hilbert_keys(points))], names=["row", "n", "key"])

    return tokenised.select("row", "n", "projection").mapInArrow(run, "row long, n long, key long")


def _starts(placed: DataFrame) -> DataFrame:
    """row, start: where each document begins in the stream of all ids along the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            ends = before + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.full(len(n), part)), pa.array(ends - n), batch.column("n")], names=["row", "part", "local", "n"]
            )
            before = int(ends[-1]) if len(ends) else before

    sorted_ = placed.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    local = stored(sorted_.mapInArrow(run, "row long, part long, local long, n long"), "packing-order")
    sums = local.groupBy("part").agg(F.sum("n").alias("sum"))
    # One row per range of the sort.
    earlier = F.coalesce(F.sum("sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("part", earlier.alias("earlier"))
    return local.join(F.broadcast(offsets), "part").select("row", (F.col("earlier") + F.col("local")).alias("start_all"))


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids."""
    tokenised = stored(_tokenised(documents, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id()), "packing-ids")
    starts = _starts(_placed(tokenised))
    kind = documents.schema["doc_id"].dataType.simpleString()
    narrow = _id_width(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, first = batch.column("n").to_numpy(), batch.column("start_all").to_numpy()
            pieces = (first + n - 1) // length - first // length + 1
            of = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[of] // length + nth
            begin = np.maximum(sequence * length - first[of], 0)
            end = np.minimum((sequence + 1) * length - first[of], n[of])
            held = batch.column("ids")
            ids, at, crc, cut = None, -1, np.empty(len(of), np.int64), []
            for k, (doc, b, e) in enumerate(zip(of.tolist(), begin.tolist(), end.tolist(), strict=True)):
                if doc != at:
                    ids, at = np.frombuffer(held[doc].as_buffer(), narrow).astype("<u4"), doc
                crc[k] = zlib.crc32(ids[b:e])
                if with_ids:
                    cut.append(ids[b:e].astype(np.int32))
            columns = [
                batch.column("doc_id").take(pa.array(of)), pa.array(begin), pa.array(end - begin), pa.array(crc), pa.array(n[of]),
                pa.array(sequence), pa.array(first[of] + begin - sequence * length),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array(cut, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    # The same join at every size: a broadcast that only small inputs get would hide what large ones move.
    joined = tokenised.select("doc_id", "ids", "n", "row").join(starts.hint("merge"), "row").select("doc_id", "ids", "n", "start_all")
    return joined.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def _id_width(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def padded_length(used: Column, length: int = LENGTH) -> Column:
    """A sequence is padded to ``length``, except where it already is as long as a power of two."""
    power = (used > 0) & (used.bitwiseAND(used - 1) == 0)
    return F.when(power, used).otherwise(F.lit(length))


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """sequence_id, used, ids (padded) from pieces with ids; a group holds at most ``length`` ids."""
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    padding = F.array_repeat(F.lit(pad_id), (padded_length(F.col("used"), length) - F.col("used")).cast("int"))
    return whole.select("sequence_id", "used", F.concat(ids, padding).alias("ids"))
