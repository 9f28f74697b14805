"""Phrase collocations by SON partitioning.

A phrase is a run of words inside a piece of a text; its support is the number of its occurrences in one language.
The corpus is cut into a few shards of documents.

1. *Local mining.*  Each shard is mined completely at the support lowered to its share of the language's words,
   ``ceil(support * words of the shard / words of the language)``.  A phrase below that in every shard has fewer
   than ``support`` occurrences in all, so none is lost.  Mining goes by length: a phrase can only be frequent in a
   shard if the two phrases one word shorter are.  A shard is a group of rows, not a task: tasks count its phrases
   piece by piece, and the counts of one range of hashes meet in one group.  The number of ranges grows with the text, so
   a group stays small.
2. *Union.*  Whatever is frequent in some shard is a candidate.
3. *Exact count.*  The whole corpus is read again and every candidate is counted by its words.

At most ``LANGUAGES`` languages have their lowered support at hand in the tasks; in the smaller ones every phrase is a
candidate.  Mining compares 64-bit hashes, and what it hands on are bit tables of a fixed size (``bitmaps.BITS``).  Both may add
candidates and cannot take any away; the counts come from step 3, which compares words.  At sizes where the tables
fill up more candidates are counted, with the same result.

Words are what blanks and tabs separate, A-Z in lower case; ``. , ; : ! ?`` and line ends separate pieces.  A null text
has no words, a null language counts as ``und``, repeated rows count each time, further columns are ignored, and an
empty table gives an empty result.  Ranks of equal score and count follow the phrase's bytes.  A very long text is read
whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import mixed, pieces
from tidemark.llm.bitmaps import BITS, bit_table, perhaps
from tidemark.llm.common import stored
from tidemark.llm.spans import LowerWords, bytes_of, hashes_of

SHARDS = 4
CHUNK_BYTES = 2 << 20
SLICE_ROWS = 600
#: Words of the corpus for each range of hashes of a shard; about 50 MB in the group at most.
RANGE_WORDS = 2_000_000
#: Rows that a task of the exact count holds before it adds them up.
HELD_ROWS = 400_000
LANGUAGES = 10_000
_BREAKS = bytes_of(".,;:!?\n\x0b\x0c\r")
_INSIDE = ~(_BREAKS | bytes_of(" \t"))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHARD_SHIFT = 20

_MINED = "lang string, shard int, part int, hashes binary, times binary, words long"
_COUNTED = "lang string, size int, phrase string, times long"


def _in_shard(hashes: np.ndarray, shard: np.ndarray) -> np.ndarray:
    return hashes ^ (shard.astype(np.uint64) << np.uint64(_SHARD_SHIFT))


class _Chunk:
    """Distinct (unit, word) pairs of some texts and the runs they form; a unit is a language and a shard."""

    def __init__(self, texts: list[bytes], langs: list[str], shards: list[int], exact: bool = False):
        words = LowerWords(texts, _INSIDE, _BREAKS)
        self.units = units = sorted(set(zip(langs, shards, strict=True)))
        unit_no = {u: i for i, u in enumerate(units)}
        unit = np.array([unit_no[u] for u in zip(langs, shards, strict=True)], np.int64)[words.owner]
        seed = hashes_of([u[0].encode() for u in units])[unit] if len(unit) else np.zeros(0, np.uint64)
        hashes = mixed(words.hashes() ^ seed) if len(unit) else seed
        if exact:  # words are told apart by their bytes, else by their hashes
            number, self.distinct = words.encoded()
            keys = number * len(units) + unit
        else:
            keys = (hashes + unit.astype(np.uint64) * _ODD).view(np.int64)
        self.ids, known = _encode(keys)
        self.hash, self.unit = np.zeros(len(known), np.uint64), np.zeros(len(known), np.int64)
        self.hash[self.ids], self.unit[self.ids] = hashes, unit
        self.word = known // max(len(units), 1)
        self.shard = np.array([u[1] for u in units], np.uint64)[self.unit] if len(known) else np.zeros(0, np.uint64)
        #: Places where the next word lies in the same piece.
        self.joined = words.piece[:-1] == words.piece[1:]

    def levels(self, tables: list[np.ndarray], size: int, by_shard: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length up to ``size``: (word numbers of each distinct run, its hash, its times).

        A run goes on to the next length only where the table of its own length may hold it.
        """
        ids, rows, hashes = self.ids, np.arange(len(self.hash))[:, None], self.hash
        at = np.arange(len(ids))
        for length in range(1, size + 1):
            times = np.bincount(ids, minlength=len(rows)) if len(rows) else np.zeros(0, np.int64)
            yield rows, hashes, times
            if length == size:
                return
            shard = self.shard[rows[:, 0]] if len(rows) else np.zeros(0, np.uint64)
            good = perhaps(tables[length - 1], _in_shard(hashes, shard) if by_shard else hashes)
            # Both runs one word shorter must be there: this one and the one that starts a word later.
            there = np.full(len(self.ids) + 1, -1, np.int64)
            there[at] = np.where(good[ids], ids, -1) if len(rows) else -1
            at = np.flatnonzero((there[:-2] >= 0) & (there[1:-1] >= 0) & self.joined) if len(self.ids) > 1 else np.zeros(0, np.int64)
            last = self.ids[at + length - 1 + 1] if len(at) else np.zeros(0, np.int64)
            ids, pairs = _encode(there[at] * max(len(self.hash), 1) + last)
            head, tail = pairs // max(len(self.hash), 1), pairs % max(len(self.hash), 1)
            hashes = mixed(hashes[head] * _ODD + self.hash[tail] + np.uint64(length)) if len(pairs) else np.zeros(0, np.uint64)
            rows = np.column_stack((rows[head], tail)) if len(pairs) else np.zeros((0, length + 1), np.int64)


def _encode(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key among the distinct keys, and the distinct keys."""
    found = pa.array(keys, pa.int64()).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_numpy(zero_copy_only=False)


def _chunks(batches: Iterable[pa.RecordBatch], exact: bool = False) -> Iterator[_Chunk]:
    for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
        langs, shards = batch.column("lang").to_pylist(), batch.column("shard").to_pylist()
        for first, texts in pieces(batch.column("text").to_pylist(), CHUNK_BYTES):
            yield _Chunk(texts, langs[first : first + len(texts)], shards[first : first + len(texts)], exact)


def _local_counts(rows: DataFrame, tables: list[np.ndarray], size: int, ranges: int) -> DataFrame:
    """Times of the runs of ``size`` words in each chunk: one row per language, shard and range of hashes.

    ``hashes`` are 64-bit and ``times`` 32-bit numbers, ``words`` is their sum.
    """
    shared = rows.sparkSession.sparkContext.broadcast(tables)
    names = [f.split()[0] for f in _MINED.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            *_, (runs, hashes, times) = chunk.levels(shared.value, size, by_shard=True)
            if not len(runs):
                continue
            group = chunk.unit[runs[:, 0]] * ranges + (hashes >> np.uint64(32)).astype(np.int64) % ranges
            order = np.argsort(group, kind="stable")
            group, hashes, times = group[order], hashes[order], times[order]
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            ends = np.append(first, len(group))
            units = [chunk.units[g] for g in (group[first] // ranges).tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([u[0] for u in units]),
                    pa.array([u[1] for u in units], pa.int32()),
                    pa.array((group[first] % ranges).astype(np.int32)),
                    _blobs(hashes, ends),
                    _blobs(times.astype(np.uint32), ends),
                    pa.array(np.add.reduceat(times, first)),
                ],
                names,
            )

    return rows.mapInArrow(run, _MINED)


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _frequent(counts: DataFrame, needed: dict[tuple[str, int], int]) -> DataFrame:
    """(phrase_hash, shard) of what reaches the lowered support of its shard."""
    shared = counts.sparkSession.sparkContext.broadcast(needed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        group: tuple | None = None
        for batch in batches:
            for lang, shard, part, hashes, times in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (lang, shard, part) != group:
                    if held:
                        yield added(group, held)
                    group, held = (lang, shard, part), []
                held.append((hashes, times))
        if held:
            yield added(group, held)

    def added(group: tuple, held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        hashes = np.frombuffer(b"".join(h for h, _ in held), np.uint64)
        times = np.frombuffer(b"".join(t for _, t in held), np.uint32).astype(np.int64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        good = np.add.reduceat(times[order], first) >= shared.value.get(group[:2], 1)
        found = hashes[first[good]]
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), group[1], np.int32))], ["phrase_hash", "shard"])

    key = ["lang", "shard", "part"]
    return counts.select(*key, "hashes", "times").repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "phrase_hash long, shard int")


def _count(rows: DataFrame, tables: list[np.ndarray], size: int) -> DataFrame:
    """Exact times of all runs that the tables may hold; rows: lang, size, phrase, times."""
    shared = rows.sparkSession.sparkContext.broadcast(tables)
    names = ["lang", "size", "phrase", "times"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for chunk in _chunks(batches, exact=True):
            words = pa.array([w.decode("utf-8", "replace") for w in chunk.distinct], pa.string())
            langs = pa.array([u[0] for u in chunk.units], pa.string())
            for length, (runs, hashes, times) in enumerate(chunk.levels(shared.value, size, by_shard=False), 1):
                keep = np.flatnonzero(perhaps(shared.value[length - 1], hashes))
                runs = runs[keep]
                parts = [words.take(pa.array(chunk.word[runs[:, i]])) for i in range(length)]
                phrase = parts[0] if length == 1 else pa.compute.binary_join_element_wise(*parts, " ")
                lang = langs.take(pa.array(chunk.unit[runs[:, 0]]))
                held.append(pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(keep), length, np.int32)), phrase, pa.array(times[keep], pa.int64())], names))
            if sum(map(len, held)) >= HELD_ROWS:
                yield from added(held)
                held = []
        if held:
            yield from added(held)

    def added(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(held).group_by(names[:3]).aggregate([("times", "sum")]).rename_columns(names)
        yield from found.combine_chunks().to_batches(max_chunksize=50_000)

    return rows.mapInArrow(run, _COUNTED).groupBy("lang", "size", "phrase").agg(F.sum("times").alias("times"))


def frequent_phrases(documents: DataFrame, support: int, max_words: int, shards: int = SHARDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, times) of every phrase with ``support`` occurrences, and (lang, n) with the words of each language."""
    text_shard = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(shards)).cast("int")
    rows = documents.where(F.col("text").isNotNull()).select(F.coalesce("lang", F.lit("und")).alias("lang"), text_shard.alias("shard"), "text")
    letters = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    ranges = 1 << max(int(letters / 6 / shards / RANGE_WORDS), 1).bit_length()
    local: list[np.ndarray] = []
    union: list[np.ndarray] = []
    needed: dict[tuple[str, int], int] = {}
    totals = None
    for size in range(1, max_words + 1):
        counts = _local_counts(rows, local, size, ranges)
        if size == 1:
            counts = stored(counts, "phrases-words")
            of_shard = counts.groupBy("lang", "shard").agg(F.sum("words").alias("words"))
            totals = stored(of_shard.groupBy("lang").agg(F.sum("words").alias("n")), "phrases-totals")
            large = totals.orderBy(F.desc("n"), "lang").limit(LANGUAGES)
            lowered = F.expr(f"({support} * words + n - 1) div n").alias("needed")
            needed = {(r["lang"], r["shard"]): r["needed"] for r in of_shard.join(large, "lang").select("lang", "shard", lowered).collect()}
        frequent = stored(_frequent(counts, needed), f"phrases-frequent-{size}")
        own = F.col("phrase_hash").bitwiseXOR(F.shiftleft(F.col("shard").cast("long"), _SHARD_SHIFT))
        local.append(bit_table(frequent, own, bits))
        union.append(bit_table(frequent, F.col("phrase_hash"), bits))
    counted = _count(rows.withColumn("shard", F.lit(0)), union, max_words).where(F.col("times") >= support)
    return stored(counted, "phrases-counted"), totals


def collocations(
    documents: DataFrame,
    support: int = 10,
    max_words: int = 3,
    first: int = 2000,
    covered_percent: int = 50,
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """The ``first`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Each phrase of two words or more is cut in two; ``a``, ``l`` and ``r`` are the times of the phrase and of the two
    parts, the score is ``floor(1000000 * a * a / (l * r))`` of the lowest cut, the first of equal ones.  A phrase
    inside a longer one that has ``covered_percent`` of its occurrences or more is left out.
    """
    counted, totals = frequent_phrases(documents, support, max_words, shards, bits)
    candidates = counted.where("size > 1").withColumnRenamed("times", "a")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumns(
        {"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - size)")}
    )
    parts = counted.select("lang", F.col("phrase"), "times")
    # Parts of a frequent phrase are frequent, so an inner join finds each.
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("times").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("times").alias("r")), ["lang", "right"])
    whole = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    # Both products as decimals of up to 38 digits, divided as integers.
    cuts = cuts.withColumns({"up": F.lit(1_000_000).cast("decimal(7,0)") * whole["a"] * whole["a"], "down": whole["l"] * whole["r"]})
    lowest = F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(lowest)

    inner = [
        F.struct(F.lit(width).alias("width"), F.lit(start).alias("start"))
        for width in range(2, max_words)
        for start in range(1, max_words - width + 2)
    ]
    kept = scored
    if inner:
        split = F.split("phrase", " ")
        inside = (
            candidates.where("size > 2")
            .withColumn("part", F.explode(F.array(*inner)))
            .where("part.width < size AND part.start + part.width - 1 <= size")
            .select("lang", F.array_join(F.slice(split, F.col("part.start"), F.col("part.width")), " ").alias("phrase"), "a")
        )
        longest = inside.groupBy("lang", "phrase").agg(F.max("a").alias("_inside"))
        kept = scored.join(longest, ["lang", "phrase"], "left").where(f"_inside IS NULL OR 100 * _inside < {covered_percent} * a").drop("_inside")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
