"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation learns how far to trust each.

Every text gets counts; rules turn them into votes for (2) or against (1) quality, or abstain (0).  A rule looks at one
measure alone and votes both ways: against where the measure is bad, for where it is plainly good, not at all between.
The votes of all documents are counted by pattern (at most ``3 ** len(rules())`` rows, whatever the corpus); on these
counts a two-class model with independent rules is fitted by expectation-maximisation.  Its posterior probability of
quality decides, so one failed rule does not reject a document that the others vouch for.  Base conditions (too few words,
too many repeated words) come first.

A null text has no words.  Every row is counted and judged, repeated rows each; null ids pass through; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Words, pieces
from tidemark.llm.common import stored

WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_kinds", "n_letters", "n_capitals", "n_marks", "n_marked_words")
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
#: ASCII characters that are neither letters nor digits, spaces or control characters.
MARK = np.zeros(256, bool)
MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
#: Where the estimate starts: chances to abstain, to vote against and to vote for, in bad and in good texts.  A vote
#: against is rare in good texts; bad texts have some faults and not all, so a vote for says little.
START = ((0.18, 0.32, 0.5), (0.18, 0.02, 0.8))
PRIOR, ROUNDS, SMOOTHING = 0.85, 200, 1.0
KEEP_FROM = 0.5


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    n = len(texts)
    words = Words(texts)
    hashes = words.hashes()
    owner_of_byte = np.repeat(np.arange(n), np.diff(words.text_start))
    starts_point = (words.buffer & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(starts_point)))
    at, run = words.windows(hashes, WINDOW)
    owner = words.owner[at]
    order = np.lexsort((run, owner))
    same = (run[order][1:] == run[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    found = np.zeros(len(at), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[found], 1)
    np.add.at(cover, at[found] + WINDOW, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    order = np.lexsort((hashes, words.owner))
    kind = np.ones(len(hashes), bool)
    kind[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.owner[order][1:] != words.owner[order][:-1])
    lines = [[x for x in t.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")] for t in texts]
    letter = words.buffer | 0x20
    letter = (letter >= 97) & (letter <= 122)
    capital = letter & (words.buffer < 97)
    symbols = np.concatenate(([0], np.cumsum(SYMBOL[words.buffer])))
    marked = symbols[words.end] > symbols[words.start]
    count = lambda chosen: np.bincount(owner_of_byte[chosen], minlength=n)
    return {
        "n_words": words.count,
        "word_chars": np.bincount(words.owner, points[words.end] - points[words.start], n).astype(np.int64),
        "n_symbols": count(SYMBOL[words.buffer]),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": np.bincount(words.owner[repeated], minlength=n),
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_kinds": np.bincount(words.owner[order][kind], minlength=n),
        "n_letters": count(letter),
        "n_capitals": count(capital),
        "n_marks": count(MARK[words.buffer]),
        "n_marked_words": np.bincount(words.owner[marked], minlength=n),
    }


def counted(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in pieces(batch.column("text").to_pylist()):
                made = text_counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), *[pa.array(made[c].astype(np.int64)) for c in COUNTS]], names=["doc_id", *COUNTS]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def rules() -> dict[str, tuple[Column, Column]]:
    """Per rule the conditions to vote against and for; neither, or a measure that does not exist: it abstains."""
    repeated, symbols, lines = _share("n_repeat_words", "n_words"), _share("n_symbols", "n_words"), _share("n_dup_lines", "n_lines")
    length, kinds, capitals = _share("word_chars", "n_words"), _share("n_kinds", "n_words"), _share("n_capitals", "n_letters")
    marks, marked = _share("n_marks", "word_chars"), _share("n_marked_words", "n_words")
    # The share of different words falls with the length of any text.
    comparable = F.col("n_words").between(50, 10_000)
    return {
        "repeated words": (repeated > 0.2, repeated < 0.05),
        "symbols": (symbols > 0.15, symbols < 0.03),
        "repeated lines": (lines > 0.3, lines < 0.1),
        "word length": ((length < 2.5) | (length > 12), (length > 3.5) & (length < 7)),
        "capitals": (capitals > 0.4, capitals < 0.15),
        "kinds of words": (comparable & (kinds < 0.2), comparable & (kinds > 0.4)),
        "marks": (marks > 0.1, marks < 0.07),
        "words with symbols": (marked > 0.1, marked < 0.02),
    }


def fit(patterns: Mapping[tuple[int, ...], int], n_rules: int) -> tuple[dict[tuple[int, ...], float], np.ndarray]:
    """Posterior probability of quality of every possible pattern; and P(vote | class) by rule, class and vote."""
    votes = np.array(list(patterns) or np.zeros((0, n_rules)), int).reshape(-1, n_rules)
    weight = np.array(list(patterns.values()), float)
    chance = np.tile(np.array(START), (n_rules, 1, 1))
    prior = PRIOR
    columns = np.arange(n_rules)

    def posterior(v: np.ndarray) -> np.ndarray:
        log = [np.log(chance[columns, y, v]).sum(1) + np.log(p) for y, p in ((0, 1 - prior), (1, prior))]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))

    for _ in range(ROUNDS if len(votes) else 0):
        good = posterior(votes)
        before = chance.copy()
        for y, part in ((0, weight * (1 - good)), (1, weight * good)):
            for vote in range(3):
                chance[:, y, vote] = ((votes == vote) * part[:, None]).sum(0) + SMOOTHING
        chance /= chance.sum(2, keepdims=True)
        prior = min(0.999, max(0.001, (weight * good).sum() / weight.sum()))
        if np.abs(chance - before).max() < 1e-9:
            break
    every = np.array(list(itertools.product(range(3), repeat=n_rules)), int)
    return dict(zip(map(tuple, every.tolist()), posterior(every).tolist(), strict=True)), chance


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, posterior, kept."""
    counts = stored(counted(documents), "quality-counts")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    conditions = list(rules().values())
    vote = [F.when(F.coalesce(against, F.lit(False)), 1).when(F.coalesce(for_, F.lit(False)), 2).otherwise(0) for against, for_ in conditions]
    code = sum((v * 3 ** (len(vote) - 1 - i) for i, v in enumerate(vote)), F.lit(0))
    voted = counts.withColumn("base_failed", failed).withColumn("pattern", code.cast("int"))

    def digits(pattern: int) -> tuple[int, ...]:
        return tuple(pattern // 3 ** (len(vote) - 1 - i) % 3 for i in range(len(vote)))

    # At most 3 ** len(rules) rows.
    found = {digits(r["pattern"]): r["count"] for r in voted.groupBy("pattern").count().collect()}
    posteriors, _ = fit(found, len(vote))
    # In the order of the codes, as product() counts.
    listed = F.from_json(F.lit(str([round(p, 9) for p in posteriors.values()])), "array<double>")
    return voted.withColumn("posterior", F.element_at(listed, F.col("pattern") + 1)).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM))
