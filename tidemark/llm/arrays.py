"""Whole batches of texts as byte and word arrays.

Texts are laid end to end and hashed with prefix sums, so the cost per byte does not depend on how long a
text or a word is.  Batches are cut into pieces of about a megabyte, which bounds a task's memory by the
longest single text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

PIECE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[int, np.ndarray] = {}

#: White space as the contracts define it: blank and the five controls from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def encoded(texts: Iterable[str | None]) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def pieces(texts: Iterable[str | None], limit: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) in pieces of about ``limit`` bytes; a null text is an empty one."""
    held: list[bytes] = []
    first = size = 0
    for i, raw in enumerate(encoded(texts)):
        held.append(raw)
        size += len(raw) + 1
        if size >= limit:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser with avalanche; uint64 to uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        out = np.full(max(n, PIECE_BYTES + 1), np.uint64(base))
        out[0] = 1
        with np.errstate(over="ignore"):
            known = np.multiply.accumulate(out)
        _powers[base] = known
    return known[:n]


_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


class Words:
    """Words of several texts: byte spans, the text each belongs to and a 64-bit hash of each."""

    def __init__(self, texts: Sequence[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.text_start = np.concatenate(([0], np.cumsum(sizes + 1)))
        inner = ~SPACE[self.buffer]
        edge = np.diff(np.concatenate(([False], inner)).astype(np.int8))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.owner = np.searchsorted(self.text_start, self.start, "right") - 1
        self.count = np.bincount(self.owner, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def hashes(self) -> np.ndarray:
        n = len(self.buffer)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[self.buffer] * _power(_BASE, n), dtype=np.uint64)))
        spans = (sums[self.end] - sums[self.start]) * _power(_BACK, n)[self.start]
        return mixed(spans + (self.end - self.start).astype(np.uint64) * _ODD)

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``width`` words inside one text."""
        total = len(hashes) - width + 1
        if total <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.owner[:total] == self.owner[width - 1 :])
        out = np.zeros(total, np.uint64)
        for i in range(width):
            out = mixed(out * _ODD + hashes[i : i + total] + np.uint64(i))
        return at, out[at]

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the distinct runs of ``width`` words; a shorter text with words has one, of all its words.

        Ordered by text, then by hash.
        """
        hashes = self.hashes()
        at, run = self.windows(hashes, width)
        owner = self.owner[at]
        short = np.flatnonzero((self.count > 0) & (self.count < width))
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for i in range(width - 1):
                there = self.count[short] > i
                word = hashes[np.where(there, self.first[short] + i, 0)]
                whole = np.where(there, mixed(whole * _ODD + word + np.uint64(i)), whole)
            owner, run = np.concatenate((owner, short)), np.concatenate((run, whole))
        order = np.lexsort((run, owner))
        owner, run = owner[order], run[order]
        keep = np.ones(len(run), bool)
        keep[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
        return owner[keep], run[keep]
