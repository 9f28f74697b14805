"""Words of lower-cased texts by a table of bytes, with the pieces they lie in."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from tidemark.llm.arrays import Words, mixed

#: A-Z become a-z, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def bytes_of(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode("ascii"))] = True
    return table


class LowerWords(Words):
    """Runs of ``inside`` bytes; a new line must be neither inside nor, where ``breaks`` is given, outside of it.

    With ``breaks``, words of one piece have the same ``piece`` number and no two texts share one.
    """

    def __init__(self, texts: Sequence[bytes], inside: np.ndarray, breaks: np.ndarray | None = None):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.buffer = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        self.text_start = np.concatenate(([0], np.cumsum(sizes + 1)))
        self.inner = inside[self.buffer]
        edge = np.diff(np.concatenate(([False], self.inner)).astype(np.int8))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.owner = np.searchsorted(self.text_start, self.start, "right") - 1
        self.count = np.bincount(self.owner, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        if breaks is not None:
            self.piece = np.cumsum(breaks[self.buffer])[self.start]

    def packed(self) -> pa.LargeBinaryArray:
        """All words, one after the other."""
        offsets = np.concatenate(([0], np.cumsum(self.end - self.start))).astype(np.int64)
        data = self.buffer[self.inner]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def encoded(self) -> tuple[np.ndarray, list[bytes]]:
        """Number of each word among the distinct words, and the distinct words: equal numbers, equal bytes."""
        found = self.packed().dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()


def hashes_of(words: Sequence[bytes]) -> np.ndarray:
    """A 64-bit hash of each byte string."""
    import xxhash

    return mixed(np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)))
