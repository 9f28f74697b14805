"""Token ids of whole texts by a ``tokenizers`` file.

Splitting at blanks and line feeds never changes the ids when the tokenizer drops white space and cuts words at it
(``word_bpe_49k.json`` does), so each chunk between them is encoded once per worker and looked up afterwards.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np

#: What a worker remembers at most, about 200 bytes each; beyond it the worker starts anew.
CHUNKS, WORDS = 1_000_000, 1_000_000
#: Holds no text: line feeds are replaced before texts are split.
END = "\n"
#: Punctuation behind a word is a run of its own; the apostrophe is not, it may begin a contraction.
TAIL = ".,;:!?*$%&#|)]}"
#: Below this character lower case does not depend on the neighbours.
LATIN_END = "\u0250"


class ChunkIds(dict):
    """Number of each chunk seen; the ids of all chunks lie end to end in one array.

    A word with punctuation behind it has the ids of the word, in lower case, and then those of the punctuation; so
    most new chunks are made of words already known.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.end = array(self.code, [end_id]).tobytes()
        self.words: dict[str, bytes] = {}
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.flat, self.start, self.size = array(self.code), array("q"), array("q")

    def _encoded(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, text: str) -> bytes:
        """Ids of lower-case letters or of punctuation; plain ASCII letters need none of the steps before the model."""
        ids = self.words.get(text)
        if ids is None:
            if len(self.words) >= WORDS:
                self.words.clear()
            plain = text.isascii() and text.isalpha()
            ids = array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes() if plain else self._encoded(text)
            self.words[text] = ids
        return ids

    def _ids(self, chunk: str) -> bytes:
        head = chunk.rstrip(TAIL)
        low = head.lower()
        # Lower case of another length ends in a mark that would join the punctuation.
        if not (head.isalpha() and (head.isascii() or (max(head) < LATIN_END and len(low) == len(head)))):
            return self._encoded(chunk)
        word = self._word(low)
        return word if len(head) == len(chunk) else word + self._word(chunk[len(head) :])

    def __missing__(self, chunk: str) -> int:
        ids = self.end if chunk == END else self._ids(chunk) if chunk else b""
        number = len(self.start)
        self.start.append(len(self.flat))
        self.flat.frombytes(ids)
        self.size.append(len(self.flat) - self.start[-1])
        self[chunk] = number
        return number

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text's followed by the end id; and the number of ids of each."""
        if len(self) > CHUNKS:
            self.reset()
        chunks: list[str] = []
        held = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(chunks)
            chunks += text.replace("\n", " ").split(" ")
            chunks.append(END)
            held[i] = len(chunks) - before
        number = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))
        size = np.frombuffer(self.size, np.int64)[number]
        start = np.frombuffer(self.start, np.int64)[number]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.frombuffer(self.flat, np.dtype(self.code))[np.repeat(start - (ends - size), size) + np.arange(total)]
        counts = np.add.reduceat(size, np.cumsum(held) - held) if len(texts) else np.zeros(0, np.int64)
        return ids, counts


@lru_cache(maxsize=1)
def chunk_ids(path: str, end_id: int) -> ChunkIds:
    """The encoder of this worker process: what one task has looked up serves the next."""
    return ChunkIds(path, end_id)


def let_go() -> None:
    """Frees the encoder of this worker process: Spark gives workers that have encoded other work, which needs the memory."""
    chunk_ids.cache_clear()
