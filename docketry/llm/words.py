"""Ids of texts put together from the ids of their words; each distinct word is encoded once."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np

# A memory, not a limit: when it is full it starts anew, and words are encoded again.
KEPT_WORDS = 500_000


class WordMemory:
    """Ids by word, in one flat array; kept for the life of a worker process.

    ``encode_new`` gives the ids of words as packed unsigned 32-bit integers.
    """

    def __init__(self, encode_new: Callable[[list[str]], list[bytes]]):
        self.encode_new = encode_new
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The ids of each text, given as its words."""
        if len(self.places) > KEPT_WORDS:
            self._forget()
        places = self.places
        new = list(set().union(*texts).difference(places))
        if new:
            encoded = self.encode_new(new)
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
            places.update(zip(new, range(len(places), len(places) + len(new))))
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(encoded), np.uint32)])
        return [self._gather(words) for words in texts]

    def _gather(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        starts, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        before = np.cumsum(sizes) - sizes
        return self.ids[np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)]


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()
