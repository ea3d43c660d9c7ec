"""Token ids of words inside a task, each distinct word encoded once while it is remembered."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from gradeloom.llm.bpe import ragged

KNOWN_WORDS = 1 << 18  # distinct words a task remembers


def appended(store: np.ndarray, n: int, new: np.ndarray) -> np.ndarray:
    """The first ``n`` values and the new ones, with room for more behind them, so that values are seldom copied."""
    if n + len(new) > len(store):
        store = np.concatenate((store[:n], new, np.empty(n + len(new), store.dtype)))
    store[n : n + len(new)] = new
    return store


class WordIds:
    """``encode`` gives the ids of each word, or the ids of all words and how many each has."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]] | tuple[np.ndarray, np.ndarray]], known: int = KNOWN_WORDS, kind: type = np.int64):
        self.encode, self.known, self.kind = encode, known, kind
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat, self.starts = np.empty(0, self.kind), np.zeros(1, np.int64)

    def _learned(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """What else is kept of new words."""

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word among those remembered, until the next call."""
        encoded = words.dictionary_encode()
        distinct, code = encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self.number) > self.known:
            self._forget()
        number = np.fromiter(map(self.number.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            new = [distinct[k] for k in unknown.tolist()]
            found = self.encode(new)
            if isinstance(found, tuple):
                flat, sizes = found
            else:
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.fromiter(chain.from_iterable(found), self.kind, int(sizes.sum()))
            n = len(self.number)
            number[unknown] = np.arange(n, n + len(new))
            self.number.update(zip(new, number[unknown].tolist()))
            end = int(self.starts[n])
            self.flat, self.starts = appended(self.flat, end, flat), appended(self.starts, n + 1, end + np.cumsum(sizes))
            self._learned(new, flat, sizes)
        return number[code]

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of these numbers, one after another, and how many each has."""
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        return ragged(self.flat, self.starts[numbers], sizes), sizes
