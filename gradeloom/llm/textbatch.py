"""Words of a batch of texts, found with numpy on the UTF-8 bytes.

Everything here works on one Arrow batch inside a task. Batches are cut into slices of about ``SLICE_BYTES`` so that the
temporary arrays stay small; one text longer than that is a slice of its own and is processed whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Words:
    """Words of several texts: ``data`` holds their bytes without gaps, ``offsets`` their borders in it.

    ``text`` is the number of each word's text, ``first`` the first word of each text (one more entry than texts).
    """

    data: np.ndarray
    offsets: np.ndarray
    text: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def length(self) -> np.ndarray:
        return np.diff(self.offsets)

    def array(self) -> pa.Array:
        """The words as an Arrow array that shares their bytes."""
        return byte_array(self.data, self.offsets)

    def hashes(self) -> np.ndarray:
        return hash_pieces(self.data, self.offsets)


def byte_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    borders = np.ascontiguousarray(offsets, dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the borders of the texts in them; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, borders, data = texts.buffers()
    offsets = np.frombuffer(borders, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    return values, offsets - offsets[0]


def split_words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = WHITE) -> Words:
    """The maximal runs of bytes that are no gaps, within each text."""
    inside = ~gaps[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    starts[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    at = np.flatnonzero(starts)
    lengths = np.flatnonzero(ends) + 1 - at
    first = np.searchsorted(at, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data[inside], np.concatenate(([0], np.cumsum(lengths))), text, first)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _PRIME, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def byte_terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per byte its share of the polynomial hash of its piece."""
    lengths = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    return _BYTE_CODES[data] * powers(int(lengths.max(initial=0)))[place]


def hash_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hashes of pieces of at least one byte."""
    if len(offsets) < 2:
        return np.empty(0, np.uint64)
    return mix(np.add.reduceat(byte_terms(data, offsets), offsets[:-1]))


def shingles(hashes: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the number of each run's text; a shorter text with words is one run."""
    n = len(hashes)
    factors = powers(size + 1)
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if n >= size:
        runs = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            runs += hashes[k : n - size + 1 + k] * factors[k]
        whole = words.text[: n - size + 1] == words.text[size - 1 :]
        runs, owner = mix(runs[whole]), words.text[: n - size + 1][whole]
    else:
        runs, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(short):
        ends = words.first[short + 1]
        sums = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            at = words.first[short] + k
            has = at < ends
            sums[has] += hashes[at[has]] * factors[k]
        sums = mix(sums + factors[size] * words.count[short].astype(np.uint64))
        runs, owner = np.concatenate((runs, sums)), np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        runs, owner = runs[order], owner[order]
    return runs, owner


def distinct_per_text(runs: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and the borders of the texts in them."""
    borders = np.searchsorted(owner, np.arange(n_texts + 1))
    kept, sizes = [], np.zeros(n_texts, dtype=np.int64)
    for i in np.flatnonzero(np.diff(borders)):
        values = np.sort(runs[borders[i] : borders[i + 1]])
        fresh = np.empty(len(values), dtype=bool)
        fresh[0] = True
        np.not_equal(values[1:], values[:-1], out=fresh[1:])
        values = values[fresh]
        kept.append(values)
        sizes[i] = len(values)
    return (np.concatenate(kept) if kept else np.empty(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts have about ``limit`` bytes; no empty ones."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(n, max(end, at + 1))
            yield batch.slice(at, end - at)
            at = end


def per_text_sum(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of integer values between borders."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[borders[1:]] - total[borders[:-1]]
