"""Benchmark decontamination by spaced-seed hashing.

A mask of fixed places selects ``weight`` of ``span`` consecutive words; the words at the other places are ignored, so a hash of
the selected ones survives substitutions there. Hashes of all places of all test items are joined with those of the training
texts. Around each hit the two texts are laid side by side, and the overlap counts when a run of at least ``min_words`` words
(or the whole item, if it is shorter) agrees in ``min_share`` percent of its places. With the default limits each such overlap is
met by a mask: a run of 12 words or more holds one of 12, 16 or 20 words with at most 3, 4 or 5 differences (or is cut in halves, one
of which does), and ``MASKS`` meet all of these. An item shorter than ``min_words`` has masks of its own over its whole length: its
words are dealt to groups, two more than the differences allowed, and each choice of two groups is a mask, so one choice has no difference.
Other limits need other ``masks`` for the longer items.

The test items are the query set: they are read in blocks of about ``block_words`` words at most, and each block is sent to the
tasks that read the training texts, so the size of what is sent is bounded whatever the size of the benchmark. Training texts are
read where they lie and are never shuffled; every place of every text is looked up. With several blocks, what was found so far is
stored between them.

Rows: one row out per row in. Null and empty texts have no words and no overlap; items without id or text match nothing. Items of under
four words tolerate no difference at 75 percent. Texts are processed whole, repeated rows
are judged alike, ties between items go to the longer overlap and then the smaller id. An empty table gives an empty table, and an
empty benchmark leaves all texts clean. Other columns of the input are left out, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.textbatch import LOWER, Words, mix, powers, slices, split_words, text_bytes
from gradeloom.sources.workdir import stored

#: Fixed masks: 1 marks a place whose word counts. Together they meet every overlap of 12 words or more with 75 percent agreement.
MASKS = ("110111", "1110011", "110001011", "111000000011")
MIN_WORDS = 12
MIN_SHARE = 75
BLOCK_WORDS = 2_000_000
ALIGNMENTS = 1 << 18  # expanded at a time
_BITS = 24

_FOUND = pa.list_(pa.struct([("item", pa.int64()), ("words", pa.int64()), ("length", pa.int64())]))
_FOUND_SQL = "array<struct<item: bigint, words: bigint, length: bigint>>"

_GAPS = np.zeros(256, dtype=bool)
_GAPS[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True  # punctuation and case don't tell passages apart


def tokens(texts: pa.Array) -> tuple[Words, np.ndarray]:
    data, offsets = text_bytes(texts)
    words = split_words(LOWER[data], offsets, _GAPS)
    return words, words.hashes()


def seed_hashes(hashes: np.ndarray, mask: str, number: int) -> np.ndarray:
    """For each place with room for the mask, the hash of the words it selects."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = powers(len(mask) + 2)
    out = np.repeat(factors[-1:] * np.uint64(number + 1), n)
    for k, bit in enumerate(mask):
        if bit == "1":
            out += hashes[k : n + k] * factors[k]
    return mix(out)


def short_masks(length: int, min_share: int) -> list[str]:
    """Masks over a whole item, one of which meets any copy of it that agrees in ``min_share`` percent of its words."""
    differences = length * (100 - min_share) // 100
    groups = min(differences + 2, length) if differences else 1
    return ["".join("1" if k % groups in kept else "0" for k in range(length)) for kept in combinations(range(groups), groups - differences)]


@dataclass
class Benchmark:
    """Words of a block of items with their seeds, sorted by hash. ``masks`` are the given ones and those of the short items there are.

    A unit is a hash in one item: ``unit_seed``, ``unit_item``, and its places from ``unit_first`` on.
    """

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    places: np.ndarray
    masks: tuple[str, ...]

    def __post_init__(self):
        owner = np.repeat(np.arange(len(self.ids)), np.diff(self.first))[self.places]
        new = np.ones(len(self.seeds), bool)
        new[1:] = (np.diff(self.seeds) != 0) | (np.diff(owner) != 0)
        begin = np.flatnonzero(new)
        self.unit_seed, self.unit_item = self.seeds[begin], owner[begin]
        self.unit_first = np.append(begin, len(self.seeds))

    @cached_property
    def hint(self) -> np.ndarray:
        """A bitmap by the first bits of the hashes, which spares most searches; built in each task."""
        out = np.zeros(1 << _BITS, dtype=bool)
        out[self.seeds >> np.uint64(64 - _BITS)] = True
        return out

    @classmethod
    def build(cls, ids: list[int], texts: list[str | None], masks: tuple[str, ...], min_words: int, min_share: int) -> "Benchmark":
        words, hashes = tokens(pa.array(texts, pa.string()))
        seeds, places = [], []
        for number, mask in enumerate(masks):
            found = seed_hashes(hashes, mask, number)
            at = np.arange(len(found))
            inside = words.text[at] == words.text[at + len(mask) - 1] if len(at) else at
            seeds.append(found[inside])
            places.append(at[inside])
        every = list(masks)
        for length in np.unique(words.count[(words.count > 0) & (words.count < min_words)]).tolist():
            at = words.first[:-1][words.count == length]
            for mask in short_masks(length, min_share):
                seeds.append(seed_hashes(hashes, mask, len(every))[at])
                places.append(at)
                every.append(mask)
        all_seeds, all_places = np.concatenate(seeds), np.concatenate(places)
        order = np.argsort(all_seeds, kind="stable")
        return cls(np.array(ids, np.int64), hashes, words.first, all_seeds[order], all_places[order], tuple(every))


class _Best:
    """The best verified overlap of each text and item."""

    def __init__(self, words: Words, hashes: np.ndarray, items: Benchmark, min_words: int, min_share: int):
        self.words, self.hashes, self.items, self.min_words, self.min_share = words, hashes, items, min_words, min_share
        self.seen = np.empty(0, np.int64)  # alignments: text and item, and text place less item place
        self.width = len(hashes) + len(items.words) + 1
        self.found: dict[int, tuple[int, int]] = {}
        self.full: list[int] = []  # texts and items of which nothing better can come

    def verify(self, keys: np.ndarray) -> None:
        """Look at alignments not seen before, those with most common places first; what can't be better is passed over."""
        keys = np.setdiff1d(keys, self.seen)
        self.seen = np.union1d(self.seen, keys)
        pair, shift = keys // self.width, keys % self.width - len(self.items.words)
        text, item = pair // len(self.items.ids), pair % len(self.items.ids)
        i0, i1 = self.items.first[item], self.items.first[item + 1]
        lo, hi = np.maximum(i0 + shift, self.words.first[text]), np.minimum(i1 + shift, self.words.first[text + 1])
        order = np.argsort(lo - hi, kind="stable")
        for pair, lo, hi, shift, size in zip(*(x[order].tolist() for x in (pair, lo, hi, shift, i1 - i0))):
            best = self.found.get(pair, (0, 0))
            if hi - lo <= best[0]:
                continue
            same = self.hashes[lo:hi] == self.items.words[lo - shift : hi - shift]
            run = best_run(same, min(self.min_words, size), self.min_share)
            if run and run > best:
                self.found[pair] = run
                if run == (size, size):
                    self.full.append(pair)


def _overlaps(words: Words, hashes: np.ndarray, items: Benchmark, min_words: int, min_share: int):
    """Verified overlaps: text, item, agreeing words, length.

    Hits are taken a bounded number of alignments at a time. Where words repeat, as in a run of equal ones, the first ones show an item found
    whole, and its other hits in that text are not expanded.
    """
    hint = items.hint
    shift = np.uint64(64 - _BITS)
    text_of = words.text
    best = _Best(words, hashes, items, min_words, min_share)
    for number, mask in enumerate(items.masks):
        seeds = seed_hashes(hashes, mask, number)
        at = np.flatnonzero(hint[seeds >> shift])
        at = at[text_of[at] == text_of[at + len(mask) - 1]] if len(at) else at
        lo = np.searchsorted(items.unit_seed, seeds[at], side="left")
        n = np.searchsorted(items.unit_seed, seeds[at], side="right") - lo
        place = np.repeat(at, n)
        unit = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        pair = text_of[place] * len(items.ids) + items.unit_item[unit]
        while len(place):
            if best.full:
                left = ~np.isin(pair, best.full)
                place, unit, pair = place[left], unit[left], pair[left]
            first = items.unit_first[unit]
            sizes = items.unit_first[unit + 1] - first
            k = max(1, int(np.searchsorted(np.cumsum(sizes), ALIGNMENTS, side="right")))
            few = sizes[:k]
            if len(few):
                inner = np.repeat(first[:k] - np.cumsum(few) + few, few) + np.arange(few.sum())
                best.verify(np.repeat(pair[:k], few) * best.width + np.repeat(place[:k], few) - items.places[inner] + len(items.words))
            place, unit, pair = place[k:], unit[k:], pair[k:]
    return [(pair // len(items.ids), int(items.ids[pair % len(items.ids)]), *run) for pair, run in best.found.items()]


def best_run(agree: np.ndarray, min_words: int, min_share: int) -> tuple[int, int] | None:
    """Most agreeing words in a run of at least ``min_words`` of which ``min_share`` percent agree, and that run's length."""
    if len(agree) < min_words or 100 * int(agree.sum()) < min_share * min_words:
        return None
    # a run qualifies when the sum of (100 - share) per agreement less share per difference is not negative
    gain = np.concatenate(([0], np.cumsum(np.where(agree, 100 - min_share, -min_share))))
    total = np.concatenate(([0], np.cumsum(agree)))
    ends = np.arange(min_words, len(agree) + 1)
    lowest = np.minimum.accumulate(gain[: len(agree) - min_words + 1])
    ends = ends[gain[ends] >= lowest]
    if not len(ends):
        return None
    starts = np.searchsorted(-lowest, -gain[ends])  # the first place as low as the end: the lowest so far never rise
    agreeing, length = total[ends] - total[starts], ends - starts
    most = agreeing.max()
    return int(most), int(length[agreeing == most].max())


def _block_count(benchmark: DataFrame, item_text: str, block_words: int) -> int:
    """A text has at most half as many words as characters."""
    chars = benchmark.agg(F.sum(F.length(item_text))).first()[0] or 0
    return max(1, -(-chars // (2 * block_words)))


def _block(benchmark: DataFrame, item_col: str, item_text: str, masks: tuple[str, ...], min_words: int, min_share: int, k: int, n_blocks: int) -> Benchmark:
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).cast("string").alias("text"))
    rows = items.where(F.col("id").isNotNull() & F.col("text").isNotNull() & (F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k)).distinct().collect()
    rows.sort()
    return Benchmark.build([r["id"] for r in rows], [r["text"] for r in rows], masks, min_words, min_share)


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_words: int = MIN_WORDS,
    min_share: int = MIN_SHARE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id, contaminated, n_items, item_ids, best_item, best_words, best_length``.

    ``item_ids`` lists all overlapping items in order.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def search(items: Benchmark, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                words, hashes = tokens(part.column("text"))
                found = part.column("found").to_pylist()
                for text, item, agreeing, length in _overlaps(words, hashes, items, min_words, min_share):
                    found[text].append({"item": item, "words": agreeing, "length": length})
                out = {"doc_id": part.column("doc_id"), "found": pa.array(found, _FOUND)}
                yield pa.RecordBatch.from_pydict(out if last else out | {"text": part.column("text")})

        return run

    result = narrow.withColumn("found", F.array().cast(_FOUND_SQL))
    n_blocks = _block_count(benchmark, item_text, block_words)
    for k in range(n_blocks):
        last = k == n_blocks - 1
        items = _block(benchmark, item_col, item_text, masks, min_words, min_share, k, n_blocks)
        result = result.select("doc_id", "text", "found").mapInArrow(search(items, last), f"doc_id bigint, found {_FOUND_SQL}" + ("" if last else ", text string"))
        if not last:
            result = stored(result, "overlaps")
    best = F.array_max(F.transform("found", lambda x: F.struct(x["words"].alias("words"), x["length"].alias("length"), (-x["item"]).alias("item"))))
    items = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item"])))
    return result.select(
        "doc_id",
        (F.size("found") > 0).alias("contaminated"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("item_ids"),
        (-best["item"]).alias("best_item"),
        best["words"].alias("best_words"),
        best["length"].alias("best_length"),
    )


def without_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_words: int = MIN_WORDS,
    min_share: int = MIN_SHARE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with all their columns, filtered where they lie."""

    def keep(items: Benchmark):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, text_col):
                words, hashes = tokens(part.column(text_col))
                clean = np.ones(part.num_rows, dtype=bool)
                clean[[x[0] for x in _overlaps(words, hashes, items, min_words, min_share)]] = False
                yield part.filter(pa.array(clean))

        return run

    n_blocks = _block_count(benchmark, item_text, block_words)
    kept = docs
    for k in range(n_blocks):
        kept = kept.mapInArrow(keep(_block(benchmark, item_col, item_text, masks, min_words, min_share, k, n_blocks)), docs.schema)
        if k < n_blocks - 1:
            kept = stored(kept, "clean")
    return kept
