"""Alignment of two tokenizers' tokens over the bytes of the same texts, by products of sparse incidence matrices.

A tokenizer's tokens and the bytes they cover are a matrix: a row per token occurrence, a column per byte. With A and B for the
two tokenizers, A Bᵀ has an entry for each pair of occurrences that overlap, its value being the number of common bytes. Byte offsets at which
tokens of both end cut the tokens into groups; with the incidence of tokens and groups in place of bytes the product has an entry for each
pair that shares a group. The matrices are kept as compressed sparse rows and multiplied row by row (Gustavson): a row of the
product is the sum of those rows of the right matrix that the left row points at.

How many texts hold an id pair linked is counted over the whole table: a block of texts hands out each of its distinct pairs once, Spark
sums them up and finds each A id's most frequent pairs, and the sums are joined back to the block, which keeps for each text the
numbers of its pairs. Blocks hold about ``BLOCK_BYTES`` of text and lie in the shared folder.

Both tokenizers see space + text. Left merges never leave a pre-token; right merges never cross the space before a word unless some piece of the
model does, which is looked up in the model. So each distinct word is encoded once per run of texts.

Rows: one row out per row in. Texts that are null, empty, or come back differently from either tokenizer have no tokens. Control strings of
a vocabulary are ordinary text. A null id stays null; repeated ids are rows of their own, and each row counts as a text. Texts of any
length are processed whole. An empty table gives an empty table. Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.bpe import pre_tokens, ragged
from gradeloom.llm.dictionary import stored_packed
from gradeloom.llm.textbatch import byte_array, slices, text_bytes
from gradeloom.llm.token_files import byte_letters, tokenizer_ids
from gradeloom.llm.word_ids import WordIds

BLOCK_BYTES = 8 << 20
META = "▁"  # what pieces write for a space


# --- sparse matrices ---


@dataclass
class Csr:
    """A sparse matrix in compressed rows: row ``r`` has columns ``columns[starts[r] : starts[r + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def row_of(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Csr(starts, self.row_of()[order], self.values[order], len(self.starts) - 1)

    def product_sizes(self, other: Csr) -> np.ndarray:
        """Per row, how many entries of ``other`` go into the product's row."""
        brought = np.diff(other.starts)[self.columns]
        return np.diff(np.concatenate(([0], np.cumsum(brought)))[self.starts])

    def __matmul__(self, other: Csr) -> Csr:
        """Row by row: each entry of a left row brings the right row it points at, and equal columns are added up."""
        brought = np.diff(other.starts)[self.columns]
        row = np.repeat(self.row_of(), brought)
        column = ragged(other.columns, other.starts[self.columns], brought)
        value = np.repeat(self.values, brought) * ragged(other.values, other.starts[self.columns], brought)
        place = row * other.width + column
        if len(place) and (place[1:] < place[:-1]).any():
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        place, value = place[first], (np.add.reduceat(value, first) if len(first) else value)
        n = len(self.starts) - 1
        return Csr(np.searchsorted(place, np.arange(n + 1) * other.width), place % max(other.width, 1), value, other.width)


def byte_incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens of these lengths one after another."""
    starts = np.concatenate(([0], np.cumsum(lengths)))
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64), int(starts[-1]))


def group_incidence(group: np.ndarray, n_groups: int) -> Csr:
    """Tokens by groups, each token in one."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), n_groups)


# --- tokenizers ---


def load_pieces(path: str) -> bytes:
    """A piece model's bytes, to be sent to the tasks; read on the driver only."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=1)
def left_tokens(content: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer."""
    description, letters = json.loads(content), byte_letters()
    out = {i: bytes(letters[c] for c in token) for token, i in description["model"]["vocab"].items() if all(c in letters for c in token)}
    out |= {t["id"]: t["content"].encode() for t in description["added_tokens"]}
    return [out.get(i, b"") for i in range(max(out) + 1)]


@lru_cache(maxsize=1)
def _pieces(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


@lru_cache(maxsize=1)
def right_tokens(model: bytes) -> list[bytes]:
    """The bytes of each id of a piece model."""
    processor = _pieces(model)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return [bytes([int(p[3:-1], 16)]) if processor.is_byte(i) else p.replace(META, " ").encode() for i, p in enumerate(pieces)]


@lru_cache(maxsize=1)
def words_stand_alone(model: bytes) -> bool:
    """Whether no piece holds a space behind anything else, so that no merge crosses the space before a word."""
    processor = _pieces(model)
    return not any(META in p.lstrip(META) for p in (processor.id_to_piece(i) for i in range(processor.get_piece_size())))


def piece_encoder(model: bytes) -> Callable[[list[bytes]], list[list[int]]]:
    """Encodes words that begin with the space which the model itself adds."""

    def encode(words: list[bytes]) -> list[list[int]]:
        processor = _pieces(model)
        alone = processor.piece_to_id(META)
        found = processor.encode([w[1:].decode("utf-8") for w in words], num_threads=1)
        return [[alone] if w == b" " else ids for w, ids in zip(words, found)]

    return encode


class Vocabulary(WordIds):
    """Ids of words, and whether they give back the word's bytes."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.bytes, self.borders = np.frombuffer(b"".join(tokens), np.uint8), np.concatenate(([0], np.cumsum(self.lengths)))
        super().__init__(encode)

    def _forget(self) -> None:
        super()._forget()
        self.whole = np.empty(0, bool)

    def _learned(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.whole = np.concatenate((self.whole, self._gives_back(words, ids, sizes)))

    def _gives_back(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which words are the bytes of their ids, no id being without bytes."""
        length = np.array([len(w) for w in words], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        sums = np.concatenate(([0], np.cumsum(self.lengths[ids])))
        empty = np.concatenate(([0], np.cumsum(self.lengths[ids] == 0)))
        fits = (sums[starts[1:]] - sums[starts[:-1]] == length) & (empty[starts[1:]] == empty[starts[:-1]])
        some = ids[np.repeat(fits, sizes)]
        got = ragged(self.bytes, self.borders[some], self.lengths[some])
        want = np.frombuffer(b"".join([w for w, fit in zip(words, fits.tolist()) if fit]), np.uint8)
        wrong = np.concatenate(([0], np.cumsum(got != want)))
        ends = np.concatenate(([0], np.cumsum(length[fits])))
        fits[np.flatnonzero(fits)[wrong[ends[1:]] != wrong[ends[:-1]]]] = False
        return fits

def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of the texts with a space before each."""
    data, borders = text_bytes(texts)
    return np.insert(data, borders[:-1], 0x20), borders + np.arange(len(borders))


def space_words(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Borders of the words with the spaces before them, and the first word of each text; every text begins with a space."""
    space = data == 0x20
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[borders[:-1]] = True
    begin = np.flatnonzero(start)
    return np.append(begin, len(data)), np.searchsorted(begin, borders)


# --- alignment of a batch of texts ---


@dataclass
class Aligned:
    """Tokens of some texts, their groups and links. ``*_text`` numbers each token's text, ``*_group`` its group over all texts."""

    left: np.ndarray
    right: np.ndarray
    left_text: np.ndarray
    right_text: np.ndarray
    left_group: np.ndarray
    right_group: np.ndarray
    n_groups: int
    links: Csr

    def shared_group_links(self) -> Csr:
        """An entry for each pair of occurrences in one group; its size grows with the square of a group's."""
        return group_incidence(self.left_group, self.n_groups) @ group_incidence(self.right_group, self.n_groups).transposed()

    def shared_group_counts(self) -> np.ndarray:
        """Per left token the number of right tokens in its group, without the pairs themselves."""
        return group_incidence(self.left_group, self.n_groups).product_sizes(group_incidence(self.right_group, self.n_groups).transposed())


class Aligner:
    def __init__(self, left: str, right: bytes):
        self.left = Vocabulary(tokenizer_ids(left), left_tokens(left))
        self.right = Vocabulary(piece_encoder(right), right_tokens(right))
        self.cut = words_stand_alone(right)

    def align(self, texts: pa.Array) -> Aligned:
        data, borders = spaced(texts)
        n = len(borders) - 1
        with_space = pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(borders, np.int64)), pa.py_buffer(data))
        _, left_borders, left_first = pre_tokens(with_space)
        right_borders, right_first = space_words(data, borders) if self.cut else (borders, np.arange(n + 1))
        good = np.diff(borders) > 1
        sides = []
        for vocabulary, cuts, first in ((self.left, left_borders, left_first), (self.right, right_borders, right_first)):
            words = vocabulary.numbers(byte_array(data, cuts))
            (ids, sizes), whole = vocabulary.ids(words), vocabulary.whole[words]
            text = np.repeat(np.arange(n), np.diff(first))
            good[text[~whole]] = False
            sides.append((ids, np.repeat(text, sizes), vocabulary.lengths))
        kept = [(ids[good[text]], text[good[text]], lengths) for ids, text, lengths in sides]
        (a, a_text, a_lengths), (b, b_text, b_lengths) = kept
        a_bytes, b_bytes = a_lengths[a], b_lengths[b]
        a_ends, b_ends = np.cumsum(a_bytes), np.cumsum(b_bytes)
        b_ends_here = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, bool)
        b_ends_here[b_ends] = True
        cuts = a_ends[b_ends_here[a_ends]]
        links = byte_incidence(a_bytes) @ byte_incidence(b_bytes).transposed()
        return Aligned(a, b, a_text, b_text, np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends), len(cuts), links)


@lru_cache(maxsize=1)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``n``, each with a comma, and their borders."""
    parts = [b"%d," % i for i in range(n)]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def group_texts(found: Aligned, n_texts: int, n_ids: int) -> list[memoryview]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``."""
    per_group = [np.bincount(g, minlength=found.n_groups) for g in (found.left_group, found.right_group)]
    a_upto, b_upto = (np.cumsum(c) for c in per_group)
    a_at = np.arange(len(found.left)) + (b_upto - per_group[1])[found.left_group]
    b_at = np.arange(len(found.right)) + a_upto[found.right_group]
    ids, sign = np.empty(len(a_at) + len(b_at), np.int64), np.full(len(a_at) + len(b_at), ord(","), np.uint8)
    ids[a_at], ids[b_at] = found.left, found.right
    sign[a_at[a_upto - 1]], sign[b_at[b_upto - 1]] = ord("|"), ord(";")
    digits, borders = _decimals(n_ids)
    sizes = borders[ids + 1] - borders[ids]
    out = ragged(digits, borders[ids], sizes)
    ends = np.cumsum(sizes)
    out[ends - 1] = sign
    tokens = np.bincount(found.left_text, minlength=n_texts) + np.bincount(found.right_text, minlength=n_texts)
    text_ends = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(tokens)))]
    view = memoryview(np.ascontiguousarray(out))
    return [view[a : max(a, b - 1)] for a, b in zip(text_ends[:-1].tolist(), text_ends[1:].tolist())]


# --- the operator ---

_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")
_BLOCKS = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, groups_sha256 string, "
    "once array<int>, often array<int>, times array<int>, pairs array<bigint>, holders array<int>"
)
_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups_sha256", pa.string())]
    + [(c, pa.list_(pa.int32())) for c in ("once", "often", "times")]
    + [("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32()))]
)


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """One list per owner; ``owner`` ascends."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(values.astype(np.int32)))


def _aligned_blocks(left: str, right: bytes, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(left, right)
        n_left, n_right = len(aligner.left.tokens), len(aligner.right.tokens)
        base, number, size = TaskContext.get().partitionId() << 32, 0, 0
        docs: list[dict] = []
        linked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            """The block's distinct pairs in one row, then a row per text with its pairs' numbers."""
            first = np.concatenate(([0], np.cumsum([len(d["doc_id"]) for d in docs])))
            text = np.concatenate([t + k for (t, _, _), k in zip(linked, first)])
            pairs, slot = np.unique(np.concatenate([p for _, p, _ in linked]), return_inverse=True)
            times = np.concatenate([n for _, _, n in linked])
            block = base | number
            head = {"block": [block], "pairs": [pairs], "holders": [np.bincount(slot, minlength=len(pairs))]}
            yield pa.RecordBatch.from_arrays([pa.array(head.get(f.name, [None]), f.type) for f in _ARROW], schema=_ARROW)
            n, several = int(first[-1]), times > 1
            rows = {name: np.concatenate([d[name] for d in docs]) for name in _COUNTS} | {
                "block": np.full(n, block),
                "doc_id": [i for d in docs for i in d["doc_id"]],
                "groups_sha256": [x for d in docs for x in d["groups_sha256"]],
                "once": _lists(slot[~several], text[~several], n),
                "often": _lists(slot[several], text[several], n),
                "times": _lists(times[several], text[several], n),
            }
            yield pa.RecordBatch.from_arrays([rows[f.name] if isinstance(rows.get(f.name), pa.Array) else pa.array(rows.get(f.name, [None] * n), f.type) for f in _ARROW], schema=_ARROW)

        for part in slices(batches):
            found = aligner.align(part.column("text"))
            n = part.num_rows
            row = found.links.row_of()
            pair = found.left[row] * n_right + found.right[found.links.columns]
            text = found.left_text[row]
            key, times = np.unique(text * (n_left * n_right) + pair, return_counts=True)
            linked.append((key // (n_left * n_right), key % (n_left * n_right), times))
            group_text = np.zeros(found.n_groups, np.int64)
            group_text[found.left_group] = found.left_text
            docs.append(
                {
                    "doc_id": part.column("doc_id").to_pylist(),
                    "n_a": np.bincount(found.left_text, minlength=n),
                    "n_b": np.bincount(found.right_text, minlength=n),
                    "n_groups": np.bincount(group_text, minlength=n),
                    "n_links": np.bincount(text, minlength=n),
                    "n_group_links": np.bincount(found.left_text, weights=found.shared_group_counts(), minlength=n).astype(np.int64),
                    "groups_sha256": [hashlib.sha256(g).hexdigest() if len(g) else "" for g in group_texts(found, n, max(n_left, n_right))],
                }
            )
            size += part.nbytes
            if size >= block_bytes:
                yield from flush()
                docs, linked, number, size = [], [], number + 1, 0
        if docs:
            yield from flush()

    return run


def aligned_blocks(docs: DataFrame, left: str, right: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of texts, stored: a row with the block's distinct id pairs and how many of its texts hold each, then a row per text."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored_packed(narrow.mapInArrow(_aligned_blocks(left, right, block_bytes), _BLOCKS), "aligned")


def pair_entries(blocks: DataFrame) -> DataFrame:
    """``block, slot, pair, holders``: each distinct pair of a block."""
    heads = blocks.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "holders")))
    return heads.select("block", F.col("pos").alias("slot"), F.col("col.pairs").alias("pair"), F.col("col.holders").alias("holders"))


def pair_counts(entries: DataFrame, n_right: int) -> DataFrame:
    """``pair, a, b, n, best``: in how many texts each id pair is linked, and whether no other pair of its left id is in more."""
    counts = entries.groupBy("pair").agg(F.sum(F.col("holders").cast("long")).alias("n"))
    ids = counts.withColumns({"a": F.expr(f"pair div {n_right}"), "b": F.col("pair") % n_right})
    return ids.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, n_group_links bigint"


def _with_counts(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """The texts of a block with their pairs' counts summed up."""
    slot = counts.column("slot").to_numpy()
    n, best = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
    n[slot], best[slot] = counts.column("n").to_numpy(), counts.column("best").to_numpy().astype(np.int64)
    texts = texts.combine_chunks()
    total, most = np.zeros(texts.num_rows, np.int64), np.zeros(texts.num_rows, np.int64)
    for name in ("once", "often"):
        column = texts.column(name).combine_chunks()
        slots = column.flatten().to_numpy()
        times = texts.column("times").combine_chunks().flatten().to_numpy() if name == "often" else np.ones(len(slots), np.int64)
        borders = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
        for out, values in ((total, n), (most, best)):
            out += np.diff(np.concatenate(([0], np.cumsum(values[slots] * times)))[borders])
    added = {"n_best": pa.array(most), "count_sum": pa.array(total)}
    names = [c.split()[0] for c in _RESULT.split(", ")]
    return pa.table({c: added.get(c, None) if c in added else texts.column(c) for c in names})


def align_documents(docs: DataFrame, left: str, right: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Token, group and link counts of each text, how many links are the most frequent ones of their left id, and the sum of their counts."""
    blocks = aligned_blocks(docs, left, right, block_bytes)
    entries = pair_entries(blocks)
    counts = pair_counts(entries, len(right_tokens(right))).select("pair", "n", "best")
    answers = entries.join(counts, "pair").select(F.col("block").alias("of_block"), "slot", "n", "best")
    texts = blocks.where("pairs is null").drop("pairs", "holders")
    return texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(_with_counts, _RESULT)


def vocabulary_links(docs: DataFrame, left: str, right: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``a, b, n, best``: the id pairs linked anywhere, in how many texts, and the best partners of each left id."""
    return pair_counts(pair_entries(aligned_blocks(docs, left, right, block_bytes)), len(right_tokens(right))).select("a", "b", "n", "best")
