"""Language-model scores from a probabilistic suffix tree over words.

The symbols are lower-cased words and one end per text. The root holds the counts of all words of the training texts. A context,
a run of up to ``max_order`` words, has an own entry for each next symbol that follows it ``min_count`` times or more. It is retained when its
next-symbol distribution diverges from that of its longest retained suffix: training tokens must gain more in log-likelihood
than the context's parameters cost (half a log of its count each). Distributions are smoothed by absolute discounting; what is
taken off goes to the symbols without an own entry, in the proportions of the longest retained suffix, and at the root to one
unknown symbol. A token is scored from the state of its longest retained suffix.

The tree grows with the texts and is never in one place, nor sent anywhere whole. ``dictionary`` joins counts with the words of blocks of texts.
Then, order by order, each block asks once for every distinct run of words that can be an entry, in packed shares dealt by hash. The
runs' counts come back in the order asked. Of the blocks that hold a run one gives its share to the sums of its context, which all blocks
ask for alike; from the sums follows whether the context is retained, and its factor. A run is asked for only if both runs one word
shorter in it are frequent, as no other can be. However frequent a run is, it is one entry per block.

Rows: one row out per row in. A null text is empty; an empty text is one end. A null id counts as training. Texts are processed whole,
repeated rows are scored alike, an empty table gives an empty table; without training texts every token has probability one.
Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.dictionary import FAST, Block, Bucket, answer_buckets, blocks, bucket_count, drop_stored, expand, pack, put_back, squeeze, stored_packed, unpack
from gradeloom.llm.textbatch import LOWER, mix, split_words, text_bytes

MIN_COUNT = 2
BLOCK_BYTES = 12 << 20
SHARES = 4  # buckets a shuffle partition
MAX_ORDER = 3
DISCOUNT = 0.75

_END = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_COLUMNS = "block bigint, doc_ids array<bigint>, n_pieces array<bigint>, slots binary, counts binary, keys binary"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(texts)
    words = split_words(LOWER[data], offsets)
    return words.data, words.offsets, words.first


def held_out(doc_ids: list, folds: int = 7, fold: int = 2) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % folds == fold for i in doc_ids], dtype=bool)


@dataclass
class Level:
    """Contexts of one length. ``keys`` are all candidates (shorter context's number << 32 | last word), sorted.

    ``entries`` are ``context << 32 | next word`` with an own probability, sorted; ``back`` the factor (log10) for all other next words of a
    retained context; ``retained`` says which contexts are states.
    """

    keys: np.ndarray
    entries: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    logs: np.ndarray = field(default_factory=lambda: np.empty(0))
    back: np.ndarray = field(default_factory=lambda: np.empty(0))
    retained: np.ndarray = field(default_factory=lambda: np.empty(0, bool))


@dataclass
class Tree:
    """``words``: sorted keys of frequent words; a word's number is its place plus one, the end's number is 0."""

    n: int
    v: int
    discount: float
    n_ends: int
    words: np.ndarray
    word_counts: np.ndarray
    levels: list[Level]

    def root(self, counts: np.ndarray) -> np.ndarray:
        """log10 probabilities of words by their counts, 0 for unknown ones."""
        if not self.n:
            return np.zeros(len(counts))
        unknown = self.discount * self.v / self.n
        return np.log10(np.where(counts > 0, counts - self.discount, 0) / self.n + np.where(counts > 0, 0, unknown))


def find(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of values in sorted keys, -1 where they are not."""
    if not len(keys):
        return np.full(len(values), -1)
    place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[place] == values, place, -1)


def sorted_order(keys: np.ndarray) -> np.ndarray:
    """The order that sorts 64-bit hashes, equal ones by place. Values sort much faster than places, so the place takes the lowest bits."""
    bits = np.uint64(max(1, len(keys) - 1).bit_length())
    packed = (keys >> bits << bits) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = keys[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(keys, kind="stable")  # two keys may differ in those bits only


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of keys, where each distinct key starts in it, and the number of each ordered key among the distinct ones."""
    order = sorted_order(keys)
    found = keys[order]
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return order, np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - 1


def numbers(slots: np.ndarray, n_pieces: np.ndarray, slot_keys: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all tokens of a block, an end after each text (-1: not frequent), and the texts' borders."""
    by_slot = find(words, slot_keys)
    by_slot = np.where((slot_keys != 0) & (by_slot >= 0), by_slot + 1, -1)
    ends = np.cumsum(n_pieces)
    return np.insert(by_slot[slots], ends, _END), np.concatenate(([0], np.cumsum(n_pieces + 1)))


def contexts(number: np.ndarray, levels: list[Level]) -> list[np.ndarray]:
    """Per length, the number of the context that ends at each token, -1 for none. Ends belong to no context, so none crosses texts."""
    out = [np.where(number == _END, -1, number)]
    for level in levels[1:]:
        shorter = np.concatenate(([-1], out[-1][:-1]))
        out.append(np.where((shorter >= 0) & (out[0] >= 0), find(level.keys, (shorter << 32) | np.maximum(out[0], 0)), -1))
    return out


def _count_next(tree: Tree):
    """Per block how often each frequent word follows each context of the last level, in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n_pieces = np.array(r["n_pieces"], np.int64)
                number, _ = numbers(unpack(r["slots"]), n_pieces, unpack(r["keys"], 8), tree.words)
                context = contexts(number, tree.levels)[-1][:-1]
                training = np.repeat(~held_out(r["doc_ids"]), n_pieces + 1)[1:]
                use = (context >= 0) & (number[1:] >= 0) & training
                found, n = np.unique((context[use] << 32) | number[1:][use], return_counts=True)
                yield pa.RecordBatch.from_pydict({"pair": pa.array(found), "n": pa.array(n)})

    return run


def _retain(tree: Tree, level: Level, counts: np.ndarray, pairs: np.ndarray, n: np.ndarray, memory: list[dict], order: int, suffix: np.ndarray) -> None:
    """Test each context against its longest retained suffix and set its entries.

    ``memory`` holds, per length, log10 probabilities of states' entries and factors, to follow suffixes; ``suffix`` gives the context's
    number one shorter (its oldest word dropped).
    """
    own = pairs >> 32
    starts = np.searchsorted(own, np.arange(len(level.keys) + 1))
    nexts = pairs & 0xFFFFFFFF
    level.retained = np.zeros(len(level.keys), bool)
    level.back = np.zeros(len(level.keys))
    entries, logs = [], []
    for c in np.flatnonzero(np.diff(starts)).tolist():
        mine = slice(starts[c], starts[c + 1])
        a, k = nexts[mine], n[mine]
        below = np.array([tree_log10(tree, memory, order - 1, int(suffix[c]), int(x)) for x in a.tolist()])
        total = float(counts[c])
        rest, rest_below = max(total - k.sum(), 0.0), max(1 - (10**below).sum(), 1e-9)
        gain = (k * (np.log(k / total) - below * np.log(10))).sum() + (rest * np.log(rest / total / rest_below) if rest else 0)
        if gain <= 0.5 * np.log(total) * (len(a) + 1):
            continue
        p = (k - DISCOUNT) / total
        level.retained[c] = True
        level.back[c] = np.log10(max(1 - p.sum(), 1e-9) / rest_below)
        entries.append((c << 32) | a)
        logs.append(np.log10(p))
    if entries:
        level.entries, level.logs = np.concatenate(entries), np.concatenate(logs)
    memory.append({"entries": dict(zip(level.entries.tolist(), level.logs.tolist())), "suffix": suffix})


def tree_log10(tree: Tree, memory: list[dict], order: int, context: int, word: int) -> float:
    """log10 probability of a frequent word after a context of the given length, or its longest retained suffix."""
    if order == 0:
        count = tree.n_ends if word == _END else tree.word_counts[word - 1]
        return float(tree.root(np.array([count]))[0])
    below = lambda: tree_log10(tree, memory, order - 1, int(memory[order - 1]["suffix"][context]), word)
    if not tree.levels[order - 1].retained[context]:
        return below()
    known = memory[order - 1]["entries"].get((context << 32) | word)
    return known if known is not None else below() + float(tree.levels[order - 1].back[context])


def _facts(floor: float, listed: bool):
    """Counts of all words, keys of frequent ones (the bucket and the rank by count in it), and once per bucket what the driver needs of it."""

    def answer(bucket: Bucket):
        total = np.bincount(bucket.codes, bucket.counts, len(bucket.words)).astype(np.int64)
        often = total >= max(floor, 1)
        keys = np.zeros(len(total), np.int64)
        keys[np.flatnonzero(often)[np.argsort(-total[often], kind="stable")]] = (bucket.number << 32) + 1 + np.arange(often.sum())
        facts = [json.dumps([int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum()), *([keys[often].tolist(), total[often].tolist()] if listed else [])]).encode()]
        return {"counts": lambda codes: pack(total[codes], 8, FAST), "keys": lambda codes: pack(keys[codes], 8, FAST), "facts": lambda codes: facts.pop() if facts else None}

    return answer


def _finish_counts(block: Block) -> pa.RecordBatch:
    def flat(name: str) -> np.ndarray:
        return block.by_slot(np.concatenate([np.empty(0, np.int64), *(unpack(x, 8) for x in block.answers[name])]))

    out = {"block": block.number, "doc_ids": block.doc_ids, "n_pieces": block.n_pieces.tolist(), "slots": pack(block.slots, level=FAST), "counts": pack(flat("counts"), 8, FAST), "keys": pack(flat("keys"), 8, FAST)}
    kinds = {"block": pa.int64(), "doc_ids": pa.list_(pa.int64()), "n_pieces": pa.list_(pa.int64())}
    return pa.RecordBatch.from_pydict({c: pa.array([v], kinds.get(c, pa.binary())) for c, v in out.items()})


def root_counts(docs: DataFrame, min_count: int, min_share: float, listed: bool) -> tuple[DataFrame, Tree, int]:
    """Blocks of all texts with their words' counts, stored, the root, and how often what is frequent occurs; ``listed`` has frequent words in the tree."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shares = blocks(narrow, words_of, counted=lambda ids: ~held_out(ids), block_bytes=BLOCK_BYTES, level=FAST)
    each = shares.where("bucket = -1").select(F.explode(F.arrays_zip("doc_ids", "n_pieces")).alias("x")).select("x.doc_ids", "x.n_pieces")
    training = each.where(F.coalesce(F.crc32(F.col("doc_ids").cast("string").cast("binary")) % 7 != 2, F.lit(True)))
    n_ends, n_words = (x or 0 for x in training.agg(F.count("*"), F.sum("n_pieces")).first())
    n = n_ends + n_words
    floor = max(min_count, math.ceil(min_share * n))
    answers = stored_packed(answer_buckets(shares, ["counts", "keys", "facts"], _facts(floor, listed)), "word-counts")
    facts = [json.loads(bytes(r["facts"])) for r in answers.where("facts is not null").select("facts").collect()]  # a row per bucket
    v, ones, twos = (sum(x[i] for x in facts) for i in range(3))
    frequent = sorted((k, c) for x in facts for k, c in zip(*x[3:])) if listed else []
    words = np.array([k for k, _ in frequent], np.int64)
    word_counts = np.array([c for _, c in frequent], np.int64)
    discount = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones and twos else 0.5
    ready = stored_packed(put_back(shares, answers.drop("facts"), _WORD_COLUMNS, lambda block: [_finish_counts(block)]), "words")
    for done in (shares, answers):
        drop_stored(done)
    return ready, Tree(n, v + (n_ends > 0), discount, n_ends, words, word_counts, []), floor


def build(docs: DataFrame, min_share: float, max_order: int = MAX_ORDER) -> tuple[DataFrame, Tree]:
    """Blocks of all texts with their words' counts, stored, and the tree in one place, to be looked at: what is rarer than a share of the
    training tokens is left out of it. ``score_documents`` has no use for it."""
    ready, tree, floor = root_counts(docs, 1, min_share, True)
    words, word_counts, n_ends = tree.words, tree.word_counts, tree.n_ends

    memory: list[dict] = []
    level = Level(np.arange(len(words) + 1, dtype=np.int64))
    counts, suffix = np.concatenate(([n_ends], word_counts)), np.zeros(len(words) + 1, np.int64)
    for order in range(1, max_order + 1):
        tree.levels.append(level)
        pairs = ready.mapInArrow(_count_next(tree), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        rows = pairs.where(F.col("n") >= max(floor, 2)).collect()  # at most 1 / min_share
        rows.sort()
        found = np.array([r["pair"] for r in rows], np.int64)
        n_found = np.array([r["n"] for r in rows], np.int64)
        _retain(tree, level, counts, found, n_found, memory, order, suffix)
        longer = (found & 0xFFFFFFFF) != _END
        found, counts = found[longer], n_found[longer]
        if not len(found) or order == max_order:
            break
        # the context without its oldest word: the suffix of its head, continued by its last word
        heads = suffix[found >> 32]
        last = found & 0xFFFFFFFF
        suffix = last if order == 1 else find(level.keys, (heads << 32) | last)
        level = Level(found)
    return ready, tree


class Runs:
    """The tokens of a block, and the runs of words that end at each.

    ``runs`` are the distinct runs' keys, sorted, ``n`` how often each occurs in training texts (0: not frequent), ``place`` the run at each
    token (-1: none). The run before a token is its context: ``contexts``, ``context_n`` and ``context_place`` are the same for those.
    ``words`` and ``counts`` are those of the block's words, ``slots`` the word at each token.
    """

    def __init__(self, r: dict, tree: Tree, floor: int):
        self.n_pieces = np.array(r["n_pieces"], np.int64)
        ends = np.cumsum(self.n_pieces)
        counts, keys = (np.append(unpack(r[c], 8), x) for c, x in (("counts", tree.n_ends), ("keys", _END)))
        keys = mix(keys.astype(np.uint64))
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        self.words = self.runs = keys[order]
        self.counts = counts[order]
        self.slots = self.place = np.insert(rank[unpack(r["slots"])], ends, rank[-1])
        self.n = np.where(self.counts >= floor, self.counts, 0)
        self.is_end = self.slots == rank[-1]
        self.training = np.repeat(~held_out(r["doc_ids"]), self.n_pieces + 1)
        self.log = tree.root(self.counts)[self.slots]

    def longer(self) -> None:
        """Runs one word longer. Ends belong to no context, so none crosses texts."""
        often = (self.place >= 0) & (self.n[self.place] > 0) if len(self.n) else np.zeros(len(self.place), bool)
        self.contexts, self.context_n = self.runs, self.n
        self.context_place = np.full(len(self.place), -1, np.int32)
        self.context_place[1:] = np.where(often & ~self.is_end, self.place, -1)[:-1]
        self.asked = np.flatnonzero(often & (self.context_place >= 0))
        keys = mix((self.contexts * _STEP)[self.context_place[self.asked]] + self.words[self.slots[self.asked]])
        order, starts, rank = distinct(keys)
        self.runs = keys[order[starts]]
        self.place = np.full(len(self.place), -1, np.int32)
        self.place[self.asked[order]] = rank

    def answered(self, answers: np.ndarray) -> None:
        self.n, self.own = answers >> 1, answers & 1 == 1

    def retain(self, backs: np.ndarray) -> None:
        """Take the factors of the frequent contexts: scores are then those of the tree up to this order."""
        back = np.full(len(self.contexts), np.nan)
        back[self.context_n > 0] = backs
        at = np.flatnonzero(self.context_place >= 0)
        factor = back[self.context_place[at]]
        kept = ~np.isnan(factor)
        at = at[kept]
        self.log[at] += factor[kept]
        at = at[self.place[at] >= 0]
        n = self.n[self.place[at]]
        at, n = at[n > 0], n[n > 0]
        self.log[at] = np.log10((n - DISCOUNT) / self.context_n[self.context_place[at]])

    def sums(self) -> np.ndarray:
        """Per frequent context: its count, and over those of its entries that this block accounts for, their number, the sums of their
        counts, of the gain in log-likelihood but for the context's count, and of their probabilities in the shorter context."""
        at = np.empty(len(self.runs), np.int64)
        at[self.place[self.asked]] = self.asked
        at = at[self.own]
        context, k, below = self.context_place[at], self.n[self.place[at]], self.log[at]
        sums = [np.bincount(context, x, len(self.contexts)) for x in (np.ones(len(at)), k, k * (np.log(k) - below * np.log(10)), 10**below)]
        return np.stack([self.context_n, *sums])[:, self.context_n > 0]


def _factors(context_n: np.ndarray, entries: np.ndarray, k: np.ndarray, k_gain: np.ndarray, p_below: np.ndarray) -> np.ndarray:
    """log10 factors of contexts from their sums, NaN for those not retained."""
    context_n = np.maximum(context_n, 1)
    rest, rest_below = np.maximum(context_n - k, 0), np.maximum(1 - p_below, 1e-9)
    gain = k_gain - k * np.log(context_n) + rest * np.log(np.maximum(rest, 1) / context_n / rest_below)
    left = np.maximum(1 - (k - DISCOUNT * entries) / context_n, 1e-9)
    return np.where((entries > 0) & (gain > 0.5 * np.log(context_n) * (entries + 1)), np.log10(left / rest_below), np.nan)


_ASKED = "block bigint, order int, is_context boolean, bucket int, keys binary, n binary, sums binary"
_ANSWERED = "block bigint, order int, is_context boolean, bucket int, answers binary"


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the steps to the next ones: as many bytes of each as a common step takes, and the few larger ones'
    upper bytes compressed."""
    steps = np.diff(keys)
    width = max(1, (int(keys[-1] - keys[0]) // max(1, len(steps))).bit_length() + 7 >> 3)
    raw = steps.view(np.uint8).reshape(-1, 8)
    upper = squeeze(np.ascontiguousarray(raw[:, width:].T).tobytes(), FAST)
    return keys[:1].tobytes() + bytes([width]) + len(upper).to_bytes(8, "little") + upper + np.ascontiguousarray(raw[:, :width]).tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    width, low = data[8], 17 + int.from_bytes(data[9:17], "little")
    steps = np.zeros(((len(data) - low) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, offset=low).reshape(-1, width)
    steps[:, width:] = np.frombuffer(expand(data[17:low]), np.uint8).reshape(8 - width, len(steps)).T
    return np.cumsum(np.concatenate((np.frombuffer(data, np.uint64, 1), steps.view(np.uint64).ravel())), dtype=np.uint64)


def _pack_floats(values: np.ndarray) -> bytes:
    """Which values are there, not NaN, and those by planes of bytes."""
    there = ~np.isnan(values)
    return len(values).to_bytes(8, "little") + squeeze(np.packbits(there).tobytes() + np.ascontiguousarray(values[there].view(np.uint8).reshape(-1, 8).T).tobytes(), FAST)


def _unpack_floats(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(expand(data[8:]), np.uint8)
    there = np.unpackbits(raw[: (size + 7) // 8], count=size).astype(bool)
    out = np.full(size, np.nan)
    out[there] = np.ascontiguousarray(raw[(size + 7) // 8 :].reshape(8, -1).T).view(np.float64).ravel()
    return out


def _asked(block: int, order: int, keys: np.ndarray, n_buckets: int, n: np.ndarray | None = None, sums: np.ndarray | None = None) -> pa.RecordBatch:
    """Sorted keys dealt to buckets in their order, with runs' counts, or with contexts' sums where there are some."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    parts = [slice(a, b) for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(keys)])]

    def filled(x: slice) -> bytes:
        at = np.flatnonzero(sums[1, x])
        whole = pack(np.concatenate((np.diff(at, prepend=0), sums[:3, x][:, at].astype(np.int64).ravel())), 8, FAST)
        return len(whole).to_bytes(8, "little") + whole + _pack_floats(sums[3:, x][:, at].ravel())

    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([block] * len(parts), pa.int64()),
            "order": pa.array([order] * len(parts), pa.int32()),
            "is_context": pa.array([n is None] * len(parts), pa.bool_()),
            "bucket": pa.array(bucket[starts], pa.int32()),
            "keys": pa.array([_pack_keys(keys[x]) for x in parts], pa.binary()),
            "n": pa.array([None if n is None else pack(n[x], level=FAST) for x in parts], pa.binary()),
            "sums": pa.array([None if sums is None else filled(x) for x in parts], pa.binary()),
        }
    )


def _with_answers(ready: DataFrame, answers: DataFrame | None, tree: Tree, floor: int, counted: int, retained: int, schema: str, finish) -> DataFrame:
    """What ``finish`` makes of each block's runs after the answers of so many orders, for runs and for contexts."""
    own = ("block", "doc_ids", "n_pieces", "slots", "counts", "keys")
    rows = ready.select(*own, F.lit(0).alias("order"), F.lit(False).alias("is_context"), F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("answers"))
    if answers is not None:
        rows = rows.unionByName(answers, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "order", "is_context", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, {}

        def flush() -> Iterator[pa.RecordBatch]:
            if head is None or not len(head["doc_ids"]):
                return
            runs = Runs(head, tree, floor)
            for order in range(1, counted + 1):
                runs.longer()
                runs.answered(np.concatenate([np.empty(0, np.int64), *(unpack(x, 8) for x in held.get((order, False), []))]))
                if order <= retained:
                    runs.retain(np.concatenate([np.empty(0), *(_unpack_floats(x) for x in held.get((order, True), []))]))
            yield from finish(head, runs)

        for batch in batches:
            for k in range(batch.num_rows):
                order = batch.column("order")[k].as_py()
                if not order:
                    yield from flush()
                    head, held = {c: batch.column(c)[k].as_py() for c in own}, {}
                else:
                    held.setdefault((order, batch.column("is_context")[k].as_py()), []).append(batch.column("answers")[k].as_py())
        yield from flush()

    return rows.mapInArrow(run, schema)


def _answers(floor: int):
    """Per bucket, twice the runs' counts over all blocks, 0 for rare ones, and one more for the first block that has the run; factors of contexts."""

    def flush(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        keys = [_unpack_keys(r["keys"]) for r in rows]
        borders = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        order, starts, rank = distinct(np.concatenate(keys))
        if rows[0]["is_context"]:
            place = np.empty(len(order), np.int64)
            place[order] = rank
            sums = np.zeros((5, len(starts)))
            for r, start in zip(rows, borders.tolist()):
                size = 8 + int.from_bytes(r["sums"][:8], "little")
                steps, context_n, entries, k = unpack(r["sums"][8:size], 8).reshape(4, -1)
                at = place[start + np.cumsum(steps)]
                sums[0, at] = context_n
                sums[1:, at] += np.stack([entries, k, *_unpack_floats(r["sums"][size:]).reshape(2, -1)])  # a block has a context once
            answers = _factors(*sums)[place]
        else:
            total = np.add.reduceat(np.concatenate([unpack(r["n"]) for r in rows])[order], starts)
            total[total < floor] = 0
            answers = np.empty(len(order), np.int64)
            answers[order] = 2 * total[rank]
            answers[order[starts]] += total > 0
        parts = [answers[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([r["block"] for r in rows], pa.int64()),
                "order": pa.array([r["order"] for r in rows], pa.int32()),
                "is_context": pa.array([r["is_context"] for r in rows], pa.bool_()),
                "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
                "answers": pa.array([_pack_floats(x) if rows[0]["is_context"] else pack(x, 8, FAST) for x in parts], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and (r["bucket"], r["is_context"]) != (held[0]["bucket"], held[0]["is_context"]):
                    yield from flush(held)
                    held = []
                held.append(r)
        if held:
            yield from flush(held)

    return run


def score_documents(docs: DataFrame, min_count: int = MIN_COUNT, max_order: int = MAX_ORDER, min_share: float = 0.0) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    ``min_share`` raises ``min_count`` to a share of the training tokens, for a smaller tree; there is none by default.
    """
    ready, tree, floor = root_counts(docs, max(min_count, 2), min_share, False)
    n_buckets = SHARES * bucket_count(docs)
    answers: DataFrame | None = None

    def ask(order: int):
        def finish(r: dict, runs: Runs) -> Iterator[pa.RecordBatch]:
            if order > 1:
                yield _asked(r["block"], order - 1, runs.contexts[runs.context_n > 0], n_buckets, sums=runs.sums())
            if order <= max_order:
                runs.longer()
                n = np.bincount(runs.place[runs.asked], runs.training[runs.asked], len(runs.runs)).astype(np.int64)
                yield _asked(r["block"], order, runs.runs, n_buckets, n)

        return finish

    for order in range(1, max_order + 2 if tree.n else 0):
        asked = _with_answers(ready, answers, tree, floor, order - 1, order - 2, _ASKED, ask(order))
        last = order > max_order  # the most answers are dealt for the fewest questions, so what dealt them goes before those are dealt
        asked = stored_packed(asked, "asked") if last else asked
        dealt = asked.repartition("bucket").sortWithinPartitions("bucket", "is_context", "block")
        found = stored_packed(dealt.mapInArrow(_answers(floor), _ANSWERED), "runs")
        if last:
            drop_stored(asked)
        answers = found if answers is None else answers.unionByName(found)

    def score(r: dict, runs: Runs) -> Iterator[pa.RecordBatch]:
        base = np.log10((runs.counts + 1) / (tree.n + tree.v + 1))[runs.slots]
        starts = np.cumsum(runs.n_pieces + 1) - runs.n_pieces - 1
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(r["doc_ids"], pa.int64()),
                "held_out": pa.array(held_out(r["doc_ids"])),
                "n_tokens": pa.array(runs.n_pieces + 1),
                "n_known": pa.array(np.add.reduceat((runs.counts > 0).astype(np.int64)[runs.slots], starts)),
                "train_tokens": pa.array(np.full(len(starts), tree.n)),
                "base_score": pa.array(np.add.reduceat(base, starts)),
                "score": pa.array(np.add.reduceat(runs.log, starts)),
            }
        )

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    last = max_order if tree.n else 0
    return _with_answers(ready, answers, tree, floor, last, last, schema, score)
