"""Token ids in files, packed by an adaptive context-mixing range coder.

Texts are put in ascending order of their ids by a range partitioning; the task of a range encodes each distinct pre-token once
while its Python worker remembers it, and writes one file, so files in the order of their names hold ascending ids. A text that holds a control string
of the vocabulary is encoded whole by the tokenizer, which gives the string its own id. A file record holds consecutive documents: their ids, their numbers of tokens, and coded blocks of ``BLOCK_IDS`` token ids. Each block
starts from a fresh model and carries a CRC-32 of its ids, so it can be read, checked and decoded on its own.

The model predicts the next id by the last follower of the two ids before it (order 2), of the one id before it (order 1), and
by adaptive frequencies of id classes (order 0). The predictions are mixed into one distribution: orders 2 and 1 get weights that
adapt to their hits, per confidence and agreement; the rest goes to order 0. A range coder codes follower or class in one step by that
distribution; ids of a class are alike, so the place within it follows in plain bits. Many blocks are coded side by side with numpy,
one id of each per step; decoding does the same steps.

Rows: one row out per row in. A null text is empty; every document gets the end id, so each has at least one. Rows that share an id
follow one another in the order of their texts, a null id comes first. Texts are processed whole. An empty table writes no record and gives an empty
table. A damaged block raises an error that names it. Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom.llm.bpe import pre_tokens
from gradeloom.llm.textbatch import byte_array, slices
from gradeloom.llm.word_ids import WordIds

BLOCK_IDS = 4096
RECORD_BYTES = 24 << 20  # of text in a record, about; a small one takes as many steps to code
KNOWN_WORDS = 1 << 20  # distinct pre-tokens a Python worker remembers
PART = 1 << 13  # words that are encoded in one go
LINES = 512  # words that are encoded as lines of one text
_SETTLED = 0xD4  # bytes of characters below U+0500 are below; their classes have been the same since Unicode 7
SLICE_BYTES = 2 << 20  # of text whose words are told apart at once
VERSION = 2
_ID = attrgetter("id")

_TABLE = 11  # bits of a follower table
_CLASS_BITS = 10  # class frequencies add up to 2^10
_TOTAL = np.uint64(16 + _CLASS_BITS)
_EARLY = (4, 16, 64, 128)  # steps before which class frequencies are made anew, and every so many later
_REFRESH = 256
_BY_FOLLOWER = 127  # in place of a class
_ONE = np.uint32(1 << 16)
# The mix of orders 2 and 1 by the confidence of order 2, less 1 (modulo 4), that of order 1, and whether they agree: shares of order 2,
# and of order 1 in the rest, in the halves of a number. Both lose a 32nd of what is above the least share, and rise by hits.
_MIXES = 16
_MIX = (np.repeat(np.array([12000, 36000, 52000, 64], np.uint32), 4) << 16) + np.uint32(6000)
_UNSURE, _RATE, _HIT = 12, np.uint32(5), np.uint32(2032)
_FLOOR, _BOTH, _HIGH, _LOW = np.uint32(33 << 16 | 33), np.uint32(0x07FF07FF), np.uint32(0x07FF0000), np.uint32(0x07FF)
_HIT2, _HIT1 = np.uint8(16), np.uint8(32)  # beside the mix in the flags of an id
_FALLS = np.array([_BOTH, _HIGH, _BOTH, _HIGH])  # by these flags; order 1 learns nothing where order 2 hits
_RISES = np.array([0, _HIT << 16, _HIT, _HIT << 16], np.uint32)
_ROWS, _STEPS = 64, 64  # blocks, and steps, whose predictions the encoder finds at once
_WORD, _SHORT, _LOW_WORD, _U1 = np.uint64(32), np.uint64(1 << 32), np.uint64((1 << 32) - 1), np.uint64(1)


@lru_cache(maxsize=2)
def _classes(n_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every id, first id of each class, and bits of each class: four classes per power of two."""
    lows, bits, at = [], [], 0
    while at < n_ids:
        width = max(0, int(at + 1).bit_length() - 3)
        lows.append(at)
        bits.append(width)
        at += 1 << width
    lows = np.array(lows, np.int64)
    return (np.searchsorted(lows, np.arange(n_ids), side="right") - 1).astype(np.uint8), lows, np.array(bits, np.int64)


@lru_cache(maxsize=2)
def _hashes(n_ids: int) -> np.ndarray:
    """Places of an id in a follower table, as the one before in the upper half and as the last id in the lower."""
    ids = np.arange(n_ids)
    mask = (1 << _TABLE) - 1
    return ((((ids * 9973) >> 3) & mask) << 16 | ((ids * 40503) >> 4) & mask).astype(np.int32)


class _Frequencies:
    """Adaptive frequencies of id classes for ``lanes`` blocks side by side, made from the ids that order 0 coded."""

    def __init__(self, lanes: int, steps: int, n_ids: int, decoding: bool = False):
        self.lanes, self.decoding = lanes, decoding
        self.class_of, self.class_low, self.class_bits = _classes(n_ids)
        self.n_classes = len(self.class_low)
        self.lane = np.arange(lanes)
        self.counts = np.ones((self.n_classes, lanes), np.int64)
        self.coded = np.full((steps, lanes), _BY_FOLLOWER, np.uint8)  # classes, but only of ids that order 0 coded
        self.counted = 0

    def renew(self, step: int) -> None:
        """Class frequencies from the ids coded by class before ``step``: first of a class and size as the halves of a number."""
        new = self.coded[self.counted : step]
        if len(new):
            found = np.bincount(self.at(new).ravel(), minlength=self.lanes * (_BY_FOLLOWER + 1))
            self.counts += 32 * found[: self.counts.size].reshape(self.counts.shape)
        self.counted = step
        room = (1 << _CLASS_BITS) - self.n_classes
        sizes = self.counts * room // self.counts.sum(axis=0) + 1
        sizes[-1] += (1 << _CLASS_BITS) - sizes.sum(axis=0)
        self.table = (((np.cumsum(sizes, axis=0) - sizes) << 16) | sizes).astype(np.uint32).ravel()
        if self.decoding:
            self.look = np.repeat(np.tile(np.arange(self.n_classes, dtype=np.uint8), self.lanes), sizes.T.ravel())

    def at(self, kinds: np.ndarray) -> np.ndarray:
        """Places of classes in the table: blocks side by side, so that frequent classes share memory pages."""
        return np.multiply(kinds, self.lanes, dtype=np.int64) + self.lane


def _shares(mix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shares of 2^16 of orders 2, 1 and 0."""
    share2 = mix >> 16
    rest = _ONE - share2
    share1 = (rest * (mix & 0xFFFF) >> 16) + 1
    return share2, share1, rest - share1


def _renewed(step: int) -> bool:
    return step % _REFRESH == 0 or step in _EARLY


def _followers(ids: np.ndarray, places: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """What a follower table says before each id of blocks, one per row, as all ids are known: the last id that followed at the id's
    place, else ``none``; and its confidence, 1 to 3 by hits in a row, or 0."""
    lanes, steps = ids.shape
    bits = steps.bit_length()
    order = (places.astype(np.uint32) << bits) | np.arange(steps, dtype=np.uint32)
    order.sort(axis=1)
    same = np.zeros((lanes, steps), bool)
    same[:, 1:] = (order[:, 1:] ^ order[:, :-1]) < (1 << bits)  # at the place of the one before it
    at = (order & ((1 << bits) - 1)) + (np.arange(lanes) * steps)[:, None]
    own = ids.ravel().take(at)
    found = np.full((lanes, steps), none, ids.dtype)
    np.copyto(found[:, 1:], own[:, :-1], where=same[:, 1:])
    hit = np.zeros((lanes, steps), bool)  # the one before it was a hit
    hit[:, 1:] = (found == own)[:, :-1] & same[:, 1:]
    sure = same.view(np.uint8) + hit
    sure[:, 1:] += hit[:, 1:] & hit[:, :-1]
    said = np.empty(ids.size, ids.dtype)
    said[at.ravel()] = ((found << 2) + sure).ravel()
    said = said.reshape(ids.shape)
    return said >> 2, (said & 3).astype(np.uint8)


def _flags(ids: np.ndarray, n_ids: int) -> np.ndarray:
    """For each id of blocks, one per row: what the mix of orders 2 and 1 goes by (``_MIXES`` values), and the hits of both."""
    hashed = _hashes(n_ids).take(ids)
    places = np.zeros(ids.shape, np.int32)
    places[:, 1:] = hashed[:, :-1] & 0xFFFF
    id1, sure1 = _followers(ids, places, n_ids)
    places[:, 2:] ^= hashed[:, :-2] >> 16
    id2, sure2 = _followers(ids, places, n_ids)
    return ((sure2 - 1 & 3) << 2) + ((sure1 > 1) << 1) + (id1 == id2) + _HIT2 * (ids == id2) + _HIT1 * (ids == id1)


def encode_blocks(ids: np.ndarray, n_ids: int) -> list[bytes]:
    """Codes blocks of equal length, one per row: number of range-coded words, those words, and the bits of ids within their classes.

    All ids are known, so what the orders predict is found for many steps at once; only the mix and the coder go step by step.
    """
    lanes, steps = ids.shape
    model = _Frequencies(lanes, steps, n_ids)
    flags, within = np.empty((steps, lanes), np.uint8), []
    for at in range(0, lanes, _ROWS):
        part = slice(at, at + _ROWS)
        own = ids[part].astype(np.int32)
        known = _flags(own, n_ids)
        kinds = np.where(known < _HIT2, model.class_of.take(own), np.uint8(_BY_FOLLOWER))
        flags[:, part], model.coded[:, part] = known.T, kinds.T
        within += _pack_bits(own, kinds, model.class_low, model.class_bits)
    lane = np.arange(lanes)
    mixes, by_mix = np.tile(_MIX, lanes), lane * _MIXES
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    words = np.zeros((steps + 8) * lanes, np.uint64)  # an id takes less than a word
    end = lane.copy()  # the place of a block's next word
    starts = [k for k in range(steps) if k % _STEPS == 0 or _renewed(k)]
    for begin, stop in zip(starts, [*starts[1:], steps]):
        if _renewed(begin):
            model.renew(begin)
        known = flags[begin:stop]
        at, outcome = by_mix + (known & (_MIXES - 1)), known >> 4
        falls, rises, mix = _FALLS.take(outcome), _RISES.take(outcome), np.empty(known.shape, np.uint32)
        for places, fall, rise, now in zip(at, falls, rises, mix):
            mixes.take(places, out=now, mode="clip")
            less = now - _FLOOR
            less >>= _RATE
            less &= fall
            rise += now
            rise -= less
            mixes[places] = rise
        share2, share1, share0 = _shares(mix)
        table = model.table.take(model.at(model.coded[begin:stop]), mode="clip")
        first, second = share2 << _CLASS_BITS, share1 << _CLASS_BITS
        start, size = first + second + (table >> 16) * share0, (table & 0xFFFF) * share0
        few = (known >= _HIT2).ravel().nonzero()[0]  # coded by a follower
        hit2, own = (known.ravel().take(few) & _HIT2) > 0, first.ravel().take(few)
        start.ravel()[few], size.ravel()[few] = own * ~hit2, np.where(hit2, own, second.ravel().take(few))
        start, size = start.astype(np.uint64), size.astype(np.uint64)
        for add, times in zip(start, size):
            width >>= _TOTAL
            add *= width
            low += add
            width *= times
            who = (low < add).nonzero()[0]  # a carry
            if len(who):
                words[end.take(who) - lanes] += _U1
            who = (width < _SHORT).nonzero()[0]
            if len(who):
                own, place = low.take(who), end.take(who)
                words[place] = own >> _WORD
                end[who] = place + lanes
                low[who] = own << _WORD
                width[who] = width.take(who) << _WORD
    for _ in range(2):
        words[end] = low >> _WORD
        low <<= _WORD
        end += lanes
    n = end // lanes
    words = words.reshape(-1, lanes)[: n.max()]
    for k in range(len(words) - 1, 0, -1):  # carries that wait in a word
        words[k - 1] += words[k] >> _WORD
    coded = np.ascontiguousarray(words.astype("<u4").T)
    return [int(size).to_bytes(4, "little") + row[:size].tobytes() + tail for row, size, tail in zip(coded, n.tolist(), within)]


def _pack_bits(ids: np.ndarray, kinds: np.ndarray, low: np.ndarray, bits: np.ndarray) -> list[bytes]:
    """The bits of each row's ids within their classes, one after another; none of those that a follower predicts."""
    plain = kinds.ravel() != _BY_FOLLOWER
    own = kinds.ravel()[plain]
    values, size_of = ids.ravel()[plain] - low.take(own), bits.take(own)
    borders = np.concatenate(([0], np.cumsum(np.count_nonzero(plain.reshape(kinds.shape), axis=1))))
    ends = np.concatenate(([0], np.cumsum(size_of)))
    total = np.diff(ends[borders])
    size = (total + 31) >> 5
    first = np.cumsum(size) - size
    at = ends[:-1] + np.repeat((first << 5) - ends[borders[:-1]], np.diff(borders))
    # two words hold each value; sums of different bits are exact
    pair = values.astype(np.uint64) << (64 - (at & 31) - size_of).clip(0, 63).astype(np.uint64)
    n = int(size.sum()) + 2
    at >>= 5
    words = np.bincount(at, pair >> _WORD, n)
    words[1:] += np.bincount(at, pair & _LOW_WORD, n)[:-1]
    packed = words.astype(np.uint32).astype(">u4")
    return [packed[a : a + s].tobytes() for a, s in zip(first.tolist(), size.tolist())]


def decode_blocks(data: list[bytes], steps: int, n_ids: int) -> np.ndarray:
    """The ids of blocks of equal length; what is damaged gives wrong ids, which the checksum tells."""
    lanes = len(data)
    sizes = [max(0, min(int.from_bytes(d[:4], "little"), (len(d) - 4) // 4)) for d in data]
    room = max(sizes) + 4
    words = np.zeros((lanes, room), np.uint64)
    for row, d, size in zip(words, data, sizes):
        row[:size] = np.frombuffer(d[4 : 4 + 4 * size], "<u4")
    tails = [d[4 + 4 * size :] for d, size in zip(data, sizes)]
    most = max(map(len, tails)) // 4 + 2
    bits_of = np.frombuffer(b"".join(t[: len(t) & -4].ljust(4 * most, b"\0") for t in tails), ">u4").reshape(lanes, most).T.astype(np.uint64)
    windows = ((bits_of[:-1] << _WORD) | bits_of[1:]).ravel()  # 64 bits from each word on, of blocks side by side
    del bits_of
    code = (words[:, 0] << _WORD) | words[:, 1]
    words = words.ravel()
    lane = np.arange(lanes)
    at, bit, by_mix, by_look = lane * room + 2, np.zeros(lanes, np.int64), lane * _MIXES, lane << _CLASS_BITS
    width = np.full(lanes, (1 << 64) - 1, np.uint64)
    model, hashes, low = _Frequencies(lanes, steps, n_ids, decoding=True), _hashes(n_ids), _classes(n_ids)[1]
    # the tables of order 2, then of order 1, place by place with the blocks side by side, as these share their frequent ids
    followers = np.tile(np.repeat(np.array([n_ids << 4 | _UNSURE, n_ids << 4], np.int32), lanes), 1 << _TABLE)
    by_follower = np.arange(2 * lanes)
    mixes = np.tile(_MIX, lanes)
    places, before, last, new = by_follower, np.zeros(lanes, np.int32), np.empty((2, lanes), np.int32), np.empty(2 * lanes, np.int32)
    out = np.empty((steps, lanes), np.int32)
    for k in range(steps):
        if _renewed(k):
            model.renew(k)
        found = followers.take(places)
        found2, found1 = found[:lanes], found[lanes:]
        agree = (found2 ^ found1) < _MIXES
        at_mix = by_mix + ((found2 | found1) & 14)
        at_mix += agree
        mix = mixes.take(at_mix)
        share2, _, share0 = _shares(mix)
        part = width >> _TOTAL
        both = part * ((_ONE - share0) << _CLASS_BITS)
        few = (code < both).nonzero()[0]  # coded by a follower
        # all as order 0 codes it
        past, unit = code - both, part * share0
        kind = model.look.take(by_look + (past // unit).view(np.int64), mode="clip")
        table = model.table.take(model.at(kind))
        past -= unit * (table >> 16)
        unit *= table & 0xFFFF
        bits = model.class_bits.take(kind)
        own = (windows.take(model.at(bit >> 5), mode="clip") << (bit & 31).view(np.uint64)) >> (64 - bits).view(np.uint64)
        now = (low.take(kind) + own.view(np.int64)).astype(np.int32) << 4
        fall = ((mix - _FLOOR) >> _RATE) & _BOTH
        learnt = mix - fall
        # the few
        first, code = part.take(few) * (share2.take(few) << _CLASS_BITS), code.take(few)
        hit2 = code < first
        past[few] = code - first * ~hit2
        unit[few] = np.where(hit2, first, both.take(few) - first)
        bits[few], kind[few] = 0, _BY_FOLLOWER
        found2 = found2.take(few)
        own = np.where(hit2, found2, found1.take(few)) & -_MIXES
        now[few] = own
        learnt[few] = learnt.take(few) + np.where(hit2, (fall.take(few) & _LOW) + (_HIT << 16), _HIT)  # order 1 learns nothing where order 2 hits
        new[:lanes] = new[lanes:] = now
        new[few] = own + np.minimum((found2 & _UNSURE) + 4, 8) * hit2
        new[few + lanes] = own + ((agree.take(few) >= hit2).view(np.int8) << 1)
        code, width = past, unit
        bit += bits
        model.coded[k], out[k] = kind, now
        followers[places], mixes[at_mix] = new, learnt
        who = (width < _SHORT).nonzero()[0]
        if len(who):
            place = at.take(who)
            code[who] = (code.take(who) << _WORD) | words.take(place, mode="clip")
            width[who] = width.take(who) << _WORD
            at[who] = place + 1
        hashed = hashes.take(now >> 4, mode="clip")
        np.bitwise_and(hashed, 0xFFFF, out=last[1])
        np.bitwise_xor(last[1], before, out=last[0])
        places = by_follower + np.multiply(last, 2 * lanes, dtype=np.int64).ravel()
        before = hashed >> 16
    ids = np.empty((lanes, steps), np.int32)
    for at in range(0, lanes, _ROWS):
        part = slice(at, at + _ROWS)
        np.right_shift(out[:, part].T, 4, out=ids[part])
    return ids


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode_ids(ids: np.ndarray, n_ids: int) -> list[dict]:
    """Blocks with their numbers of ids and checksums. The last one is filled up with its last id, to be coded beside the others."""
    if not len(ids):
        return []
    steps = min(BLOCK_IDS, len(ids))
    sizes = [min(steps, len(ids) - at) for at in range(0, len(ids), steps)]
    if sizes[-1] < steps:
        ids = np.concatenate([ids, np.full(steps - sizes[-1], ids[-1], ids.dtype)])
    rows = ids.reshape(-1, steps)
    return [{"n": n, "crc": _checksum(row[:n]), "data": data} for n, row, data in zip(sizes, rows, encode_blocks(rows, n_ids))]


def decode_ids(blocks: list[dict], n_ids: int, name: str = "") -> np.ndarray:
    """The ids of consecutive blocks, checked."""
    if not blocks:
        return np.empty(0, np.int32)
    rows = decode_blocks([b["data"] for b in blocks], max(b["n"] for b in blocks), n_ids)
    out = [row[: b["n"]] for row, b in zip(rows, blocks)]
    for k, (row, b) in enumerate(zip(out, blocks)):
        if _checksum(row) != b["crc"]:
            raise ValueError(f"block {k} of record {name} is damaged")
    if all(len(row) == rows.shape[1] for row in out[:-1]):
        return rows.reshape(-1)[: sum(map(len, out))]
    return np.concatenate(out)


def load_tokenizer(path: str) -> str:
    """A tokenizer file's text, to be sent to the tasks; read on the driver only."""
    with open(path, encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=4)
def _tokenizer(content: str, plain: bool = True):
    """The tokenizer; ``plain`` takes control strings inside a text for ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content)
    tokenizer.encode_special_tokens = plain
    return tokenizer


class TextEncoder:
    """Ids of texts as the tokenizer gives them: word by word, but whole where a text holds one of its control strings."""

    def __init__(self, content: str):
        self.words, self.whole = WordIds(tokenizer_ids(content), KNOWN_WORDS, np.int32), _tokenizer(content, plain=False)
        self.control = [t["content"] for t in json.loads(content).get("added_tokens") or []]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the borders of the texts in them."""
        texts = texts.cast(pa.large_string()).fill_null("")
        apart = np.zeros(len(texts), bool)
        for control in self.control:
            apart |= pc.match_substring(texts, control).to_numpy(zero_copy_only=False)
        data, cuts, first = pre_tokens(pc.if_else(pa.array(apart), pa.scalar("", pa.large_string()), texts) if apart.any() else texts)
        ids, sizes = self.words.ids(self.words.numbers(byte_array(data, cuts)))
        borders = np.concatenate(([0], np.cumsum(sizes)))[first]
        if not apart.any():
            return ids, borders
        parts = [ids[a:b] for a, b in zip(borders[:-1], borders[1:])]
        for k in np.flatnonzero(apart).tolist():
            parts[k] = np.array(self.whole.encode(texts[k].as_py(), add_special_tokens=False).ids, np.int32)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


@lru_cache(maxsize=1)
def _text_encoder(content: str) -> TextEncoder:
    """The encoder of this Python worker: the tasks it runs one after another share what it remembers."""
    return TextEncoder(content)


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _word_model(content: str):
    """The tokenizer's own model, if all that the tokenizer does to a pre-token besides is to write its bytes as letters; else None."""
    parts = json.loads(content)
    split = parts.get("pre_tokenizer") or {}
    bare = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True) and parts["model"].get("type") == "BPE"
    bare = bare and not any(parts.get(k) for k in ("normalizer", "truncation", "padding")) and all(t.get("special") for t in parts.get("added_tokens") or [])
    return getattr(_tokenizer(content), "model", None) if bare else None


def tokenizer_encoder(content: str) -> Callable[[list[bytes]], list[list[int]]]:
    """Encodes pre-tokens of a byte-level tokenizer, which splits texts by the same pattern.

    The tokenizer's model takes a word's byte letters as they are, as the splitting is done. Words with characters whose classes may
    differ from one Unicode version to another are left to the whole tokenizer, many of them
    as the lines of one text: a line feed is a pre-token of its own before and after whatever doesn't end in white
    space, so its id parts their ids. White space, and lines that don't come out as many as they went in, are encoded one by one.
    """
    ids = tokenizer_ids(content)

    def encode(words: list[bytes]) -> list[list[int]]:
        flat, sizes = ids(words)
        return _cut(flat.tolist(), sizes.tolist())

    return encode


def _cut(flat: list[int], sizes: list[int]) -> list[list[int]]:
    ends = list(accumulate(sizes))
    return [flat[end - size : end] for end, size in zip(ends, sizes)]


def tokenizer_ids(content: str) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """Like ``tokenizer_encoder``, but the ids of all words one after another, and how many each has: no list per word."""
    model = _word_model(content)
    letters = np.zeros(256, "<u2")
    letters[list(byte_letters().values())] = [ord(c) for c in byte_letters()]

    def merged(words: list[bytes], data: np.ndarray) -> tuple[list[int], list[int]]:
        ends = np.fromiter(accumulate(map(len, words)), np.int64, len(words))
        text = np.insert(letters[data], ends[:-1], ord("\n"))  # no letter is a line feed
        found = list(map(model.tokenize, text.tobytes().decode("utf-16-le").split("\n")))
        return list(map(_ID, chain.from_iterable(found))), list(map(len, found))

    def one_by_one(words: list[str]) -> list[list[int]]:
        return [e.ids for e in _tokenizer(content).encode_batch_fast(words, add_special_tokens=False)]

    def lines(words: list[str]) -> list[list[int]]:
        texts = ["\n".join(words[at : at + LINES]) for at in range(0, len(words), LINES)]
        feed = one_by_one(["\n"])[0]
        out: list[list[int]] = []
        for at, ids in zip(range(0, len(words), LINES), one_by_one(texts)):
            own = words[at : at + LINES]
            ends = np.flatnonzero(np.array(ids) == feed[0]).tolist() if len(feed) == 1 else []
            if len(ends) == len(own) - 1:
                out += [ids[a:b] for a, b in zip([0, *(e + 1 for e in ends)], [*ends, len(ids)])]
            else:
                out += one_by_one(own)
        return out

    def whole(words: list[bytes]) -> list[list[int]]:
        part = [w.decode("utf-8") for w in words]
        white = [w[-1:].isspace() or not w for w in part]
        joined, alone = iter(lines([w for w, x in zip(part, white) if not x])), iter(one_by_one([w for w, x in zip(part, white) if x]))
        return [next(alone if x else joined) for x in white]

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), PART):
            part = words[at : at + PART]
            data = np.frombuffer(b"".join(part), np.uint8)
            if model and data.max(initial=0) < _SETTLED and not (data == ord("\n")).any():
                ids, n = merged(part, data)
            else:
                settled = [bool(model) and (w.isascii() or max(w) < _SETTLED) and (b"\n" not in w or w.isspace()) for w in part]
                some = [w for w, x in zip(part, settled) if x]
                bare, rest = iter(_cut(*merged(some, np.frombuffer(b"".join(some), np.uint8))) if some else []), iter(whole([w for w, x in zip(part, settled) if not x]))
                found = [next(bare if x else rest) for x in settled]
                ids, n = list(chain.from_iterable(found)), list(map(len, found))
            flat.append(np.array(ids, np.int32))
            sizes.append(np.array(n, np.int64))
        return np.concatenate(flat), np.concatenate(sizes)

    return encode


_BLOCKS = pa.list_(pa.struct([("n", pa.int32()), ("crc", pa.int64()), ("data", pa.binary())]))
_RECORD = "record bigint, version int, n_ids int, doc_ids array<bigint>, n_tokens array<bigint>, blocks array<struct<n: int, crc: bigint, data: binary>>"


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, record_bytes: int = RECORD_BYTES) -> None:
    """Write the records of all documents in ascending order of ids: file by file, and within each file.

    A record's ``record`` number ascends with the ids. Files are Parquet with the coded blocks as they are.
    """
    n_ids = 1 + max(_tokenizer(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _text_encoder(tokenizer)
        base, number, size = TaskContext.get().partitionId() << 32, 0, 0
        doc_ids: list[list] = []
        found: list = []

        def flush() -> pa.RecordBatch:
            n_tokens = np.concatenate([np.diff(borders) for _, borders in found]) + 1
            for k, (ids, borders) in enumerate(found):
                found[k] = np.insert(ids, borders[1:], end_id)
            ids = np.concatenate(found)
            found.clear()  # the coder needs the room
            return pa.RecordBatch.from_pydict(
                {
                    "record": pa.array([base | number], pa.int64()),
                    "version": pa.array([VERSION], pa.int32()),
                    "n_ids": pa.array([n_ids], pa.int32()),
                    "doc_ids": pa.array([[i for part in doc_ids for i in part]], pa.list_(pa.int64())),
                    "n_tokens": pa.array([n_tokens], pa.list_(pa.int64())),
                    "blocks": pa.array([encode_ids(ids, n_ids)], _BLOCKS),
                }
            )

        for part in slices(batches, limit=SLICE_BYTES):
            doc_ids.append(part.column("doc_id").to_pylist())
            found.append(encoder.encode(part.column("text")))
            size += part.nbytes
            if size >= record_bytes:
                yield flush()
                doc_ids, found, number, size = [], [], number + 1, 0
        if found:
            yield flush()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, _RECORD).write.option("compression", "uncompressed").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files alone."""
    records = spark.read.schema(_RECORD).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["version"] != VERSION:
                    raise ValueError(f"record {r['record']} has version {r['version']}")
                ids = decode_ids(r["blocks"], r["n_ids"], str(r["record"]))
                n_tokens = np.array(r["n_tokens"], np.int64)
                borders = np.concatenate(([0], np.cumsum(n_tokens)))
                view = memoryview(np.ascontiguousarray(ids.astype("<u4").view(np.uint8)))
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "record": pa.array([r["record"]] * len(sums), pa.int64()),
                        "doc_id": pa.array(r["doc_ids"], pa.int64()),
                        "inner": pa.array(borders[:-1]),
                        "n_tokens": pa.array(n_tokens),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    found = records.mapInArrow(run, "record bigint, doc_id bigint, inner bigint, n_tokens bigint, ids_crc32 bigint")
    starts = record_starts(records)
    return found.join(starts, "record").select("doc_id", (F.col("inner") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def record_starts(records: DataFrame) -> DataFrame:
    """``record, before``: ids of all records before each. The upper half of a record's number is its task, so sums are made in two steps."""
    sizes = records.select("record", F.shiftright("record", 32).alias("task"), F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    within = Window.partitionBy("task").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    tasks = sizes.groupBy("task").agg(F.sum("n").alias("n"))  # a row per task
    across = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("task", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    return sizes.join(bases, "task").select("record", (F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("before"))
