"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are split into pre-tokens by the pattern of the rank files; ``dictionary`` deals the distinct ones out, each is encoded once by
its merges, its ids are joined back, and positions put them together. Decoding joins ids with the table of token bytes, which is
as small as the vocabulary.

Rows: one row out per row in. A null text is empty and has no ids. Texts are processed whole and need not fit anything but
memory; repeated rows are encoded alike; an empty table gives an empty table. Control strings of a vocabulary inside a text are
ordinary text. Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.dictionary import LEVEL, Block, Bucket, answer_buckets, blocks, pack, put_back, unpack
from gradeloom.llm.textbatch import text_bytes

RUN_PIECES = 1 << 18  # pre-tokens of a block that are put together at once
_RUN = 1 << 16  # runs whose places are made at once

_OTHER, _LETTER, _NUMBER, _WHITE, _SPACE = range(5)
#: White space of the pattern: the White_Space property.
_WHITE_RANGES = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    first = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000))
    kinds = np.frombuffer(first.encode(), np.uint8)
    out = np.full(0x110000, _OTHER, np.uint8)
    out[kinds == ord("L")] = _LETTER
    out[kinds == ord("N")] = _NUMBER
    for low, high in _WHITE_RANGES:
        out[low : high + 1] = _WHITE
    out[0x20] = _SPACE
    return out


def pre_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces that the pattern of the rank files finds: bytes, borders, first piece per text. They cover each text without gaps."""
    data, offsets = text_bytes(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    at = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(points)
    if not n:
        return data, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    head = np.zeros(n + 1, dtype=bool)  # a text begins here (or all ends)
    head[np.searchsorted(at, offsets)] = True
    kind = _classes()[points]
    white = kind >= _WHITE
    before = np.concatenate(([_OTHER], kind[:-1]))
    last = np.concatenate((head[1:n], [True]))  # the last of its text
    next_white = np.concatenate((white[1:], [True]))
    start = np.where(
        white,
        ~(before >= _WHITE) | (~next_white & ~last),  # a run begins, or its last one before something else
        np.where(before == _SPACE, False, kind != before),
    )
    start |= head[:n]
    # 's 't 'm 'd 're 've 'll
    for i in np.flatnonzero(start & (points == 0x27)).tolist():
        if last[i]:
            continue
        length = 0
        if points[i + 1] in (0x73, 0x74, 0x6D, 0x64):
            length = 2
        elif not last[i + 1] and (int(points[i + 1]), int(points[i + 2])) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)):
            length = 3
        if length:
            start[i + 1 : i + length] = False
            if i + length < n:
                start[i + length] = True
    begin = at[np.flatnonzero(start)]
    return data, np.append(begin, len(data)), np.searchsorted(begin, offsets)


def load_ranks(path: str) -> bytes:
    """The bytes of a rank file, to be sent to the tasks; read on the driver only."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


@lru_cache(maxsize=2)
def token_table(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens by id, and their borders."""
    by_id = sorted((rank, token) for token, rank in _ranks(content).items())
    lengths = np.zeros(by_id[-1][0] + 1, np.int64)
    for rank, token in by_id:
        lengths[rank] = len(token)
    return np.frombuffer(b"".join(token for _, token in by_id), np.uint8), np.concatenate(([0], np.cumsum(lengths)))


@lru_cache(maxsize=2)
def _encoder(content: bytes):
    """Encodes a whole piece by its merges; the pieces are split before, so its own pattern takes all."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=_ranks(content), special_tokens={})


def rank_encoder(content: bytes) -> Callable[[list[bytes]], list[list[int]]]:
    def encode(words: list[bytes]) -> list[list[int]]:
        one = _encoder(content).encode_ordinary
        return [one(w.decode("utf-8")) for w in words]

    return encode


def decode(ids: np.ndarray, content: bytes) -> np.ndarray:
    """The bytes of a run of ids."""
    table, borders = token_table(content)
    return ragged(table, borders[ids], borders[ids + 1] - borders[ids])


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]``, one after another."""
    out = np.empty(int(lengths.sum()), values.dtype)
    done = 0
    for at in range(0, len(starts), _RUN):
        own = lengths[at : at + _RUN]
        ends = np.cumsum(own)
        places = np.repeat(starts[at : at + _RUN] - ends + own, own)
        places += np.arange(len(places))
        out[done : done + len(places)] = values[places]
        done += len(places)
    return out


def _share(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, level: int):
    return {"sizes": lambda codes: pack(lengths[codes], level=level), "ids": lambda codes: pack(ragged(flat, starts[codes], lengths[codes]), level=level)}


def encode_words(encode: Callable[[list[bytes]], list[list[int]]], level: int = LEVEL):
    def answer(bucket: Bucket):
        found = encode(bucket.words)
        lengths = np.array([len(x) for x in found], np.int64)
        flat = np.array([i for x in found for i in x], np.int64)
        return _share(flat, np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths, lengths, level)

    return answer


def block_ids(block: Block) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """The block's texts in order, some at a time: their ids, all their token ids and the borders of the texts in them."""
    empty = np.empty(0, np.int32)
    sizes = np.concatenate([empty, *(unpack(part).astype(np.int32) for part in block.answers["sizes"])])
    flat = np.concatenate([empty, *(unpack(part).astype(np.int32) for part in block.answers["ids"])])
    starts = block.by_slot(np.cumsum(sizes, dtype=np.int64) - sizes)
    sizes = block.by_slot(sizes)
    first = np.concatenate(([0], np.cumsum(block.n_pieces)))
    at, n = 0, len(block.doc_ids)
    while at < n:
        end = min(n, max(at + 1, int(np.searchsorted(first, first[at] + RUN_PIECES, side="right")) - 1))
        slots = block.slots[first[at] : first[end]]
        per_piece = sizes[slots]
        total = np.concatenate(([0], np.cumsum(per_piece, dtype=np.int64)))
        yield block.doc_ids[at:end], ragged(flat, starts[slots], per_piece), total[first[at : end + 1] - first[at]]
        at = end


def encoded_blocks(docs: DataFrame, encode: Callable[[list[bytes]], list[list[int]]], schema: str, finish: Callable[[list, np.ndarray, np.ndarray], pa.RecordBatch], level: int = LEVEL) -> DataFrame:
    """What ``finish`` makes from texts' ids, their token ids and the borders of the texts in them, for some texts of a block at a time.

    Rows keep the order they have in their partitions.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shares = blocks(narrow, pre_tokens, level=level)
    answers = answer_buckets(shares, ["sizes", "ids"], encode_words(encode, level))
    return put_back(shares, answers, schema, lambda block: (finish(*part) for part in block_ids(block)))


def little_endian(ids: np.ndarray) -> np.ndarray:
    return ids.astype("<u4").view(np.uint8)


def _digests(values: np.ndarray, borders: np.ndarray) -> list[str]:
    view = memoryview(np.ascontiguousarray(values))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]


def encode_and_decode(docs: DataFrame, ranks: bytes, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``): what is encoded is decoded again from its ids alone."""

    def finish(doc_ids: list, ids: np.ndarray, borders: np.ndarray) -> pa.RecordBatch:
        decoded = decode(ids, ranks)
        byte_borders = np.concatenate(([0], np.cumsum(np.diff(token_table(ranks)[1])[ids])))[borders]
        out = {
            "doc_id": pa.array(doc_ids, pa.int64()),
            "n_tokens": pa.array(np.diff(borders)),
            "ids_sha256": pa.array(_digests(little_endian(ids), 4 * borders)),
            "decoded_sha256": pa.array(_digests(decoded, byte_borders)),
        }
        if keep_ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_pydict(out)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return encoded_blocks(docs, rank_encoder(ranks), schema, finish, level=9)  # disk and network are scarcer here than processor time


def decode_documents(ids: DataFrame, ranks: bytes) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``: each row's ids are joined with the token table where they lie.

    Null ids give a null text; bytes that are no UTF-8 are replaced.
    """

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            texts = [None if x is None else decode(np.array(x, np.int64), ranks).tobytes().decode("utf-8", "replace") for x in rows]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
