"""Global work on distinct pieces (words, pre-tokens) of all texts, with the pieces' positions kept beside it.

A row per piece and position would be many times the input. So the pieces of a block of texts are counted out before they are
shuffled: a block keeps, for every position, the number of the piece within the block (its slot), and hands out each of its
distinct pieces once, dealt into buckets by hash. All blocks' shares of a bucket meet in one task, so each distinct piece of the whole
table is handled once there; the answers go back to the blocks, and the slots put them into place.

A frequent piece is one entry per block, however often it stands there, so no piece makes a task large. Buckets follow
``spark.sql.shuffle.partitions``; the memory of a task is that of a block or a bucket. Blocks are stored in the shared folder, so
that their numbers hold whatever is computed again.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.textbatch import byte_array, slices
from gradeloom.sources.storage import delete_tree
from gradeloom.sources.workdir import new_path

BLOCK_BYTES = 16 << 20
BUCKETS_PER_PARTITION = 1
LEVEL = 6  # of compression; 9 takes eight times as long for a hundredth less
FAST = 1  # the level of Zstandard, which takes a tenth of the time for a few hundredths more; levels above are Deflate's
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Splits a column of texts: bytes of all pieces, borders of pieces in them, and first piece of each text (one more than texts).
Splitter = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]

_SCHEMA = "block bigint, bucket int, doc_ids array<bigint>, n_pieces array<bigint>, slots binary, buckets binary, words binary, lengths binary, counts binary"


def squeeze(data: bytes, level: int = LEVEL) -> bytes:
    """Compressed bytes. Zstandard's start with a ``Z`` and their size before; Deflate's start with an ``x``."""
    if level > FAST:
        return zlib.compress(data, level)
    return b"Z" + len(data).to_bytes(8, "little") + pa.Codec("zstd", FAST).compress(data, asbytes=True)


def expand(data: bytes) -> bytes:
    if data[:1] == b"Z":
        return pa.Codec("zstd").decompress(memoryview(data)[9:], int.from_bytes(data[1:9], "little"), asbytes=True)
    return zlib.decompress(data)


def pack(values: np.ndarray, width: int = 4, level: int = LEVEL) -> bytes:
    """Integers of ``width`` bytes without sign, by planes of bytes and compressed."""
    return squeeze(np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes(), level)


def unpack(data: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(expand(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.int64)


def pack_slots(slots: np.ndarray, level: int = LEVEL) -> bytes:
    """Slots of which small ones are frequent: one byte each, and the rest of the large ones apart."""
    head = squeeze(np.minimum(slots, 255).astype(np.uint8).tobytes(), level)
    return len(head).to_bytes(8, "little") + head + pack(slots[slots >= 255] - 255, level=level)


def unpack_slots(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    slots = np.frombuffer(expand(data[8 : 8 + size]), np.uint8).astype(np.int64)
    slots[slots == 255] += unpack(data[8 + size :])
    return slots


def stored_packed(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, with the denser codec, and the shuffle files of the work for it deleted when it is done."""
    path, conf = new_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read any more."""
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        delete_tree(df.sparkSession, folder)


def bucket_count(docs: DataFrame) -> int:
    return BUCKETS_PER_PARTITION * max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def blocks(docs: DataFrame, split: Splitter, counted: Callable[[list], np.ndarray] | None = None, block_bytes: int = BLOCK_BYTES, level: int = LEVEL) -> DataFrame:
    """Blocks of ``docs(doc_id, text)`` and their shares of the buckets, stored.

    ``counted`` says from the ids which texts count; the share then holds how often each piece stands in those.
    """
    n_buckets = bucket_count(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        pending: list[tuple] = []
        number = size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids = [i for part in pending for i in part[0]]
            n_pieces = np.concatenate([p[3] for p in pending])
            data = np.concatenate([p[1] for p in pending])
            shift = np.concatenate(([0], np.cumsum([len(p[1]) for p in pending])[:-1]))
            borders = np.concatenate([p[2][:-1] + s for p, s in zip(pending, shift)] + [[len(data)]])
            encoded = byte_array(data, borders).dictionary_encode()
            words, raw = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)
            often = np.bincount(raw, minlength=len(words))
            by_count = np.argsort(-often, kind="stable")
            slot_of = np.empty(len(words), np.int64)
            slot_of[by_count] = np.arange(len(words))
            words, slots = words.take(pa.array(by_count)), slot_of[raw]
            bucket = np.fromiter(map(zlib.crc32, words.to_numpy(zero_copy_only=False)), np.int64, len(words)) % n_buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            count = None
            if counted is not None:
                use = np.repeat(counted(ids), n_pieces)
                count = np.bincount(slots[use], minlength=len(words))
            block = base | number
            yield _row(block, -1, doc_ids=ids, n_pieces=n_pieces.tolist(), slots=pack_slots(slots, level), buckets=pack(bucket, level=level))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                mine = order[cuts[b] : cuts[b + 1]]
                share = words.take(pa.array(mine))
                at = np.frombuffer(share.buffers()[1], np.int64)[: len(share) + 1]
                yield _row(block, b, words=squeeze(share.buffers()[2].to_pybytes()[at[0] : at[-1]], level), lengths=pack(np.diff(at), level=level), counts=None if count is None else pack(count[mine], level=level))

        for part in slices(batches):
            data, borders, first = split(part.column("text"))
            pending.append((part.column("doc_id").to_pylist(), data, borders, np.diff(first)))
            size += len(data)
            if size >= block_bytes:
                yield from flush()
                pending, number, size = [], number + 1, 0
        if pending:
            yield from flush()

    return stored_packed(docs.select("doc_id", "text").mapInArrow(run, _SCHEMA), "blocks")


_ARROW = pa.schema(
    [("block", pa.int64()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_pieces", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("slots", "buckets", "words", "lengths", "counts")]
)


def _row(block: int, bucket: int, **values) -> pa.RecordBatch:
    full = {"block": block, "bucket": bucket} | values
    return pa.RecordBatch.from_pydict({f.name: pa.array([full.get(f.name)], f.type) for f in _ARROW}, _ARROW)


@dataclass
class Bucket:
    """All blocks' shares of one bucket: ``codes`` numbers the distinct ``words`` for every entry of every share."""

    number: int
    words: list[bytes]
    codes: np.ndarray
    counts: np.ndarray | None


def answer_buckets(shares: DataFrame, names: list[str], answer: Callable[[Bucket], dict[str, Callable[[np.ndarray], bytes]]]) -> DataFrame:
    """``block, bucket`` and binary columns that ``answer`` makes from a bucket's words.

    ``answer`` gives, per column, a function from the codes of a share to bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            lengths = [unpack(r["lengths"]) for r in held]
            data = np.frombuffer(b"".join(expand(r["words"]) for r in held), np.uint8)
            encoded = byte_array(data, np.concatenate(([0], np.cumsum(np.concatenate(lengths))))).dictionary_encode()
            codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.concatenate([unpack(r["counts"]) for r in held]) if held[0]["counts"] is not None else None
            makers = answer(Bucket(key, encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), codes, counts))
            at = 0
            for r, own in zip(held, lengths):
                mine = codes[at : at + len(own)]
                at += len(own)
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([r["block"]], pa.int64()), "bucket": pa.array([r["bucket"]], pa.int32())} | {c: pa.array([makers[c](mine)], pa.binary()) for c in names}
                )

        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] != key:
                    yield from flush()
                    key, held = r["bucket"], []
                held.append(r)
        yield from flush()

    dealt = shares.where("bucket >= 0").select("block", "bucket", "words", "lengths", "counts")
    together = dealt.repartition("bucket").sortWithinPartitions("bucket", "block")
    return together.mapInArrow(run, "block bigint, bucket int" + "".join(f", {c} binary" for c in names))


@dataclass
class Block:
    """A block with its answers: ``slots`` of all positions, ``shares`` of the answers, ``place`` of each slot in them."""

    number: int
    doc_ids: list
    n_pieces: np.ndarray
    slots: np.ndarray
    order: np.ndarray
    answers: dict[str, list[bytes]]

    def by_slot(self, values: np.ndarray) -> np.ndarray:
        """Values that are laid out bucket by bucket, put into the order of slots."""
        out = np.empty_like(values)
        out[self.order] = values
        return out


def put_back(shares: DataFrame, answers: DataFrame, schema: str, finish: Callable[[Block], Iterable[pa.RecordBatch]]) -> DataFrame:
    """Rows that ``finish`` makes from each block and its answers, in as many batches as it likes."""
    columns = [c for c in answers.columns if c not in ("block", "bucket")]
    own = shares.where("bucket = -1").select("block", "bucket", "doc_ids", "n_pieces", "slots", "buckets", *[F.lit(None).cast("binary").alias(c) for c in columns])
    nothing = {"doc_ids": "array<bigint>", "n_pieces": "array<bigint>", "slots": "binary", "buckets": "binary"}
    others = answers.select("block", "bucket", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, {c: [] for c in columns}

        def flush() -> Iterator[pa.RecordBatch]:
            if head is not None:
                order = np.argsort(unpack(head["buckets"]), kind="stable")
                yield from finish(Block(head["block"], head["doc_ids"], np.array(head["n_pieces"], np.int64), unpack_slots(head["slots"]), order, held))

        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if r["bucket"] == -1:
                    yield from flush()
                    head, held = r, {c: [] for c in columns}
                else:
                    for c in columns:
                        held[c].append(r[c])
        yield from flush()

    together = own.unionByName(others).repartition("block").sortWithinPartitions("block", "bucket")
    return together.mapInArrow(run, schema)
