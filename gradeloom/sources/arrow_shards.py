"""A data source for QA datasets stored as Arrow stream shards, one folder per split."""

from __future__ import annotations

import glob
import io
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema
from pyspark.sql.types import LongType, NullType, StringType, StructType

SHARD_PATTERN = "data-*.arrow"  # fixed value: shard file names inside a split folder
SPLIT_BYTES = 128 * 1024 * 1024  # bytes per task
INDEX_THREADS = 16  # shards indexed at a time


class ShardSlice(InputPartition):
    """Consecutive record batches of one shard: the byte ranges that make a stream of them, and the number of their first row.

    The ranges are the schema, the dictionaries ahead of the batches, and the batches.
    """

    def __init__(self, path: str, ranges: list[tuple[int, int]], row: int):
        self.path, self.ranges, self.row = path, ranges, row


def next_message(source):
    """The next message of a stream, or None at its end. The file is memory-mapped, so a body that isn't used costs nothing."""
    import pyarrow as pa

    try:
        return pa.ipc.read_message(source)
    except EOFError:
        return None


def shard_slices(path: str, split_bytes: int) -> list[ShardSlice]:
    """The shard in slices of about ``split_bytes``; a small shard is one and is not looked into.

    A larger shard is walked once, from message header to message header, and each slice then starts where its batches lie.
    """
    import pyarrow as pa

    size = os.path.getsize(path)
    if size <= split_bytes:
        return [ShardSlice(path, [(0, size)], 0)]
    slices: list[ShardSlice] = []
    with pa.memory_map(path) as source:
        message = next_message(source)
        schema = pa.ipc.read_schema(message)
        # Batches hold the codes of dictionary columns; read as such they tell their length without the dictionaries.
        plain = pa.schema([f.with_type(f.type.index_type) if pa.types.is_dictionary(f.type) else f for f in schema])
        ahead, batches, row, next_row = [(0, source.tell())], (source.tell(), source.tell()), 0, 0

        def close() -> None:
            if batches[1] > batches[0]:
                slices.append(ShardSlice(path, [*ahead, batches], row))

        at = source.tell()
        while (message := next_message(source)) is not None:
            if message.type == "dictionary" or batches[1] - batches[0] >= split_bytes:
                close()
                batches, row = (at, at), next_row
            if message.type == "dictionary":
                ahead, batches = [*ahead, (at, source.tell())], (source.tell(), source.tell())
            else:
                next_row += pa.ipc.read_record_batch(message, plain).num_rows
                batches = batches[0], source.tell()
            at = source.tell()
        close()
    return slices


class _Ranges(io.RawIOBase):
    """Byte ranges of a memory-mapped file as one stream."""

    def __init__(self, source, ranges):
        self.source, self.left = source, list(ranges)

    def readable(self):
        return True

    def read(self, n=-1):
        if not self.left:
            return b""
        start, end = self.left[0]
        stop = end if n < 0 else min(end, start + n)
        self.left[:1] = [(stop, end)] if stop < end else []
        self.source.seek(start)
        data = self.source.read_buffer(stop - start)
        if n < 0 or len(data) == n or not self.left:
            return data
        return b"".join([data, self.read(n - len(data))])


class ArrowShardReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema = schema
        self.columns = [f.name for f in schema.fields if f.name not in ("shard", "shard_row")]
        self.path = options["path"]
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self):
        with ThreadPoolExecutor(INDEX_THREADS) as pool:
            found = pool.map(lambda path: shard_slices(path, self.split_bytes), shard_paths(self.path))
            return [piece for slices in found for piece in slices]

    def read(self, partition):
        """Yield the slice's batches with shard name and row number; nothing else of the shard is read."""
        import os

        import numpy as np
        import pyarrow as pa

        wanted = to_arrow_schema(self.schema)
        row = partition.row
        with pa.memory_map(partition.path) as source, pa.ipc.open_stream(pa.PythonFile(_Ranges(source, partition.ranges), "r")) as stream:
            for batch in stream:
                n = batch.num_rows
                arrays = [batch.column(batch.schema.get_field_index(c)).cast(wanted.field(c).type) for c in self.columns]
                shard = pa.array([os.path.basename(partition.path)] * n, pa.string())
                yield pa.RecordBatch.from_arrays([*arrays, shard, pa.array(np.arange(row, row + n))], schema=wanted)
                row += n


class ArrowShards(DataSource):
    """``spark.read.format("arrow_shards").load(split_folder)``: columns of the first shard, shard name, row in shard.

    Columns keep their types; option ``columns``, names joined by commas, reads only those. A column without a type is text. Option
    ``splitBytes`` sets the size of a task.
    """

    @classmethod
    def name(cls):
        return "arrow_shards"

    def schema(self):
        import pyarrow as pa

        with pa.memory_map(shard_paths(self.options["path"])[0]) as source, pa.ipc.open_stream(source) as stream:
            named = [c for c in self.options.get("columns", "").split(",") if c] or stream.schema.names
            out = StructType()
            for name in named:
                found = stream.schema.field(name).type
                kind = from_arrow_type(found.value_type if pa.types.is_dictionary(found) else found)
                out = out.add(name, StringType() if isinstance(kind, NullType) else kind)
        return out.add("shard", StringType()).add("shard_row", LongType())

    def reader(self, schema):
        return ArrowShardReader(schema, self.options)


def shard_paths(folder: str) -> list[str]:
    paths = sorted(glob.glob(os.path.join(folder, SHARD_PATTERN)))
    if not paths:
        raise FileNotFoundError(f"no {SHARD_PATTERN} in {folder}")
    return paths
