"""QA datasets: one folder per split in Parquet, JSON lines or Arrow stream shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.operators.indexing import index_by_storage
from gradeloom.operators.samples import resolve_qa_columns
from gradeloom.sources import arrow_shards

FORMATS = ("parquet", "json", "arrow")


def available_splits(spark: SparkSession, path: str) -> list[str]:
    """Names of the split folders of a dataset; lists files, reads none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    folder = F.regexp_extract("path", r"/(?:split=)?([^/]+)/[^/]+$", 1)
    return sorted(row["split"] for row in files.select(folder.alias("split")).distinct().collect())


def read_qa(spark: SparkSession, path: str, split: str | None = "test", fmt: str = "parquet", *,
            with_index: bool = False, columns: Sequence[str] = ()) -> DataFrame:
    """One split with canonical ``question`` and ``answer`` columns.

    A folder is named ``<split>`` or ``split=<split>``; ``None`` reads a dataset without splits. An unknown split is an error that names the
    ones there are; nothing is substituted for data that cannot be loaded. ``with_index`` adds a dense
    ``sample_idx`` in storage order (Parquet and Arrow). For JSON and Arrow, ``columns`` names the columns to
    read; without it JSON is read once more to infer them.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
    if with_index and fmt == "json":
        raise ValueError("JSON rows carry no position; use index_by_order on a key, or store the data as Parquet")
    root = path.rstrip("/")
    for folder in [root] if split is None else [f"{root}/{split}", f"{root}/split={split}"]:
        try:
            df = _load(spark, folder, fmt, with_index, columns)
            break
        except (AnalysisException, FileNotFoundError) as error:
            if isinstance(error, AnalysisException) and error.getCondition() != "PATH_NOT_FOUND":
                raise
    else:
        raise ValueError(f"no split {split!r} in {path}; available: {', '.join(available_splits(spark, path))}")
    qa = resolve_qa_columns(df)
    return index_by_storage(qa, "_unit", "_row") if with_index else qa


def _load(spark: SparkSession, folder: str, fmt: str, with_index: bool, columns: Sequence[str]) -> DataFrame:
    if fmt == "arrow":
        arrow_shards.shard_paths(folder)
        # The reader travels to the workers by value: they need no installed copy of the package.
        cloudpickle.register_pickle_by_value(arrow_shards)
        spark.dataSource.register(arrow_shards.ArrowShards)
        df = spark.read.format("arrow_shards").option("columns", ",".join(columns)).load(folder)
        if with_index:
            return df.withColumnsRenamed({"shard": "_unit", "shard_row": "_row"})
        return df.drop("shard", "shard_row")
    reader = spark.read.format(fmt)
    if fmt == "json" and columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    df = reader.load(folder)
    if not with_index:
        return df
    return df.select("*", F.col("_metadata.file_path").alias("_unit"), F.col("_metadata.row_index").alias("_row"))
