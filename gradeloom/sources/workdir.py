"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode only, a temporary one when it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="gradeloom-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/gradeloom/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a Parquet table in the shared folder and read from there.

    For input that several passes need: it is computed once, and a lost executor costs a re-read.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
