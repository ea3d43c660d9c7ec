"""Sinks for training rows and evaluation results."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.sources.storage import delete_tree, file_names, join_files
from gradeloom.sources.workdir import stored


def write_training_jsonl(rows: DataFrame, path: str, *, columns: Sequence[str] | None = None, mode: str = "errorifexists",
                         single_file: bool = False, order_by: Sequence[str] = ("sample_idx",)) -> None:
    """One JSON object per line, non-ASCII text unescaped: a folder of part files written in parallel.

    With ``single_file`` the rows are ordered by range and written in parallel beside ``path``, and the file system joins the
    parts into one file there; no task and no driver sees all rows. ``columns`` are those of the lines, all by default.
    """
    columns = list(columns or rows.columns)
    if not single_file:
        rows.select(*columns).write.mode(mode).option("ignoreNullFields", "false").json(path)
        return
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError("a single file can be written new or overwritten")
    spark, parts = rows.sparkSession, f"{path}.parts"
    ordered = stored(rows, "lines").repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    ordered.select(*columns).write.mode("overwrite").option("ignoreNullFields", "false").json(parts)
    if mode == "overwrite":
        delete_tree(spark, path)
    names = sorted(file_names(spark, parts), key=lambda name: int(name.split("-")[1]))
    join_files(spark, [f"{parts}/{name}" for name in names], path)
    delete_tree(spark, parts)


def run_name(model_path: str, prompt_format: str, started: datetime) -> str:
    """The run identifier: model name, prompt format and start time."""
    model = model_path.rstrip("/").rsplit("/", 1)[-1]
    return f"{model}_{prompt_format}_{started:%Y%m%d_%H%M%S}"


def write_eval_results(graded: DataFrame, metrics: DataFrame | Callable[[DataFrame], DataFrame], path: str, *, fmt: str = "parquet",
                       partition_by: Sequence[str] = ("run_id", "config"), mode: str = "errorifexists") -> None:
    """Detail rows partitioned by run and format, and one JSON row of metrics per run.

    Metrics given as a function get the written details, so that the rows are graded once.

    The rebalance hint brings rows of one output folder together and lets adaptive execution split a
    run that holds a large share, so neither many tiny files nor one huge task results.
    """
    details = graded.hint("rebalance", *[F.col(c) for c in partition_by])
    details.write.mode(mode).partitionBy(*partition_by).format(fmt).save(f"{path}/details")
    if callable(metrics):
        metrics = metrics(graded.sparkSession.read.schema(graded.schema).format(fmt).load(f"{path}/details"))
    metrics.write.mode(mode).option("ignoreNullFields", "false").json(f"{path}/metrics")


def metrics_record(summary: DataFrame, memory: DataFrame, config: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """One nested row per run: counts and times, ``memory_stats`` and ``config`` structs."""
    by = list(by)
    stats = memory.select(*by, F.struct("peak_allocated_gb", "peak_reserved_gb").alias("memory_stats"))
    settings = config.select(*by, F.struct(*[c for c in config.columns if c not in by]).alias("config"))
    return summary.join(stats, by, "left").join(settings, by, "left")
