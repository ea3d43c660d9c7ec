"""Live accuracy, memory windows and memory peaks over unbounded input.

Each function takes a streaming DataFrame and returns one; sink, output mode and trigger are the
caller's. On a bounded DataFrame they give the batch result of the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_running_accuracy(graded: DataFrame, by: Sequence[str] = ("run_id",),
                            key: Sequence[str] = ("run_id", "config", "gen", "sample_idx"), *, delay: str,
                            ts: str = "ts", salts: int = 16) -> DataFrame:
    """Accuracy so far per run; results delivered twice within the watermark count once. Update or complete mode.

    ``key`` names one result and includes ``by``. Results later than ``delay`` are dropped by the watermark, so it is the
    caller's choice; query progress counts them. On a bounded table the earliest copy counts.

    Copies are dropped in two steps: first among those read by the same of ``salts`` groups of input
    tasks, then among the at most ``salts`` left. One state partition thus never receives all copies of
    a result delivered very often.
    """
    if graded.isStreaming:
        salted = graded.withWatermark(ts, delay).withColumn("_salt", F.spark_partition_id() % salts)
        few = salted.dropDuplicatesWithinWatermark([*key, "_salt"])
        once = few.dropDuplicatesWithinWatermark(list(key))
    else:
        once = graded.groupBy(*key).agg(F.min_by("correct", F.struct(ts, "correct")).alias("correct"))
    counts = once.groupBy(*by).agg(
        F.count(F.lit(1)).alias("seen"), F.sum(F.col("correct").cast("long")).alias("correct_so_far")
    )
    return counts.withColumn("accuracy", F.col("correct_so_far") * F.lit(100.0) / F.col("seen"))


def stream_resource_windows(samples: DataFrame, width: str = "5 seconds", by: Sequence[str] = ("config",), *,
                            delay: str = "1 minute") -> DataFrame:
    """Maximum and mean memory in GB per tumbling window. Update mode, or append for file sinks."""
    gb = F.col("used_mb") / 1024
    return (
        samples.withWatermark("ts", delay)
        .groupBy(F.window("ts", width), *by)
        .agg(F.max(gb).alias("max_gb"), F.avg(gb).alias("avg_gb"), F.count(F.lit(1)).alias("n_samples"))
        .select(F.col("window.start").alias("window_start"), *by, "max_gb", "avg_gb", "n_samples")
    )


def stream_peak_memory(readings: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Running peak of allocated and reserved memory per run. Update or complete mode."""
    return readings.groupBy(*by).agg(
        F.max("allocated_gb").alias("peak_allocated_gb"), F.max("reserved_gb").alias("peak_reserved_gb")
    )
