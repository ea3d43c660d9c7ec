"""Resource sweep reports over memory samples and run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Megabytes per gigabyte, rows of the full training set, start-up check in seconds.
MB_PER_GB = 1024
FULL_TRAIN_ROWS = 8700
STARTUP_SECONDS = 3


def sweep_numbers(runs: DataFrame, name: str = "config") -> DataFrame:
    """Group size and batch size of runs named ``G<gen>_B<batch>``, NULL for other names."""
    pattern = r"^G(\d+)_B(\d+)$"
    return runs.withColumns(
        {
            "num_generations": F.regexp_extract(name, pattern, 1).try_cast("int"),
            "batch_size": F.regexp_extract(name, pattern, 2).try_cast("int"),
        }
    )


def sweep_filter(runs: DataFrame, name: str = "config") -> DataFrame:
    """Runs named ``G<gen>_B<batch>`` whose batch size is a multiple of the group size, with both numbers."""
    return sweep_numbers(runs, name).where(F.try_mod(F.col("batch_size"), F.col("num_generations")) == 0)


def resource_summary(samples: DataFrame, by: Sequence[str] = ("config",)) -> DataFrame:
    """Maximum and mean memory in GB, number of samples and seconds covered, per configuration."""
    gb = F.col("used_mb") / MB_PER_GB
    seconds = F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))
    return samples.groupBy(*by).agg(
        F.max(gb).alias("max_gb"),
        F.avg(gb).alias("avg_gb"),
        F.count(F.lit(1)).alias("n_samples"),
        (seconds / F.lit(1e6)).alias("duration_s"),
    )


def estimate_full_time(duration_s: Column, num_generations: Column, batch_size: Column, steps: Column,
                       total_rows: int = FULL_TRAIN_ROWS) -> Column:
    """Minutes a full pass is expected to take, from a short run; NULL when the run did no work."""
    done = num_generations.cast("double") * batch_size * steps
    return F.try_divide(duration_s * F.lit(float(total_rows)), done) / F.lit(60.0)


def run_status(n_samples: Column, elapsed_s: Column, exit_code: Column) -> Column:
    """``failed_to_start``, ``abnormal_exit``, ``unfinished`` (no exit code was reported) or ``ok``."""
    return (
        F.when((n_samples == 0) & (elapsed_s <= STARTUP_SECONDS), F.lit("failed_to_start"))
        .when(exit_code != 0, F.lit("abnormal_exit"))
        .when(exit_code.isNull(), F.lit("unfinished"))
        .otherwise(F.lit("ok"))
    )
