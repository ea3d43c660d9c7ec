"""Group-relative values: several generations of one sample compared with each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.operators.skew import HOT_ROWS, with_group_values


def group_advantage(df: DataFrame, by: Sequence[str] = ("sample_idx",), reward: str = "reward", *,
                    normalize: bool = False, hot_rows: int = HOT_ROWS, keys_from: DataFrame | None = None) -> DataFrame:
    """Each generation's reward minus the mean reward of its group, with ``normalize`` in standard deviations.

    A group without spread has advantages of zero either way. ``keys_from`` as in ``with_group_values``.
    """
    values = {"group_mean": F.avg(reward)} | ({"group_std": F.stddev_pop(reward)} if normalize else {})
    means = with_group_values(df, by, values, hot_rows=hot_rows, keys_from=keys_from)
    advantage = F.col(reward) - F.col("group_mean")
    if normalize:
        advantage = F.when(F.col("group_std") > 0, advantage / F.col("group_std")).otherwise(F.lit(0.0))
    return means.withColumn("advantage", advantage)


def group_stats(df: DataFrame, by: Sequence[str] = ("sample_idx",), reward: str = "reward") -> DataFrame:
    """Group size, mean, best and worst reward, whether any is right, and whether all are the same (nothing to learn)."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("group_size"),
        F.avg(reward).alias("mean_reward"),
        F.max(reward).alias("best_reward"),
        F.min(reward).alias("worst_reward"),
        (F.max(reward) > 0).alias("any_correct"),
        (F.max(reward) == F.min(reward)).alias("zero_spread"),
    )


def best_worst(df: DataFrame, payload: Sequence[str] = ("response",), by: Sequence[str] = ("sample_idx",),
               reward: str = "reward", gen: str = "gen") -> DataFrame:
    """First and last generation of each group, ordered by reward descending, then ``gen`` ascending.

    Two combinable aggregates instead of a ranking window: a map task sends on two rows per group.
    """
    row = F.struct(gen, reward, *payload)
    rank = F.struct(F.col(reward), -F.col(gen))
    ends = df.groupBy(*by).agg(
        F.max_by(row, rank).alias("best"), F.min_by(row, rank).alias("worst"), F.count(F.lit(1)).alias("group_size")
    )
    columns = [gen, reward, *payload]
    return ends.select(
        *by,
        "group_size",
        *[F.col(f"best.{c}").alias(f"best_{c}") for c in columns],
        *[F.col(f"worst.{c}").alias(f"worst_{c}") for c in columns],
    )
