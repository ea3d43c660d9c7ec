"""Group values beside each row, for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.operators.indexing import join_same
from gradeloom.sources.workdir import stored

HOT_ROWS = 1_000_000  # a group with more rows is not brought into one task
TRACKED = 10_000  # keys a sketch can tell apart; the hot groups are at most this many, so their broadcast has a fixed bound
PARTS = 64  # sketches are merged in so many tasks first


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, tracked: int = TRACKED) -> list[int]:
    """Hashes of the keys of at most ``tracked`` groups that seem to hold more than ``hot_rows`` rows, from one pass over the keys.

    A frequent-items sketch per task misses no group that holds more than about one in ``tracked`` of all rows; its counts are
    too high by no more than that. Other groups of the same hash are taken along, which does no harm.
    """
    sketches = (
        df.select(F.xxhash64(*keys).alias("key"), F.spark_partition_id().alias("part"))
        .groupBy("part").agg(F.expr(f"approx_top_k_accumulate(key, {tracked})").alias("sketch"))
        .groupBy((F.col("part") % PARTS).alias("part")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    )
    # Grouped by what is always 0: without rows there is no sketch to combine, and then no row either.
    top = sketches.groupBy((F.col("part") * 0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {tracked})").alias("top"))
    return [r["item"] for row in top.collect() for r in row["top"] if r["count"] > hot_rows]


def with_group_values(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column], *, hot_rows: int = HOT_ROWS,
                      keys_from: DataFrame | None = None) -> DataFrame:
    """Each row with aggregates of its group, NULL keys forming a group of their own.

    A sketch tells which groups are too large for one task. Without any, and that is the usual case, the values come from a
    window over the group, which reuses the exchange of a join or aggregate by the same keys below it. Rows of large groups get
    theirs from a map-side combined aggregate of those rows, broadcast to where they lie; the rows are then read three times
    and therefore stored first, so pass only the columns needed.

    ``keys_from`` names a cheaper table for the sketch, with the same keys about as often. Which groups are found large decides how a
    row gets its values, never which.
    """
    keys = list(keys)
    window = Window.partitionBy(*keys)
    over = {name: value.over(window) for name, value in values.items()}
    hot = hot_keys(keys_from if keys_from is not None else df, keys, hot_rows)
    if not hot:
        return df.withColumns(over)
    rows = stored(df, "rows")
    found = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hot], "_hot bigint"))
    is_hot = F.xxhash64(*keys) == F.col("_hot")
    large = rows.join(found, is_hot, "left_semi")
    totals = large.groupBy(*keys).agg(*[v.alias(name) for name, v in values.items()])
    beside = join_same(large, F.broadcast(totals), keys).select(*df.columns, *values)
    return rows.join(found, is_hot, "left_anti").withColumns(over).unionByName(beside)
