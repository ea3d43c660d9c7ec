"""Dense sample indexes for sources that carry none."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.sources.workdir import stored

RANGE_ROWS = 1 << 20  # rows of a sorted range, about


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which NULL is a value like any other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def index_by_storage(df: DataFrame, unit: str, row: str, index: str = "sample_idx") -> DataFrame:
    """A dense index in storage order, from a storage unit column and the row number inside the unit.

    Parquet files give both (file path and row index), Arrow shards too. Rows are never sorted or
    moved to one place: only the row counts per unit are ordered, one row per file of the table. The
    join back is a plain equi-join on the unit, which adaptive execution broadcasts when the counts are
    small and splits when one file dominates.
    """
    counts = df.groupBy(unit).agg((F.max(row) + 1).alias("_rows"))
    before = Window.orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(unit), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    indexed = df.join(offsets, unit).withColumn(index, (F.col("_offset") + F.col(row)).cast("long"))
    return indexed.drop("_offset", unit, row)


def ranked(df: DataFrame, order_by: Sequence[str], index: str = "_rank", range_rows: int = RANGE_ROWS) -> DataFrame:
    """All rows with their dense rank, stored; pass only the columns needed.

    The rows are stored as they come, which fixes what the sampled range bounds are taken from and tells how many
    ranges their number needs. They are then sorted by range and written with the number of their range and their place
    in it, so the rank is exact however uneven the sample made the ranges. Ties are broken by the other columns, and a
    key shared by many rows spreads over several ranges.
    """
    rows = stored(df, "rows")
    ties = [c for c, kind in df.dtypes if c not in order_by and not kind.startswith("map")]
    n = rows.count()
    ranges = max(1, math.ceil(n / range_rows), min(rows.sparkSession.sparkContext.defaultParallelism, n >> 14))
    ordered = rows.repartitionByRange(ranges, *order_by, *ties).sortWithinPartitions(*order_by, *ties)
    placed = ordered.withColumns(
        {"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    return index_by_storage(stored(placed, "ranges"), "_range", "_place", index)


def index_by_order(df: DataFrame, order_by: Sequence[str], index: str = "sample_idx", *, key: Sequence[str] | None = None,
                   range_rows: int = RANGE_ROWS) -> DataFrame:
    """A dense index in the order of columns; rows alike in them are numbered in any order.

    Only ``order_by`` and ``key`` are sorted, and the index is joined back by ``key``, which must tell all rows apart and is
    checked to do so: an id, or a file's path and row number (``_metadata.file_path``, ``_metadata.row_index``) of a table read straight
    from files. Without a key the rows are stored as they are, unsorted, and their place in storage is it.
    """
    if key is None:
        key = ["_file", "_line"]
        df = stored(df, "rows").select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_line"))
        drop, check = key, False
    else:
        key, drop, check = list(key), [], True
    order = ranked(df.select(*dict.fromkeys([*order_by, *key])), order_by, index, range_rows).select(*key, index)
    if check and not order.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"the key {key} does not tell all rows apart")
    return join_same(df, order, key).drop(*drop)
