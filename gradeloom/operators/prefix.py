"""Running totals that need no task to see a whole run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.operators.indexing import RANGE_ROWS, join_same, ranked

BLOCK = 1 << 16


def running_totals(df: DataFrame, by: Sequence[str], order: str, values: Sequence[str], *, block: int = BLOCK,
                   range_rows: int = RANGE_ROWS) -> DataFrame:
    """Inclusive running totals ``cum_<value>`` of each run in the order of a column of any sortable type.

    The input holds one row per ``(by, order)``; a NULL run is a run, and a NULL position comes first. Rows get their
    exact rank over all runs, and a block is a run of ``block`` consecutive ranks. Rows are summed inside blocks, block totals
    inside groups of blocks, and only the group totals are ordered per run. So no window partition holds more than ``block``
    rows, whatever the positions are (dense, hashed, text), as long as a run has fewer than ``block`` cubed rows (2.8e14 by default).
    """
    by = list(by)
    in_block = ranked(df.select(*by, order, *values), [*by, order], "_rank", range_rows).withColumn("_block", F.expr(f"_rank div {int(block)}"))
    blocks = in_block.groupBy(*by, "_block").agg(*[F.sum(v).alias(v) for v in values])
    in_group = blocks.withColumn("_group", F.expr(f"_block div {int(block)}"))
    groups = in_group.groupBy(*by, "_group").agg(*[F.sum(v).alias(v) for v in values])

    def before(keys: list[str], position: str):
        return Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)

    group_start = groups.select(
        *by, "_group", *[F.coalesce(F.sum(v).over(before(by, "_group")), F.lit(0)).alias(f"_g_{v}") for v in values]
    )
    block_start = in_group.select(
        *by,
        "_group",
        "_block",
        *[F.coalesce(F.sum(v).over(before([*by, "_group"], "_block")), F.lit(0)).alias(f"_b_{v}") for v in values],
    )
    starts = join_same(block_start, group_start, [*by, "_group"]).select(
        *by, "_block", *[(F.col(f"_g_{v}") + F.col(f"_b_{v}")).alias(f"_s_{v}") for v in values]
    )
    within = Window.partitionBy(*by, "_block").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = in_block.withColumns({f"_w_{v}": F.sum(v).over(within) for v in values})
    return join_same(rows, starts, [*by, "_block"]).select(
        *by, order, *values, *[(F.col(f"_s_{v}") + F.col(f"_w_{v}")).alias(f"cum_{v}") for v in values]
    )
