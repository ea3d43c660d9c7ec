"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gradeloom.sources.storage import folder_bytes

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot sample of the gold join also when a grouping by sample follows. By default the
    # grouping reuses the join's partitioning, and the hot sample stays in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# A task of the gold join takes some 25 to 35 times its compressed shuffle bytes in memory, so tasks are dealt by bytes: shuffles start
# with a partition for so many bytes of input, and adaptive execution puts them together up to the advisory size.
PARTITION_BYTES = 4 << 20
ADVISORY_BYTES = 16 << 20
PARTITIONS, ADVISORY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_BEFORE = "gradeloom.before."  # names of what these two were without an input


def tune(spark: SparkSession, source: str | None = None) -> SparkSession:
    """Apply the settings to a running session, with a folder of input also those that follow its size."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    for name in (PARTITIONS, ADVISORY):
        before = spark.conf.get(_BEFORE + name, None)
        if before is None:
            spark.conf.set(_BEFORE + name, spark.conf.get(name, None) or "")
        elif before:
            spark.conf.set(name, before)
        else:
            spark.conf.unset(name)
    if source is not None:
        most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(PARTITIONS, None) or 0))
        spark.conf.set(PARTITIONS, max(most, -(-folder_bytes(spark, source) // PARTITION_BYTES)))
        spark.conf.set(ADVISORY, ADVISORY_BYTES)
    return spark
