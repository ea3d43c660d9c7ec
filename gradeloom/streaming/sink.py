"""A table keyed by columns that a stream keeps up to date, for live reports that others read while the stream runs.

A stream in update mode gives the changed rows of each batch. ``MergeTable.write`` stores them as one more version in a folder
that every executor and reader can reach, and a reader sees the latest row of each key. Under the table's path lie

    rows/version=V   rows changed by version V
    full/version=V   the whole table at version V, written every ``full_every`` versions
    log/version=V    the stream and the batch that made V; at a full table one row for each stream there has been

The rows in ``log`` are written last and make a version visible, so rows of a batch that failed halfway are never read and
are overwritten by its repetition. A batch that is repeated after its version was logged, which happens when a stream stops between
the sink's write and its own checkpoint, is known by stream and batch number and not
stored again. One stream at a time writes to a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.sources.storage import delete_tree, folder_names

_LOG = "version bigint, stream string, batch bigint, full boolean"


@dataclass(frozen=True)
class State:
    """The last version, the last version with a full table, and the last batch taken from a stream (-1: none)."""

    version: int
    full: int
    batch: int


class MergeTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, *, full_every: int = 16, files: int = 1):
        """``schema`` is that of the rows, as DDL; ``files`` is the number of files per version, 1 for reports of few rows."""
        if full_every < 1 or files < 1:
            raise ValueError("full_every and files start at 1")
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        self.full_every, self.files = full_every, files
        self.names = spark.createDataFrame([], schema).columns
        if not set(self.keys) <= set(self.names) or "version" in self.names:
            raise ValueError(f"the rows need the columns {self.keys} and none named version")
        self.values = [c for c in self.names if c not in self.keys]

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def state(self, stream: str | None = None, as_of: int | None = None) -> State:
        log = self._log() if as_of is None else self._log().where(F.col("version") <= as_of)
        row = log.agg(
            F.max("version"), F.max(F.when(F.col("full"), F.col("version"))), F.max(F.when(F.col("stream") == stream, F.col("batch")))
        ).first()
        return State(*[-1 if v is None else v for v in row])

    def _part(self, kind: str, after: int, upto: int) -> DataFrame:
        rows = self.spark.read.schema(f"{self.schema}, version bigint").parquet(f"{self.path}/{kind}")
        return rows.where((F.col("version") > after) & (F.col("version") <= upto))

    def _latest(self, full: int, upto: int) -> DataFrame:
        """Rows of the full table at ``full`` with the changes up to ``upto``: one combinable aggregate, NULL keys being keys."""
        changes = self._part("rows", full, upto)
        rows = changes if full < 0 else changes.unionByName(self._part("full", full - 1, full))
        if not self.values:
            return rows.select(*self.keys).distinct()
        return rows.groupBy(*self.keys).agg(*[F.max_by(c, "version").alias(c) for c in self.values]).select(*self.names)

    def read(self, as_of: int | None = None) -> DataFrame:
        """The latest row of each key, at the last version or at an earlier one."""
        state = self.state(as_of=as_of)
        if state.version < 0:
            return self.spark.createDataFrame([], self.schema)
        return self._latest(state.full, state.version)

    def write(self, changed: DataFrame, batch: int, stream: str | None = None) -> None:
        """Take the changed rows of a batch, at most one per key. For ``foreachBatch``; ``stream`` defaults to the running query's id."""
        stream = stream or self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        state = self.state(stream)
        if batch <= state.batch:  # known, but the stream's own state of the batch has yet to be stored
            changed.write.format("noop").mode("overwrite").save()
            return
        version = state.version + 1
        changed.select(*self.names).repartition(self.files).write.mode("overwrite").parquet(f"{self.path}/rows/version={version}")
        full = version - max(state.full, 0) >= self.full_every
        if full:
            whole = self._latest(state.full, version)
            whole.repartition(self.files).write.mode("overwrite").parquet(f"{self.path}/full/version={version}")
        entry = self.spark.createDataFrame([(stream, batch, full)], "stream string, batch bigint, full boolean")
        if full:  # earlier rows of the log are not needed any more
            known = self._log().where(F.col("stream") != stream).groupBy("stream").agg(F.max("batch").alias("batch"), F.lit(True).alias("full"))
            entry = entry.unionByName(known)
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/version={version}")

    def vacuum(self, keep: int = 1) -> None:
        """Delete what neither the last ``keep`` versions nor the guard against repeated batches needs; readers of older versions must have ended."""
        base = self.state(as_of=self.state().version - keep + 1).full
        for kind, last in (("rows", base), ("full", base - 1), ("log", base - 1)):
            for name in folder_names(self.spark, f"{self.path}/{kind}"):
                if name.startswith("version=") and int(name.removeprefix("version=")) <= last:
                    delete_tree(self.spark, f"{self.path}/{kind}/{name}")
