"""Run a stream over the input that is there now and give its result as a table."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from gradeloom.sources.workdir import new_path
from gradeloom.streaming.sink import MergeTable


class Progress(StreamingQueryListener):
    """Batches, input rows, and rows that stateful operators dropped as late, by query.

    An aggregate counts late rows after its map-side combine, so late rows of one key within one task are one.
    """

    def __init__(self):
        self.counts: dict[str, Counter] = defaultdict(Counter)
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.counts[str(progress.id)].update(
            batches=1,
            input_rows=sum(s.numInputRows for s in progress.sources),
            late_rows=sum(o.numRowsDroppedByWatermark for o in progress.stateOperators),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)].set()


@dataclass(frozen=True)
class Drained:
    table: MergeTable
    batches: int
    input_rows: int
    late_rows: int

    def rows(self) -> DataFrame:
        return self.table.read()


def start_merge(stream: DataFrame, table: MergeTable, checkpoint: str, **trigger) -> StreamingQuery:
    """Start keeping a table up to date with a stream of changed rows; triggers as in ``DataStreamWriter.trigger``."""
    return stream.writeStream.outputMode("update").foreachBatch(table.write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def drain_to_table(stream: DataFrame, keys: Sequence[str], *, path: str | None = None, checkpoint: str | None = None, full_every: int = 16) -> Drained:
    """Merge all the input that is there now into a keyed table, and tell how much there was and how much came too late.

    A later call with the same path and checkpoint goes on where this one stopped.
    """
    spark = stream.sparkSession
    schema = ", ".join(f"`{name}` {kind}" for name, kind in stream.dtypes)
    table = MergeTable(spark, path or new_path(spark, "merged"), keys, schema, full_every=full_every)
    seen = Progress()
    spark.streams.addListener(seen)
    try:
        query = start_merge(stream, table, checkpoint or new_path(spark, "stream"), availableNow=True)
        query.awaitTermination()
        seen.ended[str(query.id)].wait(30)  # events arrive in order, the end last
    finally:
        spark.streams.removeListener(seen)
    counts = seen.counts[str(query.id)]
    return Drained(table, counts["batches"], counts["input_rows"], counts["late_rows"])


def drain_to_files(stream: DataFrame) -> DataFrame:
    """Closed windows of a watermarked aggregate: append mode into a Parquet folder."""
    spark = stream.sparkSession
    path = new_path(spark, "windows")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", new_path(spark, "stream"))
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
