"""Each live report equals its batch form on the same rows, whatever the batches, restarts and late rows."""

import pytest
from pyspark.sql import functions as F

from gradeloom.sources.derived import memory_readings, memory_samples
from gradeloom.sources.storage import folder_names
from gradeloom.streaming.drain import drain_to_files, drain_to_table, start_merge
from gradeloom.streaming.live import stream_peak_memory, stream_resource_windows, stream_running_accuracy
from gradeloom.streaming.sink import MergeTable

KEY = ("run_id", "config", "sample_idx")


def stream_of(spark, df, path, files=4):
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def rounded(df):
    # Sums in another order differ in the last bits; the small shift keeps values that end on a 5 from rounding either way.
    columns = [F.round(F.col(c) + 3e-12, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def graded_events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        (F.col("user_id") % 5).alias("run_id"), F.col("event_type").alias("config"), F.col("event_id").alias("sample_idx"),
        (F.col("value") > 10).alias("correct"), F.col("ts").cast("timestamp").alias("ts"),
    )


def test_running_accuracy_counts_copies_once(spark, sf_dir, tmp_path):
    events = graded_events(spark, sf_dir)
    copies = events.unionByName(events.where("run_id = 1")).unionByName(events.where("run_id = 1"))
    stream = stream_of(spark, copies, str(tmp_path / "in"))
    done = drain_to_table(stream_running_accuracy(stream, key=KEY, delay="60 days"), ["run_id"])
    assert rounded(done.rows()) == rounded(stream_running_accuracy(copies, key=KEY, delay="60 days"))
    assert done.rows().agg(F.sum("seen")).first()[0] == events.count()
    assert done.batches >= 4 and done.late_rows == 0 and done.input_rows == copies.count()


def test_peak_memory(spark, sf_dir, tmp_path):
    readings = memory_readings(spark, sf_dir)
    final = drain_to_table(stream_peak_memory(stream_of(spark, readings, str(tmp_path / "in"))), ["run_id"]).rows()
    assert rounded(final) == rounded(stream_peak_memory(readings))


def test_windows_of_events_one_file_per_trigger(spark, sf_dir, tmp_path):
    samples = memory_samples(spark, sf_dir)
    stream = stream_of(spark, samples.orderBy("ts"), str(tmp_path / "in"), 5)
    done = drain_to_table(stream_resource_windows(stream, "1 hour", delay="60 days"), ["window_start", "config"], full_every=2)
    assert rounded(done.rows()) == rounded(stream_resource_windows(samples, "1 hour"))
    assert done.batches >= 5 and done.late_rows == 0


def test_late_rows_are_counted_and_left_out(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = "config string, ts timestamp, used_mb double"
    rows = spark.createDataFrame([("a", 1_700_000_000, 1.0), ("a", 1_700_000_600, 2.0)], "config string, t long, used_mb double")
    first = rows.select("config", F.timestamp_seconds("t").alias("ts"), "used_mb")
    late = first.where("used_mb = 1").withColumn("used_mb", F.lit(9.0))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def drain():
        stream = spark.readStream.schema(schema).parquet(path)
        return drain_to_table(stream_resource_windows(stream, "5 seconds", delay="1 minute"), ["window_start", "config"], path=out, checkpoint=checkpoint)

    first.coalesce(1).write.mode("append").parquet(path)
    assert drain().late_rows == 0
    late.coalesce(1).write.mode("append").parquet(path)
    done = drain()
    assert done.late_rows == 1
    assert rounded(done.rows()) == rounded(stream_resource_windows(first, "5 seconds"))


@pytest.mark.parametrize("width", ["5 seconds", "1 minute"])
def test_five_second_windows_in_files(spark, tmp_path, width):
    per_second = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("config"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"),
        (F.col("id") % 37 * 100.0).alias("used_mb"),
    )
    end = spark.createDataFrame([("end", 1_700_100_000, 0.0)], "config string, t long, used_mb double").select(
        "config", F.timestamp_seconds("t").alias("ts"), "used_mb"
    )
    path = str(tmp_path / "in")
    stream = stream_of(spark, per_second, path, 1)
    end.coalesce(1).write.mode("append").parquet(path)
    windows = drain_to_files(stream_resource_windows(stream, width)).where("config <> 'end'")
    assert rounded(windows) == rounded(stream_resource_windows(per_second, width))


@pytest.mark.parametrize("fails", ["before the rows are complete", "before the version is logged", "after the version is logged"])
def test_restart_repeats_a_batch_and_the_table_stays_right(spark, sf_dir, tmp_path, fails):
    events = graded_events(spark, sf_dir)
    stream = stream_running_accuracy(stream_of(spark, events, str(tmp_path / "in"), 5), key=KEY, delay="60 days")
    schema = ", ".join(f"{n} {t}" for n, t in stream.dtypes)
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    taken = []

    class Failing(MergeTable):
        def write(self, changed, batch, stream=None):
            taken.append(batch)
            if batch != 2:
                return super().write(changed, batch, stream)
            if fails == "after the version is logged":
                super().write(changed, batch, stream)
            else:
                version = self.state().version + 1
                some = changed.limit(1) if fails == "before the rows are complete" else changed
                some.select(*self.names).write.mode("overwrite").parquet(f"{self.path}/rows/version={version}")
            raise RuntimeError("executor gone")

    with pytest.raises(Exception, match="executor gone"):
        start_merge(stream, Failing(spark, path, ["run_id"], schema), checkpoint, availableNow=True).awaitTermination()
    before = MergeTable(spark, path, ["run_id"], schema)
    version = before.state().version
    assert version == (2 if fails == "after the version is logged" else 1) and before.read().count() == 5
    done = drain_to_table(stream, ["run_id"], path=path, checkpoint=checkpoint)
    log = spark.read.parquet(f"{path}/log")
    assert taken == [0, 1, 2] and log.count() == log.select("batch").distinct().count() == done.table.state().version + 1
    assert done.table.state().version >= 4  # a batch per file; one without data may follow
    assert rounded(done.rows()) == rounded(stream_running_accuracy(events, key=KEY, delay="60 days"))


def test_table_keeps_versions_and_nulls(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), ["k"], "k int, name string, n bigint", full_every=3)
    assert table.read().count() == 0 and table.state().version == -1
    steps = [[(1, "a", 1), (None, "x", 0)], [(1, None, 2), (2, "b", 5)], [], [(None, "y", 7)], [(2, "c", None)], [(3, "d", 1)], [(3, "e", 2)]]
    want, at = {}, []
    for batch, rows in enumerate(steps):
        table.write(spark.createDataFrame(rows, table.schema), batch, "s")
        want |= {r[0]: r for r in rows}
        at.append(sorted(map(str, want.values())))
        assert sorted(map(str, map(tuple, table.read().collect()))) == at[-1]
    table.write(spark.createDataFrame([(9, "repeated", 9)], table.schema), 6, "s")
    table.write(spark.createDataFrame([(9, "repeated", 9)], table.schema), 3, "s")
    assert [sorted(map(str, map(tuple, table.read(as_of=v).collect()))) for v in range(7)] == at
    table.write(spark.createDataFrame([(9, "other", 9)], table.schema), 0, "another stream")
    assert table.state().version == 7 and table.read().count() == 5
    table.vacuum(keep=2)
    assert table.read().count() == 5 and sorted(map(str, map(tuple, table.read(as_of=6).collect()))) == at[6]
    left = [n for n in folder_names(spark, str(tmp_path / "t/rows"))]
    assert left == ["version=7"] and folder_names(spark, str(tmp_path / "t/full")) == ["version=6"]
    table.write(spark.createDataFrame([(9, "again", 9)], table.schema), 0, "another stream")
    table.write(spark.createDataFrame([(9, "again", 9)], table.schema), 6, "s")
    assert table.state().version == 7


def test_keys_alone_and_wrong_schemas(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), ["k"], "k int")
    for batch in range(2):
        table.write(spark.createDataFrame([(1,), (batch,)], "k int").distinct(), batch, "s")
    assert sorted(r["k"] for r in table.read().collect()) == [0, 1]
    for keys, schema in ((["a"], "k int"), (["k"], "k int, version int")):
        with pytest.raises(ValueError):
            MergeTable(spark, str(tmp_path / "u"), keys, schema)


def test_reading_the_table_is_a_hash_aggregate_without_the_driver(spark, sf_dir, tmp_path):
    readings = memory_readings(spark, sf_dir)
    final = drain_to_table(stream_peak_memory(stream_of(spark, readings, str(tmp_path / "in"))), ["run_id"]).rows()
    text = final._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "Sort" not in text and "LocalTableScan" not in text and "FileScan parquet" in text


def test_windows_of_events(spark, sf_dir):
    assert stream_resource_windows(memory_samples(spark, sf_dir), "1 hour").count() > 0
