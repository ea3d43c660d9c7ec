import json
import os
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradeloom.functions.prompts import build_messages
from gradeloom.operators import indexing
from gradeloom.operators.indexing import index_by_order, index_by_storage
from gradeloom.operators.samples import limit_samples, resolve_qa_columns
from gradeloom.sources.qa import read_qa
from gradeloom.sources import arrow_shards
from gradeloom.sources.workdir import stored
from gradeloom.sources.writers import run_name, write_eval_results, write_training_jsonl

ROWS = [(f"问题 {i}", f"work\n#### {i}") for i in range(1000)]


def write_shard(path, rows, batch=100):
    schema = pa.schema([("question", pa.string()), ("answer", pa.large_string())])
    with pa.ipc.new_stream(str(path), schema) as out:
        for i in range(0, len(rows), batch):
            q, a = zip(*rows[i : i + batch])
            out.write_batch(pa.record_batch([pa.array(q), pa.array(a, pa.large_string())], schema=schema))


def test_arrow_shards_split_and_indexed(spark, tmp_path):
    os.makedirs(tmp_path / "test")
    write_shard(tmp_path / "test" / "data-00000-of-00002.arrow", ROWS[:700])
    write_shard(tmp_path / "test" / "data-00001-of-00002.arrow", ROWS[700:])
    (tmp_path / "test" / "state.json").write_text("{}")
    rows = read_qa(spark, str(tmp_path), "test", "arrow", with_index=True).orderBy("sample_idx").collect()
    assert [(r["sample_idx"], r["question"], r["answer"]) for r in rows] == [(i, *r) for i, r in enumerate(ROWS)]
    sliced = spark.read.format("arrow_shards").option("splitBytes", 3000).load(str(tmp_path / "test"))
    assert sliced.rdd.getNumPartitions() == 10  # as many as there are batches
    assert sorted(tuple(r) for r in sliced.select("question", "answer").collect()) == sorted(ROWS)
    assert sliced.groupBy("shard").agg(F.max("shard_row").alias("m")).orderBy("shard").collect()[1]["m"] == 299


def test_parquet_and_json_splits(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "question string, answer string")
    df.repartition(5).write.parquet(str(tmp_path / "p" / "train"))
    df.write.json(str(tmp_path / "j" / "split=test"))
    assert read_qa(spark, str(tmp_path / "p"), "train").count() == 1000
    assert read_qa(spark, str(tmp_path / "j"), "test", "json").count() == 1000
    assert read_qa(spark, str(tmp_path / "p" / "train"), None).count() == 1000
    named = read_qa(spark, str(tmp_path / "j"), "test", "json", columns=["question", "answer"])
    assert sorted(tuple(r) for r in named.collect()) == sorted(ROWS)
    indexed = read_qa(spark, str(tmp_path / "p"), "train", with_index=True)
    assert sorted(r["sample_idx"] for r in indexed.collect()) == list(range(1000))
    with pytest.raises(ValueError, match="available: train"):
        read_qa(spark, str(tmp_path / "p"), "test")
    with pytest.raises(ValueError, match="unknown format"):
        read_qa(spark, str(tmp_path / "p"), "test", "csv")
    with pytest.raises(ValueError, match="no position"):
        read_qa(spark, str(tmp_path / "j"), "test", "json", with_index=True)


def test_column_aliases(spark):
    alt = spark.createDataFrame([("p", None, 1)], "prompt string, completion string, k int")
    assert resolve_qa_columns(alt).first().asDict() == {"k": 1, "question": "p", "answer": ""}
    both = spark.createDataFrame([(None, "p")], "question string, prompt string")
    assert resolve_qa_columns(both).first().asDict() == {"question": "", "answer": ""}


def test_limit(spark):
    df = spark.range(100).withColumnRenamed("id", "sample_idx")
    assert limit_samples(df, 7).count() == 7
    assert limit_samples(df, 0).count() == limit_samples(df, -1).count() == 100
    assert [r[0] for r in limit_samples(df, 3, None, ["sample_idx"]).collect()] == [0, 1, 2]


def test_index_by_storage_keeps_storage_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5000, 1, 7).selectExpr("id", "id % 3 as x").write.parquet(path)
    df = spark.read.parquet(path).select("id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    assert index_by_storage(df, "f", "r").where("id <> sample_idx").count() == 0


@pytest.mark.parametrize("range_rows", [700, 1 << 20])
def test_index_by_order_spreads_a_hot_key(spark, tmp_path, range_rows):
    path = str(tmp_path / "t")
    spark.range(20000).select("id", F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 5 > 0, F.col("id") % 100).alias("k")).write.parquet(path)
    for key in (None, ["id"]):
        indexed = index_by_order(spark.read.parquet(path), ["k"], key=key, range_rows=range_rows)
        rows = indexed.select("id", "k", "sample_idx").orderBy("sample_idx").collect()
        assert [r["sample_idx"] for r in rows] == list(range(20000)) and len({r["id"] for r in rows}) == 20000
        assert [r["k"] for r in rows] == sorted((r["k"] for r in rows), key=lambda k: (k is not None, k))


def test_index_by_order_takes_a_key_only_if_it_tells_rows_apart(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, None)], "k int, x string")
    with pytest.raises(ValueError):
        index_by_order(rows, ["x"], key=["k"])
    got = index_by_order(rows, ["x"], key=["k", "x"]).orderBy("sample_idx").collect()
    assert [r["x"] for r in got] == [None, "a", "a", "b"] and index_by_order(rows.limit(0), ["x"], key=["k"]).count() == 0


def test_index_by_order_sorts_and_stores_no_texts(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(indexing, "stored", lambda df, name: kept.append(df.columns) or stored(df, name))
    rows = spark.range(100).select("id", F.lit("a long text").alias("text"))
    assert index_by_order(rows, ["id"], key=["id"]).columns == ["id", "text", "sample_idx"]
    assert kept and not any("text" in columns for columns in kept)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_one_training_file_in_order(spark, tmp_path, n, monkeypatch):
    path = str(tmp_path / "chat.jsonl")
    rows = spark.range(n).select(F.col("id").alias("sample_idx"), F.concat(F.lit("é "), F.col("id").cast("string")).alias("solution")).orderBy(F.rand(3))
    monkeypatch.setattr(type(rows), "coalesce", None)
    for _ in range(2):
        write_training_jsonl(rows, path, columns=["solution"], single_file=True, mode="overwrite")
        with open(path, encoding="utf-8") as file:
            assert [json.loads(line) for line in file] == [{"solution": f"é {k}"} for k in range(n)]
        assert spark.read.schema("solution string").json(path).count() == n
    assert os.listdir(tmp_path) == ["chat.jsonl"]
    with pytest.raises(FileExistsError):
        write_training_jsonl(rows, path, columns=["solution"], single_file=True)
    with pytest.raises(ValueError):
        write_training_jsonl(rows, path, single_file=True, mode="append")


def test_one_training_file_of_several_parts(spark, tmp_path):
    path, held = str(tmp_path / "chat.jsonl"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_training_jsonl(spark.range(5000).select(F.col("id").alias("sample_idx")), path, single_file=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    with open(path, encoding="utf-8") as file:
        assert [json.loads(line)["sample_idx"] for line in file] == list(range(5000))
    assert os.listdir(tmp_path) == ["chat.jsonl"]


def test_jsonl_keeps_text_unescaped(spark, tmp_path):
    df = spark.createDataFrame([("答案是 é \"x\"\n", "7"), (None, "8")], "q string, solution string")
    rows = df.select(build_messages(F.col("q")).alias("messages"), "solution")
    write_training_jsonl(rows.coalesce(1), str(tmp_path / "out"))
    (part,) = [f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]
    text = (tmp_path / "out" / part).read_text(encoding="utf-8")
    assert "答案是 é" in text
    lines = [json.loads(line) for line in text.splitlines()]
    assert lines[0] == {"messages": [{"role": "user", "content": "答案是 é \"x\"\n"}], "solution": "7"}
    assert lines[1]["messages"][0] == {"role": "user", "content": None}


def test_eval_results_folders(spark, tmp_path):
    graded = spark.createDataFrame([("r1", "cot", 1, True), ("r2", "cot", 1, False)], "run_id string, config string, sample_idx int, correct boolean")
    metrics = spark.createDataFrame([("r1", 100.0), ("r2", None)], "run_id string, accuracy double")
    write_eval_results(graded, metrics, str(tmp_path / "o"), fmt="json")
    assert os.path.isdir(tmp_path / "o" / "details" / "run_id=r1" / "config=cot")
    assert spark.read.json(str(tmp_path / "o" / "metrics")).count() == 2
    assert run_name("/models/tiny-1b/", "cot", datetime(2024, 4, 15, 12, 34, 56)) == "tiny-1b_cot_20240415_123456"


def shard_reader(folder, split):
    found = arrow_shards.ArrowShards({"path": str(folder), "splitbytes": str(split)})
    return found.reader(found.schema())


def test_arrow_slices_seek_and_headers_are_walked_once(tmp_path, monkeypatch):
    rows = ROWS * 3
    write_shard(tmp_path / "data-00000-of-00001.arrow", rows, batch=3)
    walked = []
    monkeypatch.setattr(arrow_shards, "next_message", lambda source: walked.append(1) or pa.ipc.read_message(source) if source.tell() < source.size() - 8 else None)
    reader = shard_reader(tmp_path, 2000)
    slices = reader.partitions()
    assert len(slices) > 50 and len(walked) == 1001  # the schema and each batch, whatever the number of slices
    got = [(b.column(0)[k].as_py(), b.column(3)[k].as_py()) for piece in slices for b in reader.read(piece) for k in range(b.num_rows)]
    assert got == [(q, k) for k, (q, _) in enumerate(rows)] and len(walked) == 1001
    assert all(sum(end - start for start, end in piece.ranges) < 4000 for piece in slices)
    walked.clear()
    assert len(shard_reader(tmp_path, 10**9).partitions()) == 1 and not walked


@pytest.mark.parametrize("split", [1, 700, 10**9])
def test_arrow_slices_with_growing_dictionaries_and_empty_batches(tmp_path, split):
    words = [["a", "b"], ["a", "b", "c"], [], ["x"], ["x", None, "x"]]
    schema = pa.schema([("word", pa.dictionary(pa.int32(), pa.string())), ("n", pa.int64())])
    want = []
    with pa.ipc.new_stream(str(tmp_path / "data-00000-of-00001.arrow"), schema) as out:
        for k, part in enumerate(words * 4):
            out.write_batch(pa.record_batch([pa.array(part, pa.string()).dictionary_encode(), pa.array([k] * len(part), pa.int64())], schema=schema))
            want += [(w, k) for w in part]
    reader = shard_reader(tmp_path, split)
    got = [tuple(r.values()) for piece in reader.partitions() for b in reader.read(piece) for r in b.to_pylist()]
    assert [(w, n) for w, n, _, _ in got] == want and [r for *_, r in got] == list(range(len(want)))
    with pa.ipc.new_stream(str(tmp_path / "data-00000-of-00001.arrow"), schema):
        pass
    empty = shard_reader(tmp_path, split)
    assert not [b for piece in empty.partitions() for b in empty.read(piece)]


def test_arrow_shards_keep_types_and_read_wanted_columns(spark, tmp_path):
    folder = tmp_path / "test"
    folder.mkdir()
    table = pa.table({"question": ["a", "b"], "answer": ["1", None], "tags": [["x"], []], "level": pa.array([1, None], pa.int32()), "extra": pa.nulls(2)})
    with pa.OSFile(str(folder / "data-00000-of-00001.arrow"), "wb") as sink, pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    every = read_qa(spark, str(tmp_path), "test", "arrow")
    assert dict(every.dtypes) == {"tags": "array<string>", "level": "int", "extra": "string", "question": "string", "answer": "string"}
    assert sorted((r["question"], r["answer"], r["tags"], r["level"], r["extra"]) for r in every.collect()) == [("a", "1", ["x"], 1, None), ("b", "", [], None, None)]
    few = read_qa(spark, str(tmp_path), "test", "arrow", columns=["question", "answer"])
    assert few.columns == ["question", "answer"] and few.count() == 2
