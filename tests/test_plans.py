"""What the physical plans must and must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gradeloom import session
from gradeloom.plans.catalog import QUERIES
from gradeloom.operators import groups, metrics, samples
from gradeloom.operators.prefix import running_totals
from gradeloom.plans.evaluation import grade_responses
from gradeloom.session import tune
from gradeloom.sources import derived

ACTIONS = {"read_qa", "read_qa_json", "read_qa_arrow", "write_training_jsonl", "write_training_jsonl_single", "write_eval_results"}
PYTHON = {"generate_responses", "reward_registry_python"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture
def conf(spark):
    changed = {}

    def change(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - ACTIONS))
def test_jvm_only_and_no_cross_join(spark, sf_dir, key):
    text = plan(entry.queries()[key](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", text)
    assert ("Python" in text or "MapInArrow" in text) == (key in PYTHON)


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    text = plan(entry.queries()["accuracy_by_config"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all(s == "o_orderkey:bigint,o_custkey:bigint" for s in schemas)


@pytest.mark.parametrize("key", ["running_accuracy", "audit_rows", "running_accuracy_flawed", "running_accuracy_lagged"])
def test_shuffle_partitions_follow_the_input(spark, sf_dir, key, monkeypatch):
    """With a fixed number of partitions, a task of the gold join grows with the input."""
    bytes_in = sum(os.path.getsize(os.path.join(sf_dir, name)) for name in os.listdir(sf_dir))
    dealt = []
    monkeypatch.setattr(metrics, "running_totals", lambda df, *a: dealt.append(plan(df)) or running_totals(df, *a))
    monkeypatch.setattr(session, "PARTITION_BYTES", bytes_in // 40, raising=False)
    text = plan(entry.queries()[key](spark, sf_dir))
    numbers = [int(n) for n in re.findall(r"hashpartitioning\((?:run_id|sample_idx)#[^)]*, (\d+)\)", "\n".join(dealt) or text)]
    assert numbers and min(numbers) >= 40
    tune(spark)
    after = plan(spark.range(9).groupBy("id").count().groupBy("count").count())
    assert f", {spark.conf.get('spark.sql.shuffle.partitions')})" in after and ", 40)" not in after


def test_limit_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "qa")
    spark.range(100).selectExpr("id sample_idx", "'q' question").write.parquet(path)
    assert "LessThan(sample_idx,5)" in plan(samples.limit_samples(spark.read.parquet(path), 5))


def test_texts_are_pruned_before_the_join(spark, sf_dir, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    graded = grade_responses(derived.responses(spark, sf_dir), derived.qa(spark, sf_dir), max_new_tokens=250)
    text = plan(metrics.accuracy_by_config(graded))
    (left,) = re.findall(r"SortMergeJoin \[sample_idx#\d+L\].*?\n.*?Project \[([^\n]*)", text, re.S)[:1]
    assert "response" not in left.split("CASE")[0] and "question" not in text.split("Exchange hashpartitioning(config")[0]


def test_expand_is_a_generator(spark, sf_dir):
    text = plan(entry.queries()["expand_configs"](spark, sf_dir))
    assert "Generate" in text and "Join" not in text


def test_hot_sample_is_split(spark, conf):
    tune(spark)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    rows = spark.range(0, 60000, 1, 16)
    responses = rows.select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("sample_idx"),
        F.col("id").cast("int").alias("gen"),
        F.lit("cot").alias("config"),
        F.concat(F.lit("answer: "), (F.col("id") % 5).cast("string")).alias("response"),
        F.lit(5).alias("output_tokens"),
    )
    qa = spark.range(0, 5000, 1, 16).select(
        F.col("id").alias("sample_idx"), F.lit("q").alias("question"),
        F.concat(F.lit("#### "), (F.col("id") % 5).cast("string")).alias("answer"),
    )
    graded = grade_responses(responses, qa, max_new_tokens=250)
    for report in (metrics.accuracy_by_config(graded), groups.group_stats(graded), groups.best_worst(graded)):
        assert "skew=true" in final_plan(report)
    expected = rows.where("case when id % 3 = 0 then 7 % 5 else id % 5000 % 5 end = id % 5").count()
    assert metrics.accuracy_by_config(graded).first()["correct_count"] == expected


def test_group_values_take_one_window_on_the_joins_exchange(spark, sf_dir, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(entry.queries()["group_advantage"](spark, sf_dir))
    assert text.count("Window") == 1 and "Union" not in text and "LeftAnti" not in text
    assert text.count("Exchange hashpartitioning") == 2  # those of the join


def test_large_groups_meet_in_no_window(spark):
    df = spark.range(10000).select((F.col("id") % 2).alias("sample_idx"), F.col("id").alias("gen"), F.lit(1.0).alias("reward"))
    text = plan(groups.group_advantage(df, hot_rows=100))
    assert "LeftSemi" in text and "LeftAnti" in text and "partial_avg" in text


def test_group_reports_combine_before_the_shuffle(spark, sf_dir):
    for key in ("group_stats", "best_worst", "compare_runs", "eval_summary", "audit_samples", "resource_summary"):
        assert "partial_" in plan(entry.queries()[key](spark, sf_dir)), key


def test_windows_are_partitioned(spark, sf_dir):
    for key in ("running_accuracy", "running_accuracy_lagged"):
        for spec in re.findall(r"windowspecdefinition\(([^)]*)", plan(entry.queries()[key](spark, sf_dir))):
            assert spec.startswith("_range#") or spec.split(" ASC")[0].count("#") > 1, spec  # a row per sorted range, or partitioned
