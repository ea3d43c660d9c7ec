import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gradeloom.functions.rewards import RewardRegistry, dpo_loss, dpo_margin
from gradeloom.operators import groups, metrics, prefix, resources, samples, skew, tables
from gradeloom.operators.indexing import ranked
from gradeloom.operators.inference import GenerationParams, generate_responses
from gradeloom.operators.prefix import running_totals


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(1)
    rows = []
    for run in (0, 1, 2):
        for i in range(500):
            if run == 2 and i % 7 == 0:
                continue
            rows.append((run, f"c{run}", i * (1 if run else 977), 0, rng.random() < 0.6, rng.randint(1, 99), rng.randint(1, 99),
                         rng.random() < 0.1, float(rng.randint(0, 1))))
    schema = "run_id int, config string, sample_idx bigint, gen int, correct boolean, input_tokens int, output_tokens int, truncated boolean, reward double"
    return spark.createDataFrame(rows, schema).repartition(4).cache()


@pytest.mark.parametrize("block", [2, 7, 100000])
def test_running_totals_equal_a_plain_window(graded, block):
    df = graded.select("run_id", "sample_idx", F.lit(1).cast("long").alias("n"), F.col("correct").cast("long").alias("c"))
    w = Window.partitionBy("run_id").orderBy("sample_idx").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("run_id", "sample_idx", "n", "c", F.sum("n").over(w), F.sum("c").over(w))
    assert rows_of(running_totals(df, ["run_id"], "sample_idx", ["n", "c"], block=block)) == rows_of(want)


@pytest.mark.parametrize("kind", ["string", "timestamp", "double"])
def test_running_totals_in_the_order_of_any_type(spark, kind):
    order = {"string": F.sha2(F.col("id").cast("string"), 256), "timestamp": F.timestamp_seconds(F.xxhash64("id") % 10**9), "double": F.rand(1)}[kind]
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("run_id"), order.alias("at"), F.col("id").alias("n")).cache()
    w = Window.partitionBy("run_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    got, want = running_totals(df, ["run_id"], "at", ["n"], block=50, range_rows=700), df.withColumn("c", F.sum("n").over(w))
    assert sorted(map(str, got.collect())) == sorted(str(r).replace("c=", "cum_n=") for r in want.collect())


def test_hashed_positions_of_one_huge_run_fill_blocks(spark, monkeypatch):
    n = 10_000_000
    df = spark.range(n).select(F.lit("run").alias("run_id"), F.xxhash64("id").alias("at"), F.lit(1).cast("long").alias("one"))
    seen = []
    monkeypatch.setattr(prefix, "ranked", lambda *args: seen.append(ranked(*args)) or seen[-1])
    out = running_totals(df, ["run_id"], "at", ["one"])
    blocks = seen[0].groupBy("run_id", F.expr(f"_rank div {prefix.BLOCK}").alias("b")).count().agg(F.max("count"), F.count("*")).first()
    assert tuple(blocks) == (prefix.BLOCK, -(-n // prefix.BLOCK))
    ends = out.agg(F.max("cum_one"), F.count_distinct("cum_one"), F.corr("at", "cum_one")).first()
    assert ends[0] == ends[1] == n and ends[2] > 0.999


def test_batch_ids_are_exact_for_large_indexes(spark):
    df = spark.createDataFrame([(2**60 + 31,), (2**60 + 32,)], "sample_idx bigint")
    assert [r["batch_id"] for r in samples.assign_batches(df, 32).collect()] == [2**55, 2**55 + 1]


def test_running_accuracy_ends_at_the_summary(graded):
    running = metrics.running_accuracy(graded)
    last = running.groupBy("run_id").agg(F.max_by("accuracy", "sample_idx"))
    assert rows_of(last) == rows_of(metrics.eval_summary(graded).select("run_id", "accuracy"))


def test_copies_of_a_sample_count_once_per_row(spark):
    df = spark.createDataFrame([(0, 0, True)] * 50 + [(0, 1, False)] * 50, "run_id int, sample_idx bigint, correct boolean")
    assert rows_of(metrics.running_accuracy(df)) == [(0, 0, 50, 50, 100.0), (0, 1, 100, 50, 50.0)]


def test_lagged_accuracy_leaves_out_its_own_batch(spark):
    df = spark.createDataFrame([(0, i, i % 2 == 0) for i in range(5)], "run_id int, sample_idx bigint, correct boolean")
    out = rows_of(metrics.running_accuracy_lagged(samples.assign_batches(df, 2)))
    assert [(r[1], r[2], r[3]) for r in out] == [(0, 2, 0), (1, 4, 1), (2, 5, 2)]


@pytest.mark.parametrize("hot_rows", [0, 3, 1_000_000])
def test_group_values_equal_a_plain_window(spark, hot_rows):
    rng = random.Random(5)
    rows = [(7 if rng.random() < 0.4 else rng.randint(0, 300), i, float(rng.randint(0, 1))) for i in range(5000)]
    rows += [(None, i, 1.0) for i in range(20)] + [(7, 1, 1.0)] * 10
    df = spark.createDataFrame(rows, "sample_idx int, gen int, reward double")
    w = Window.partitionBy("sample_idx")
    want = df.withColumn("group_mean", F.avg("reward").over(w)).withColumn("advantage", F.col("reward") - F.col("group_mean"))
    key = lambda r: tuple((x is not None, x) for x in r)
    got = groups.group_advantage(df, hot_rows=hot_rows)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_more_hot_groups_than_a_sketch_tracks(spark):
    df = spark.range(4000).select((F.col("id") % 40).alias("k"), "id")
    assert len(skew.hot_keys(df, ["k"], 10, tracked=16)) <= 16
    assert len(skew.hot_keys(df, ["k"], 10)) == 40 and skew.hot_keys(df.limit(0), ["k"]) == []


def test_sketch_finds_hot_groups_among_many_small_ones(spark):
    df = spark.range(300000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("x"))
    assert len(skew.hot_keys(df, ["k"], 50000, tracked=64)) == 2
    got = skew.with_group_values(df, ["k"], {"n": F.count("*"), "top": F.max("x")}, hot_rows=50000)
    assert got.count() == 300000
    assert {(r["k"], r["n"], r["top"]) for r in got.where("n > 1").distinct().select("k", "n", "top").collect()} == {(None, 100000, 6), (-1, 100000, 6)}


@pytest.mark.parametrize("hot_rows", [1, 10, float("inf")])
def test_padded_tokens_whatever_is_hot(graded, hot_rows):
    batched = samples.assign_batches(graded, 32)
    w = Window.partitionBy("run_id", "batch_id")
    want = batched.withColumns({"input_tokens": F.max("input_tokens").over(w), "output_tokens": F.max("output_tokens").over(w)})
    assert rows_of(metrics.with_batch_padded_tokens(batched, hot_rows=hot_rows)) == rows_of(want)


def test_advantages_sum_to_zero(graded):
    sums = groups.group_advantage(graded).groupBy("sample_idx").agg(F.sum("advantage").alias("s"))
    assert sums.where("abs(s) > 1e-9").count() == 0


def test_batch_padding(graded):
    batched = samples.assign_batches(graded, 32)
    w = Window.partitionBy("run_id", "batch_id")
    want = batched.withColumns({"input_tokens": F.max("input_tokens").over(w), "output_tokens": F.max("output_tokens").over(w)})
    assert rows_of(metrics.with_batch_padded_tokens(batched)) == rows_of(want)
    stats = metrics.batch_token_stats(batched)
    assert stats.where("padding_pct < 0 or input_padding < 0").count() == 0
    one = batched.limit(1)
    assert metrics.batch_token_stats(one).first()["padding_pct"] == 0.0


def test_best_worst_ties(spark):
    rows = [(1, g, r, f"t{g}") for g, r in enumerate([0.0, 1.0, 1.0, 0.0])] + [(2, 0, 1.0, "x"), (3, 0, 0.5, "a"), (3, 1, 0.5, "b")]
    df = spark.createDataFrame(rows, "sample_idx int, gen int, reward double, response string")
    ends = {r["sample_idx"]: (r["best_gen"], r["worst_gen"]) for r in groups.best_worst(df).collect()}
    assert ends == {1: (1, 3), 2: (0, 0), 3: (0, 1)}
    qa = spark.createDataFrame([(i, f"q{i}", "a") for i in (1, 2, 3)], "sample_idx int, question string, answer string")
    assert rows_of(tables.build_preference_pairs(df, qa)) == [(1, "q1", "t1", "t3")]
    assert tables.build_preference_pairs(df, qa, drop_ties=False).count() == 3


def test_compare_runs_counts(spark):
    rows = [(0, 1, True), (1, 1, False), (0, 2, False), (1, 2, True), (0, 3, True), (1, 3, True), (0, 4, False), (2, 4, True)]
    df = spark.createDataFrame(rows, "run_id int, sample_idx int, correct boolean")
    r = metrics.compare_runs(df, 0, 1, key=("sample_idx",)).first()
    assert (r["n_samples"], r["fixed"], r["broken"], r["both"], r["neither"], r["lift"]) == (3, 1, 1, 1, 0, 0.0)
    assert metrics.compare_runs(df, 8, 9, key=("sample_idx",)).first()["lift"] is None


def test_compare_runs_takes_each_generation(spark):
    rows = [(run, 0, "cot", gen, gen == run) for run in (0, 1) for gen in range(4)]
    df = spark.createDataFrame(rows, "run_id int, sample_idx int, config string, gen int, correct boolean")
    r = metrics.compare_runs(df, 0, 1).first()
    assert (r["n_samples"], r["correct_a"], r["correct_b"], r["fixed"], r["broken"]) == (4, 1, 1, 1, 1)
    assert metrics.compare_runs(df, 0, 1, key=("sample_idx",)).first()["both"] == 1  # any generation counts


def test_dataset_profile_of_all_forms(spark):
    rows = [("a", "q", "#### 5"), ("a", "question", "<<2+3=5>> left"), ("a", "q", "five is 5"), ("a", None, None)]
    r = metrics.dataset_profile(spark.createDataFrame(rows, "split string, question string, answer string")).first()
    assert (r["n_rows"], r["question_min_chars"], r["question_max_chars"], r["answer_max_chars"]) == (4, 1, 8, 14)
    assert [r[f"gold_{form}_pct"] for form in ("marker", "annotation", "number", "text")] == [25.0] * 4


def test_preference_margin_with_reference(spark):
    values = spark.sql("select -1d a, -2d b, -1d c, -4d d").select(
        dpo_margin(F.col("a"), F.col("b")).alias("plain"), dpo_margin(*map(F.col, "abcd")).alias("against_reference")
    ).first()
    assert tuple(values) == (1.0, -2.0)
    with pytest.raises(ValueError):
        dpo_margin(F.col("a"), F.col("b"), F.col("c"))


def test_batches_cross_arrow_borders(spark):
    def loader():
        return lambda prompts, params: ([str(len(prompts))] * len(prompts), [1] * len(prompts), [1] * len(prompts))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 50, 1, 1).selectExpr("id", "'p' as prompt")
        sizes = sorted(int(r["response"]) for r in generate_responses(df, loader, GenerationParams(batch_size=32)).collect())
        dealt = generate_responses(df, loader, GenerationParams(batch_size=32), partitions=5, timed=True)
        assert dealt.rdd.getNumPartitions() == 5 and dealt.where("elapsed_s >= 0").count() == 50
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sizes == [18] * 18 + [32] * 32


def test_empty_run_has_null_accuracy(spark):
    df = spark.createDataFrame([], "run_id int, correct boolean, truncated boolean")
    assert metrics.eval_summary(df, by=()).first()["accuracy"] is None


def test_audit_names_issues(spark):
    rows = [("<|im_start|>user\nsystem", 1901, False), ("<|im_start|>system\nx", 1900, True)]
    df = spark.createDataFrame(rows, "prompt string, input_tokens int, correct boolean")
    assert df.select(metrics.sample_issues()).first()[0] == ["no_system_prompt", "input_near_limit", "answer_mismatch"]
    assert rows_of(metrics.audit_samples(df)) == [("answer_mismatch", 1), ("input_near_limit", 1), ("no_system_prompt", 1)]


def test_resources(spark):
    rows = [("G2_B2",), ("G4_B6",), ("G0_B4",), ("bad",), ("G3_B99999999999",)]
    df = spark.createDataFrame(rows, "config string")
    assert rows_of(resources.sweep_filter(df)) == [("G2_B2", 2, 2)]
    times = spark.createDataFrame([("a", 0, 1024.0), ("a", 5, 3072.0)], "config string, s int, used_mb double").select(
        "config", F.timestamp_seconds("s").alias("ts"), "used_mb"
    )
    assert rows_of(resources.resource_summary(times)) == [("a", 3.0, 2.0, 2, 5.0)]
    row = spark.range(1).select(
        resources.estimate_full_time(F.lit(120.0), F.lit(4), F.lit(4), F.lit(20)).alias("m"),
        resources.estimate_full_time(F.lit(120.0), F.lit(4), F.lit(4), F.lit(0)).alias("none"),
        resources.run_status(F.lit(0), F.lit(3.0), F.lit(0)).alias("a"),
        resources.run_status(F.lit(2), F.lit(9.0), F.lit(1)).alias("b"),
        resources.run_status(F.lit(2), F.lit(9.0), F.lit(0)).alias("c"),
        resources.run_status(F.lit(2), F.lit(9.0), F.lit(None).cast("int")).alias("d"),
    ).first()
    assert row["m"] == pytest.approx(120 * 8700 / 320 / 60) and row["none"] is None
    assert (row["a"], row["b"], row["c"], row["d"]) == ("failed_to_start", "abnormal_exit", "ok", "unfinished")


def test_losses_do_not_overflow(spark):
    row = spark.range(1).select(
        dpo_loss(F.lit(-1e6), F.lit(0.0)).alias("big"), dpo_loss(F.lit(0.0), F.lit(-1e6)).alias("small"), dpo_loss(F.lit(1.0), F.lit(1.0)).alias("even")
    ).first()
    assert row["big"] == pytest.approx(1e5) and row["small"] == pytest.approx(0.0) and row["even"] == pytest.approx(0.693147, abs=1e-6)


def test_registry(spark):
    registry = RewardRegistry()
    registry.register("short", lambda col: F.length(col("response")) < 3)
    df = spark.createDataFrame([(True, "abc"), (True, "a"), (False, "a")], "correct boolean, response string")
    assert [r[0] for r in df.select(registry.total({"accuracy": 1, "short": 0.5})).collect()] == [1.0, 1.5, 0.5]
    with pytest.raises(KeyError, match="accuracy, short"):
        registry.column("other")


def test_generation_batches(spark):
    def loader():
        loads = {"n": 0}

        def generate(prompts, params):
            loads["n"] += 1
            assert len(prompts) <= params["batch_size"] == 4
            return [f"{p}|{params['temperature']}" for p in prompts], [1] * len(prompts), [len(p) for p in prompts]

        return generate

    df = spark.range(103).select("id", F.concat(F.lit("p"), F.col("id")).alias("prompt"))
    rows = generate_responses(df, loader, GenerationParams(batch_size=4)).collect()
    assert len(rows) == 103 and all(r["response"] == f"p{r['id']}|0.0" and r["output_tokens"] == len(r["prompt"]) for r in rows)


def test_python_rewards_run_in_one_stage(spark):
    import pyarrow.compute as pc

    registry = RewardRegistry()
    registry.register_python("short", lambda n: pc.divide(1.0, n), ["output_tokens"])
    registry.register_python("known", lambda text, n: [0.5 if t is not None else None for t in text.to_pylist()], ["text", "output_tokens"])
    registry.register_python("wrong_length", lambda text: [1.0], ["text"])
    df = spark.createDataFrame([(True, 2, "a"), (False, 4, "b"), (True, 1, None)], "correct boolean, output_tokens int, text string").coalesce(1)
    scored = df.select("output_tokens", registry.total({"accuracy": 1.0, "short": 2.0, "known": 1.0}).alias("r"), registry.column("short").alias("s"))
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r["output_tokens"]: r["r"] for r in scored.collect()} == {2: 2.5, 4: 1.0, 1: None}
    with pytest.raises(Exception, match="1 values for 3 rows"):
        df.select(registry.column("wrong_length")).collect()


def test_templates_from_a_table(spark):
    questions = spark.createDataFrame([(1, "q", "kept")], "sample_idx int, question string, extra string")
    table = spark.createDataFrame([("a", "<", ">"), ("b", None, "!"), (None, "", None)], "config string, prefix string, suffix string")
    rows = samples.expand_configs(questions, table).collect()
    assert {(r["config"], r["prompt"], r["extra"]) for r in rows} == {("a", "<q>", "kept"), ("b", "q!", "kept"), (None, "q", "kept")}
    assert samples.expand_configs(questions, table.limit(0)).count() == 0
    assert samples.expand_configs(questions, table, max_templates=3).count() == 3
    with pytest.raises(ValueError, match="more than 2"):
        samples.expand_configs(questions, table, max_templates=2)
