"""Registered queries: each operator over the whole given tables.

Every function takes ``(spark, sf_dir)``. Doubles whose last bits depend on the order of summation are
rounded for comparison with the SQL twins in ``oracle.py``.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions import answers, grading, prompts, rewards, text
from gradeloom.operators import groups, indexing, inference, metrics, resources, samples, tables
from gradeloom.plans import evaluation
from gradeloom.plans.evaluation import grade_responses
from gradeloom.session import tune
from gradeloom.sources import derived, qa as qa_source, writers
from gradeloom.sources.workdir import new_path
from gradeloom.streaming import drain, live

SYSTEM_PROMPT = "You are a careful solver."
CONFIGS = list(derived.RUN_CONFIGS)
WINDOW = "1 hour"
MAX_NEW_TOKENS = 250  # the derived responses have up to 256 tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function name, run under the session settings of the package."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark, sf_dir), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def _graded(spark: SparkSession, sf_dir: str, **profiles: str) -> DataFrame:
    rows, gold = derived.responses(spark, sf_dir), derived.qa(spark, sf_dir)
    return grade_responses(rows, gold, max_new_tokens=MAX_NEW_TOKENS, **profiles)


# --- sources and sinks ---


def _qa_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = F.when(F.col("sample_idx") % 10 == 0, F.lit("test")).otherwise(F.lit("train"))
    return derived.qa(spark, sf_dir).withColumn("split", split)


def _read_both(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    def read(split: str) -> DataFrame:
        rows = qa_source.read_qa(spark, path, split, fmt, columns=("question", "answer"))
        return rows.select(F.lit(split).alias("split"), "question", "answer")

    return read("train").unionByName(read("test"))


@query
def read_qa(spark, sf_dir):
    path = new_path(spark, "qa")
    _qa_by_split(spark, sf_dir).write.partitionBy("split").parquet(path)
    return _read_both(spark, path, "parquet")


@query
def read_qa_json(spark, sf_dir):
    path = new_path(spark, "qa")
    _qa_by_split(spark, sf_dir).write.partitionBy("split").json(path)
    return _read_both(spark, path, "json")


@query
def read_qa_arrow(spark, sf_dir):
    path = new_path(spark, "qa").removeprefix("file:")
    for split in ("train", "test"):
        write_shards(_qa_by_split(spark, sf_dir).where(F.col("split") == split).select("question", "answer"), f"{path}/{split}")
    return _read_both(spark, path, "arrow")


def write_shards(df: DataFrame, folder: str) -> None:
    """Arrow stream shards as readers expect them, one per task; a retried task replaces its shard."""
    if "://" in folder:
        raise ValueError(f"Arrow shards need a mounted path, not {folder}")
    os.makedirs(folder, exist_ok=True)

    def write(batches):
        import os
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        part, sink, partial = TaskContext.get().partitionId(), None, f"{folder}/.{uuid.uuid4().hex}"
        for batch in batches:
            sink = sink or pa.ipc.new_stream(partial, batch.schema)
            sink.write_batch(batch)
        if sink is not None:
            sink.close()
            os.replace(partial, f"{folder}/data-{part:05d}.arrow")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64())})

    df.mapInArrow(write, "part bigint").write.format("noop").mode("overwrite").save()


@query
def resolve_qa_columns(spark, sf_dir):
    alt = derived.qa(spark, sf_dir).withColumnsRenamed({"question": "prompt", "answer": "completion"})
    return samples.resolve_qa_columns(alt)


@query
def write_training_jsonl(spark, sf_dir):
    path = new_path(spark, "chat")
    rows = tables.build_chat_solution(derived.qa(spark, sf_dir), system_prompt=SYSTEM_PROMPT).select("messages", "solution")
    writers.write_training_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path).select(*_flat_messages(), "solution")


@query
def write_training_jsonl_single(spark, sf_dir):
    path = new_path(spark, "chat") + ".jsonl"
    chats = tables.build_chat_solution(derived.qa(spark, sf_dir), system_prompt=SYSTEM_PROMPT)
    writers.write_training_jsonl(chats, path, columns=["messages", "solution"], single_file=True)
    return spark.read.schema(chats.select("messages", "solution").schema).json(path).select(*_flat_messages(), "solution")


@query
def write_eval_results(spark, sf_dir):
    path = new_path(spark, "results")
    graded = _graded(spark, sf_dir)
    memory = metrics.peak_memory(derived.memory_readings(spark, sf_dir))

    def record(details: DataFrame) -> DataFrame:
        settings = details.groupBy("run_id").agg(F.min("config").alias("prompt_format")).withColumn("batch_size", F.lit(32))
        return writers.metrics_record(metrics.eval_summary(details), memory, settings)

    writers.write_eval_results(graded, record, path)
    details = spark.read.parquet(f"{path}/details")
    recorded = spark.read.json(f"{path}/metrics").select("run_id", "accuracy", "memory_stats", "config.batch_size")
    return details.join(recorded, "run_id").select(
        "run_id",
        "config",
        "sample_idx",
        "gen",
        "question",
        "ground_truth_raw",
        "ground_truth",
        "predicted",
        "response",
        "correct",
        "input_tokens",
        "output_tokens",
        "truncated",
        F.round("accuracy", 6).alias("run_accuracy"),
        F.round("memory_stats.peak_reserved_gb", 6).alias("run_peak_reserved_gb"),
        F.col("batch_size").cast("int").alias("run_batch_size"),
    )


# --- projections, filters, limits ---


@query
def limit_samples(spark, sf_dir):
    return samples.limit_samples(derived.qa(spark, sf_dir), 1000)


@query
def format_prompt(spark, sf_dir):
    columns = [prompts.format_prompt(F.col("question"), name).alias(name) for name in prompts.TEMPLATES]
    return derived.qa(spark, sf_dir).select("sample_idx", *columns)


def _flat_messages() -> list[Column]:
    return [
        F.size("messages").alias("n_messages"),
        *[F.col("messages")[i][f].alias(f"{f}_{i}") for i in (0, 1) for f in ("role", "content")],
    ]


@query
def render_chat(spark, sf_dir):
    return derived.chat_turns(spark, sf_dir).select("conv_id", "turn", prompts.render_chat(F.col("messages")).alias("prompt"))


@query
def extract_system_prompt(spark, sf_dir):
    expanded = samples.expand_configs(derived.qa(spark, sf_dir))
    return expanded.select("sample_idx", "config", prompts.extract_system_prompt(F.col("prompt")).alias("system_prompt"))


@query
def preview_text(spark, sf_dir):
    previews = [text.preview_text(F.col("text"), n).alias(f"first_{n}") for n in (80, 100, 150, 200, 500, 1000)]
    return derived.documents(spark, sf_dir).select("doc_id", *previews)


@query
def sample_preview(spark, sf_dir):
    return samples.sample_preview(derived.qa(spark, sf_dir), 5, chars=20)


@query
def incorrect_samples(spark, sf_dir):
    return metrics.incorrect_samples(_graded(spark, sf_dir)).select(
        "run_id", "sample_idx", "question", "ground_truth", "predicted", "correct", "truncated"
    )


@query
def sweep_filter(spark, sf_dir):
    return resources.sweep_filter(derived.run_log(spark, sf_dir)).select(
        "run_id", "step", "config", "num_generations", "batch_size"
    )


# --- scalar functions ---


@query
def extract_answer(spark, sf_dir):
    response = F.col("response")
    return derived.responses(spark, sf_dir).select(
        "sample_idx", "gen", *[answers.extract_answer(response, p).alias(p) for p in ("full", "full8", "plain", "compare")]
    )


@query
def extract_answer_documents(spark, sf_dir):
    document = F.col("text")
    return derived.documents(spark, sf_dir).select(
        "doc_id", *[answers.extract_answer(document, p).alias(p) for p in ("full", "plain", "compare")]
    )


@query
def extract_gold(spark, sf_dir):
    return derived.qa(spark, sf_dir).select("sample_idx", answers.extract_gold(F.col("answer"), "basic").alias("gold"))


@query
def extract_gold_calc(spark, sf_dir):
    return derived.qa(spark, sf_dir).select("sample_idx", answers.extract_gold(F.col("answer"), "calc").alias("gold"))


@query
def extract_gold_compare(spark, sf_dir):
    return derived.qa(spark, sf_dir).select("sample_idx", answers.extract_gold(F.col("answer"), "compare").alias("gold"))


@query
def extract_gold_strict(spark, sf_dir):
    gold = answers.extract_gold(F.col("answer"), "strict_numeric")
    return derived.qa(spark, sf_dir).select("sample_idx", gold.alias("gold"))


@query
def grade_answer(spark, sf_dir):
    return _graded(spark, sf_dir).select("sample_idx", "gen", "predicted", "ground_truth", "correct")


@query
def grade_answer_ci(spark, sf_dir):
    return derived.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        grading.grade_answer(F.concat(F.lit(" "), F.upper("o_orderpriority")), F.col("o_orderpriority"), "nocase").alias("nocase"),
        grading.grade_answer(F.concat(F.lit(" "), F.upper("o_orderpriority")), F.col("o_orderpriority"), "exact").alias("exact"),
        grading.grade_answer(
            F.concat(F.lit(" "), (F.col("o_custkey") % 3).cast("string"), F.lit("e0 ")),
            (F.col("o_orderkey") % 3).cast("string"),
            "nocase",
        ).alias("numeric"),
    )


@query
def strip_prompt_echo(spark, sf_dir):
    prompt = prompts.format_prompt(F.col("question"), "no_system")
    decoded = F.when(F.col("gen") % 2 == 0, F.concat(prompt, F.col("response"))).otherwise(
        F.concat(F.col("question"), F.col("response"))
    )
    echoed_prompt = F.when(F.col("gen") % 2 == 0, prompt).otherwise(F.col("question"))
    return _graded(spark, sf_dir).select("sample_idx", "gen", text.strip_prompt_echo(decoded, echoed_prompt).alias("reply"))


@query
def flag_truncated(spark, sf_dir):
    rows = derived.responses(spark, sf_dir).select("run_id", "sample_idx", "input_tokens", "output_tokens")
    return rows.withColumn("truncated", grading.flag_truncated(F.col("output_tokens"), MAX_NEW_TOKENS))


@query
def flag_truncated_batch_padded(spark, sf_dir):
    rows = derived.responses(spark, sf_dir).select("run_id", "sample_idx", "input_tokens", "output_tokens")
    padded = metrics.with_batch_padded_tokens(samples.assign_batches(rows, 32))
    return padded.withColumn("truncated", grading.flag_truncated(F.col("output_tokens"), MAX_NEW_TOKENS))


@query
def flag_long_input(spark, sf_dir):
    rows = derived.responses(spark, sf_dir).select("run_id", "sample_idx", "input_tokens")
    return rows.withColumn("long_input", grading.flag_long_input(F.col("input_tokens")))


@query
def build_messages(spark, sf_dir):
    messages = prompts.build_messages(F.col("question"), SYSTEM_PROMPT)
    return derived.qa(spark, sf_dir).select("sample_idx", messages.alias("messages")).select("sample_idx", *_flat_messages())


@query
def reward_accuracy(spark, sf_dir):
    return _graded(spark, sf_dir).select("sample_idx", "gen", "reward")


@query
def reward_registry(spark, sf_dir):
    registry = rewards.RewardRegistry()
    registry.register("finished", lambda col: ~col("truncated"))
    graded = _graded(spark, sf_dir)
    return graded.select(
        "sample_idx", "gen", F.round(registry.total({"accuracy": 1.0, "finished": 0.25}), 6).alias("reward")
    )


@query
def reward_registry_python(spark, sf_dir):
    def brevity(tokens):
        """Full marks for one token, less for every further one."""
        import pyarrow.compute as pc

        return pc.divide(1.0, tokens)

    def shown_steps(replies):
        """Lines before the last one."""
        return [float(reply.count("\n")) for reply in replies.to_pylist()]

    registry = rewards.RewardRegistry()
    registry.register_python("brevity", brevity, ["output_tokens"])
    registry.register_python("shown_steps", shown_steps, ["response"])
    graded = _graded(spark, sf_dir)
    weights = {"accuracy": 1.0, "brevity": 0.5, "shown_steps": 0.25}
    return graded.select("sample_idx", "gen", F.round(registry.total(weights), 6).alias("reward"))


@query
def sft_nll(spark, sf_dir):
    rows = derived.logps(spark, sf_dir).select("run_id", rewards.sft_nll(F.col("logp_chosen")).alias("loss"))
    return rows.groupBy("run_id").agg(F.round(F.avg("loss"), 6).alias("loss"))


@query
def dpo_loss(spark, sf_dir):
    return _preference_losses(spark, sf_dir, F.col("logp_chosen"), F.col("logp_rejected"))


@query
def dpo_loss_reference(spark, sf_dir):
    return _preference_losses(spark, sf_dir, *map(F.col, ("logp_chosen", "logp_rejected", "ref_chosen", "ref_rejected")))


def _preference_losses(spark: SparkSession, sf_dir: str, chosen: Column, rejected: Column, *reference: Column) -> DataFrame:
    loss = rewards.dpo_loss(chosen, rejected, rewards.DEFAULT_BETA, *reference)
    margin = rewards.dpo_margin(chosen, rejected, *reference)
    return derived.logps(spark, sf_dir).groupBy("run_id").agg(
        F.round(F.avg(loss), 6).alias("loss"), F.round(rewards.preference_accuracy(margin), 6).alias("preference_accuracy")
    )


# --- joins ---


@query
def expand_configs(spark, sf_dir):
    return samples.expand_configs(derived.qa(spark, sf_dir).select("sample_idx", "question"), CONFIGS).select(
        "sample_idx", "config", "prompt"
    )


@query
def expand_configs_table(spark, sf_dir):
    regions = derived.table(spark, sf_dir, "region")
    templates = regions.select(
        F.col("r_name").alias("config"),
        F.concat(F.lit("Region "), F.col("r_regionkey").cast("string"), F.lit(": ")).alias("prefix"),
        F.when(F.col("r_regionkey") > 0, F.concat(F.lit("\n"), F.col("r_name"))).alias("suffix"),
    )
    questions = derived.qa(spark, sf_dir).select("sample_idx", "question")
    return samples.expand_configs(questions, templates).select("sample_idx", "config", "prompt")


@query
def join_gold(spark, sf_dir):
    return samples.join_gold(derived.responses(spark, sf_dir), derived.qa(spark, sf_dir)).select(
        "sample_idx", "gen", "question", "answer", "response"
    )


@query
def compare_side_by_side(spark, sf_dir):
    return metrics.compare_side_by_side(_graded(spark, sf_dir), CONFIGS)


@query
def compare_runs(spark, sf_dir):
    # Two runs over all generations: even ones before, odd ones after, two samples per question.
    sample = (F.col("sample_idx") * 2 + F.floor(F.col("gen") / 2)).alias("sample_idx")
    runs = _graded(spark, sf_dir).select(sample, (F.col("gen") % 2).alias("run_id"), "correct")
    compared = metrics.compare_runs(runs, 0, 1, key=("sample_idx",))
    counts = ["n_samples", "correct_a", "correct_b", "fixed", "broken", "both", "neither"]
    return compared.select(*counts, _r6("accuracy_a"), _r6("accuracy_b"), _r6("lift"))


# --- aggregations ---


@query
def eval_summary(spark, sf_dir):
    log = derived.run_log(spark, sf_dir).select((F.col("step") % derived.GENERATIONS).cast("int").alias("run_id"), "elapsed_s")
    summary = metrics.eval_summary(_graded(spark, sf_dir), run_log=log)
    return summary.select(
        "run_id",
        "total_samples",
        "correct_count",
        "incorrect_count",
        "truncated_count",
        _r6("accuracy"),
        F.round("inference_time_seconds", 3).alias("inference_time_seconds"),
        _r6("avg_time_per_sample"),
    )


@query
def accuracy_by_config(spark, sf_dir):
    report = metrics.accuracy_by_config(_graded(spark, sf_dir))
    return report.select("config", "correct_count", "total", _r6("accuracy")).orderBy(F.desc("accuracy"), "config")


@query
def pattern_coverage(spark, sf_dir):
    report = metrics.pattern_coverage(derived.responses(spark, sf_dir))
    return report.select("pattern", "matched", "first_hit", _r6("matched_pct"), _r6("first_hit_pct"))


@query
def pattern_coverage_documents(spark, sf_dir):
    report = metrics.pattern_coverage(derived.documents(spark, sf_dir), "text", "full")
    return report.select("pattern", "matched", "first_hit", _r6("matched_pct"), _r6("first_hit_pct"))


@query
def truncation_report(spark, sf_dir):
    rows = derived.responses(spark, sf_dir).withColumn("truncated", grading.flag_truncated(F.col("output_tokens"), MAX_NEW_TOKENS))
    report = metrics.truncation_report(rows)
    return report.select("run_id", "total_samples", "truncated_count", _r6("truncated_pct"), "raise_token_budget")


@query
def audit_samples(spark, sf_dir):
    graded = _graded(spark, sf_dir)
    template = F.when(F.col("config") == "no_system", prompts.format_prompt(F.col("question"), "no_system"))
    for name in CONFIGS[1:]:
        template = template.when(F.col("config") == name, prompts.format_prompt(F.col("question"), name))
    return metrics.audit_samples(graded.withColumn("prompt", template))


def _flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded rows with every data issue: no gold for some samples, empty texts, NULL runs, rows delivered twice."""
    rows = derived.responses(spark, sf_dir)
    response = F.when(F.col("sample_idx") % 11 == 0, F.lit("")).otherwise(F.col("response"))
    run = F.when(F.col("sample_idx") % 7 != 0, F.col("gen") % 2)
    rows = rows.withColumn("response", response).withColumn("run_id", run)
    rows = rows.unionByName(rows.where("sample_idx % 13 = 0"))
    gold = derived.qa(spark, sf_dir).where("sample_idx % 17 <> 0")
    gold = gold.withColumn("answer", F.when(F.col("sample_idx") % 19 == 0, F.lit("")).otherwise(F.col("answer")))
    return grade_responses(rows, gold, max_new_tokens=MAX_NEW_TOKENS)


@query
def audit_rows(spark, sf_dir):
    return metrics.audit_rows(_flawed(spark, sf_dir), ("run_id", "gen", "sample_idx"))


@query
def running_accuracy_flawed(spark, sf_dir):
    return metrics.running_accuracy(_flawed(spark, sf_dir)).select("run_id", "sample_idx", "seen", "correct_so_far", _r6("accuracy"))


@query
def dataset_profile(spark, sf_dir):
    profile = metrics.dataset_profile(_qa_by_split(spark, sf_dir))
    rounded = [_r6(c) if c.endswith(("_avg_chars", "_pct")) else F.col(c) for c in profile.columns]
    return profile.select(*rounded)


@query
def resource_summary(spark, sf_dir):
    report = resources.resource_summary(derived.memory_samples(spark, sf_dir))
    return report.select("config", _r6("max_gb"), _r6("avg_gb"), "n_samples", F.round("duration_s", 3).alias("duration_s"))


@query
def estimate_full_time(spark, sf_dir):
    runs = resources.sweep_numbers(derived.run_log(spark, sf_dir))
    minutes = resources.estimate_full_time(
        F.col("elapsed_s"), F.col("num_generations"), F.col("batch_size"), F.col("exit_code")
    )
    return runs.select("step", minutes.alias("full_minutes"))


@query
def run_status(spark, sf_dir):
    status = resources.run_status(F.col("n_samples"), F.col("elapsed_s"), F.col("exit_code"))
    return derived.run_log(spark, sf_dir).select("run_id", "step", status.alias("status"))


@query
def peak_memory(spark, sf_dir):
    report = metrics.peak_memory(derived.memory_readings(spark, sf_dir))
    return report.select("run_id", _r6("peak_allocated_gb"), _r6("peak_reserved_gb"), _r6("utilisation_pct"))


# --- running and group-relative values ---


@query
def running_accuracy(spark, sf_dir):
    return metrics.running_accuracy(_graded(spark, sf_dir)).select(
        "run_id", "sample_idx", "seen", "correct_so_far", _r6("accuracy")
    )


@query
def running_accuracy_lagged(spark, sf_dir):
    batched = samples.assign_batches(_graded(spark, sf_dir), 8)
    return metrics.running_accuracy_lagged(batched).select("run_id", "batch_id", "batch_end", "correct_so_far", _r6("accuracy"))


@query
def assign_batches(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    indexed = indexing.index_by_storage(orders, "_file", "_row")
    return samples.assign_batches(indexed, 32).select("o_orderkey", "sample_idx", "batch_id", "batch_pos")


@query
def assign_batches_by_key(spark, sf_dir):
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line")]
    documents = derived.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", *place)
    indexed = indexing.index_by_order(documents, ["lang", "source", "doc_id"], key=["file", "line"])
    return samples.assign_batches(indexed, 32).select("doc_id", "sample_idx", "batch_id", "batch_pos")


@query
def batch_token_stats(spark, sf_dir):
    rows = derived.responses(spark, sf_dir).select("run_id", "sample_idx", "input_tokens", "output_tokens")
    report = metrics.batch_token_stats(samples.assign_batches(rows, 32))
    return report.select(*[c for c in report.columns if c != "padding_pct"], _r6("padding_pct"))


@query
def group_advantage(spark, sf_dir):
    rewarded = _graded(spark, sf_dir).select("sample_idx", "gen", "reward")
    return groups.group_advantage(rewarded, keys_from=derived.responses(spark, sf_dir)).select("sample_idx", "gen", "reward", _r6("group_mean"), _r6("advantage"))


@query
def group_stats(spark, sf_dir):
    stats = groups.group_stats(_graded(spark, sf_dir).select("sample_idx", "reward"))
    return stats.select("sample_idx", "group_size", _r6("mean_reward"), "best_reward", "worst_reward", "any_correct", "zero_spread")


@query
def best_worst(spark, sf_dir):
    return groups.best_worst(_graded(spark, sf_dir).select("sample_idx", "gen", "reward", "response"))


# --- training tables ---


@query
def build_chat_solution(spark, sf_dir):
    rows = tables.build_chat_solution(derived.qa(spark, sf_dir), system_prompt=SYSTEM_PROMPT)
    return rows.select("sample_idx", *_flat_messages(), "solution")


@query
def build_sft_pairs(spark, sf_dir):
    return tables.build_sft_pairs(derived.qa(spark, sf_dir))


@query
def build_preference_pairs(spark, sf_dir):
    rewarded = _graded(spark, sf_dir).select("sample_idx", "gen", "reward", "response")
    return tables.build_preference_pairs(rewarded, derived.qa(spark, sf_dir))


@query
def build_reward_rows(spark, sf_dir):
    return tables.build_reward_rows(_graded(spark, sf_dir))


# --- pluggable inference ---


@query
def generate_responses(spark, sf_dir):
    expanded = samples.expand_configs(derived.qa(spark, sf_dir).select("sample_idx", "question"), CONFIGS)

    def load():
        """A stand-in model whose reply states the prompt's length."""

        def generate(batch, params):
            replies = [f"Answer: {len(p)}" for p in batch]
            return replies, [len(p) for p in batch], [min(len(r), params["max_new_tokens"]) for r in replies]

        return generate

    return inference.generate_responses(expanded.select("sample_idx", "config", "prompt"), load)


@query
def run_evaluation(spark, sf_dir):
    def load():
        """A stand-in model that adds the two numbers of the question, one token per character."""

        import re

        def generate(batch, params):
            terms = [re.search(r"what is (\d+) plus (\d+)", p).groups() for p in batch]
            replies = [f"The answer: {int(a) + int(b)}" for a, b in terms]
            return replies, [len(p) for p in batch], [min(len(r), params["max_new_tokens"]) for r in replies]

        return generate

    params = inference.GenerationParams(max_new_tokens=14)
    graded = evaluation.run_evaluation(derived.qa(spark, sf_dir), load, CONFIGS, params, run_id="tiny")
    summary = metrics.eval_summary(graded, by=("config",))
    counts = ["total_samples", "correct_count", "incorrect_count", "truncated_count"]
    return summary.select("config", *counts, _r6("accuracy"))


# --- streaming ---


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = derived.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_running_accuracy(spark, sf_dir):
    def graded_events():
        return _event_stream(spark, sf_dir).select(
            (F.col("user_id") % 5).alias("run_id"),
            F.col("event_type").alias("config"),
            F.col("event_id").alias("sample_idx"),
            (F.col("value") > 10).alias("correct"),
            F.col("ts").cast("timestamp").alias("ts"),
        )

    delivered_twice = graded_events().unionByName(graded_events())
    accuracy = live.stream_running_accuracy(delivered_twice, key=("run_id", "config", "sample_idx"), delay="10 minutes")
    return drain.drain_to_table(accuracy, ["run_id"]).rows().select("run_id", "seen", "correct_so_far", _r6("accuracy"))


@query
def stream_resource_windows(spark, sf_dir):
    live_samples = _event_stream(spark, sf_dir).select(
        F.when(F.col("user_id") % 2 == 0, F.lit("G2_B2")).otherwise(F.lit("G4_B4")).alias("config"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") * 1024 / 64).alias("used_mb"),
    )
    windows = drain.drain_to_table(live.stream_resource_windows(live_samples, WINDOW), ["window_start", "config"]).rows()
    return windows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "config",
        "max_gb",
        F.round("avg_gb", 12).alias("avg_gb"),
        "n_samples",
    )


@query
def stream_peak_memory(spark, sf_dir):
    readings = _event_stream(spark, sf_dir).select(
        (F.col("user_id") % 7).alias("run_id"),
        (F.col("value") / 64).alias("allocated_gb"),
        (F.col("value") / 32).alias("reserved_gb"),
    )
    peaks = drain.drain_to_table(live.stream_peak_memory(readings), ["run_id"]).rows()
    return peaks.select("run_id", _r6("peak_allocated_gb"), _r6("peak_reserved_gb"))
