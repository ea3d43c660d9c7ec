"""The evaluation flow: extract, join, grade."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.answers import extract_answer, extract_gold
from gradeloom.functions.grading import flag_truncated, grade_answer
from gradeloom.functions.rewards import reward_accuracy
from gradeloom.operators.inference import Generate, GenerationParams, generate_responses
from gradeloom.operators.metrics import eval_summary
from gradeloom.operators.samples import expand_configs, join_gold
from gradeloom.sources.workdir import stored
from gradeloom.sources.writers import metrics_record, write_eval_results


def grade_responses(responses: DataFrame, qa: DataFrame, *, max_new_tokens: int, answer_profile: str = "full",
                    gold_profile: str = "basic", grade_profile: str = "exact") -> DataFrame:
    """Graded rows: the responses with question, raw and extracted gold, prediction, verdict, truncation and reward.

    Extraction happens on each side below the join. A report that needs no texts therefore shuffles only
    the short extracted strings, because column pruning drops the texts before the exchange. A response without
    a gold row is graded wrong and stays in every total.
    """
    predictions = responses.withColumn("predicted", extract_answer(F.col("response"), answer_profile))
    gold = qa.select(
        "sample_idx",
        "question",
        F.col("answer").alias("ground_truth_raw"),
        extract_gold(F.col("answer"), gold_profile).alias("ground_truth"),
    )
    graded = join_gold(predictions, gold).withColumns(
        {
            "correct": F.coalesce(grade_answer(F.col("predicted"), F.col("ground_truth"), grade_profile), F.lit(False)),
            "truncated": flag_truncated(F.col("output_tokens"), max_new_tokens),
        }
    )
    return graded.withColumn("reward", reward_accuracy(F.col("correct")))


def run_evaluation(qa: DataFrame, loader: Callable[[], Generate], templates: list[str] | None = None,
                   params: GenerationParams = GenerationParams(), *, run_id: str, partitions: int | None = None,
                   **profiles: str) -> DataFrame:
    """Graded rows of every sample under every prompt template, with ``run_id`` and each row's share of the generation seconds.

    The generated rows are stored before they are grading input: generation is the expensive step, and
    no later action, retry or lost executor may repeat it. ``partitions`` is the number of tasks that generate.
    """
    prompts = expand_configs(qa.select("sample_idx", "question"), templates)
    answered = generate_responses(prompts, loader, params, partitions=partitions, timed=True)
    generated = stored(answered.withColumns({"gen": F.lit(0), "run_id": F.lit(run_id)}), "generated")
    return grade_responses(generated.drop("question"), qa, max_new_tokens=params.max_new_tokens, **profiles)


def write_run(graded: DataFrame, root: str, run_id: str, params: GenerationParams, memory: DataFrame | None = None, **settings: str) -> str:
    """Write a run into its own folder below ``root`` and return that: details, and one metrics row computed from the stored details.

    ``memory`` has ``run_id, peak_allocated_gb, peak_reserved_gb``; ``settings`` stand in the record beside the parameters.
    """
    spark = graded.sparkSession
    values = {**asdict(params), **settings}
    config = spark.range(1).select(F.lit(run_id).alias("run_id"), *[F.lit(v).alias(k) for k, v in values.items()])
    if memory is None:
        memory = spark.createDataFrame([], "run_id string, peak_allocated_gb double, peak_reserved_gb double")
    path = f"{root.rstrip('/')}/{run_id}"
    write_eval_results(graded.where(F.col("run_id") == run_id), lambda details: metrics_record(eval_summary(details), memory, config), path)
    return path
