"""Training tables in the four documented row shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.answers import extract_gold
from gradeloom.functions.prompts import build_messages
from gradeloom.operators.groups import best_worst
from gradeloom.operators.samples import limit_samples, resolve_qa_columns


def build_chat_solution(qa: DataFrame, n: int = -1, system_prompt: str | None = None) -> DataFrame:
    """``{messages, solution}`` rows, keyed by ``sample_idx``: one narrow stage over the QA table."""
    rows = resolve_qa_columns(limit_samples(qa, n))
    return rows.select(
        "sample_idx",
        build_messages(F.col("question"), system_prompt).alias("messages"),
        extract_gold(F.col("answer"), "basic").alias("solution"),
    )


def build_sft_pairs(qa: DataFrame) -> DataFrame:
    """``{prompt, response}`` rows with the whole reasoning kept."""
    return resolve_qa_columns(qa).select(
        "sample_idx", F.col("question").alias("prompt"), F.col("answer").alias("response")
    )


def build_preference_pairs(generations: DataFrame, qa: DataFrame, drop_ties: bool = True) -> DataFrame:
    """``{prompt, chosen, rejected}`` rows from rewarded generations.

    Groups whose rewards are all equal, and groups of one, state no preference and are left out unless
    ``drop_ties`` is off.
    """
    ends = best_worst(generations)
    if drop_ties:
        ends = ends.where(F.col("best_reward") > F.col("worst_reward"))
    return ends.join(resolve_qa_columns(qa).select("sample_idx", "question"), "sample_idx").select(
        "sample_idx",
        F.col("question").alias("prompt"),
        F.col("best_response").alias("chosen"),
        F.col("worst_response").alias("rejected"),
    )


def build_reward_rows(graded: DataFrame) -> DataFrame:
    """``{prompt, response, reward}`` rows, one per generation."""
    return graded.select("sample_idx", "gen", F.col("question").alias("prompt"), "response", "reward")
