"""Evaluation reports over graded rows.

Every report is a ``groupBy`` with map-side combine on counters, so a run, format or sample that
holds a large share of the rows is reduced before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.answers import GOLD_FORMS, gold_form, pattern_matches
from gradeloom.functions.grading import LONG_INPUT_TOKENS, flag_long_input
from gradeloom.functions.patterns import ANSWER_PROFILES, NO_ANSWER
from gradeloom.functions.prompts import SYSTEM_MARKER
from gradeloom.functions.text import preview_text
from gradeloom.operators.prefix import running_totals
from gradeloom.operators.skew import HOT_ROWS, with_group_values


def _count_if(condition: Column) -> Column:
    return F.count_if(condition)


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def _grouped(df: DataFrame, by: Sequence[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggregates)


def eval_summary(graded: DataFrame, by: Sequence[str] = ("run_id",), run_log: DataFrame | None = None,
                 seconds: str = "elapsed_s") -> DataFrame:
    """Totals, accuracy in percent and truncation per run; with a run log, total and mean seconds.

    Graded rows that carry their own ``seconds`` need no log. An empty input grouped by nothing gives NULL accuracy instead of a
    division error.
    """
    timed = run_log is None and seconds in graded.columns
    summary = _grouped(
        graded,
        by,
        *([F.sum(seconds).alias("inference_time_seconds")] if timed else []),
        F.count(F.lit(1)).alias("total_samples"),
        _count_if(F.col("correct")).alias("correct_count"),
        _count_if(F.col("truncated")).alias("truncated_count"),
    ).select(
        *by,
        "total_samples",
        "correct_count",
        (F.col("total_samples") - F.col("correct_count")).alias("incorrect_count"),
        _percent(F.col("correct_count"), F.col("total_samples")).alias("accuracy"),
        "truncated_count",
        *(["inference_time_seconds", F.try_divide("inference_time_seconds", "total_samples").alias("avg_time_per_sample")] if timed else []),
    )
    if run_log is None:
        return summary
    times = _grouped(run_log, by, F.sum(seconds).alias("inference_time_seconds"))
    return summary.join(times, list(by), "left").withColumn(
        "avg_time_per_sample", F.try_divide("inference_time_seconds", "total_samples")
    )


def accuracy_by_config(graded: DataFrame, config: str = "config") -> DataFrame:
    """Correct count, total and accuracy in percent of each prompt format."""
    return _grouped(
        graded,
        [config],
        _count_if(F.col("correct")).alias("correct_count"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("accuracy", _percent(F.col("correct_count"), F.col("total")))


def truncation_report(graded: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Truncated rows per run, their share, and whether a larger token budget is advised."""
    return _grouped(
        graded, by, F.count(F.lit(1)).alias("total_samples"), _count_if(F.col("truncated")).alias("truncated_count")
    ).withColumns(
        {
            "truncated_pct": _percent(F.col("truncated_count"), F.col("total_samples")),
            "raise_token_budget": F.col("truncated_count") > 0,
        }
    )


def incorrect_samples(graded: DataFrame) -> DataFrame:
    """Rows to review: graded wrong or cut off."""
    return graded.where(~F.col("correct") | F.col("truncated"))


def pattern_coverage(df: DataFrame, text: str = "response", profile: str = "full8") -> DataFrame:
    """How often each pattern of a profile matches, and how often it is the first to match.

    One pass over the texts into one row of counters; only that row is turned into one row per pattern.
    """
    names = ANSWER_PROFILES[profile]
    hits = df.select(F.array(*[pattern_matches(F.col(text), name) for name in names]).alias("hit"))
    first = F.array_position(F.col("hit"), F.lit(True))
    counters = [F.count(F.lit(1)).alias("total")]
    for i, _ in enumerate(names):
        counters += [_count_if(F.col("hit")[i]).alias(f"m{i}"), _count_if(F.col("first") == i + 1).alias(f"f{i}")]
    totals = hits.withColumn("first", first).agg(*counters)
    per_pattern = F.array(
        *[
            F.struct(
                F.lit(name).alias("pattern"),
                F.col(f"m{i}").alias("matched"),
                F.col(f"f{i}").alias("first_hit"),
                F.col("total"),
            )
            for i, name in enumerate(names)
        ]
    )
    return totals.select(F.inline(per_pattern)).select(
        "pattern",
        "matched",
        "first_hit",
        _percent(F.col("matched"), F.col("total")).alias("matched_pct"),
        _percent(F.col("first_hit"), F.col("total")).alias("first_hit_pct"),
    )


def sample_issues(threshold: int = LONG_INPUT_TOKENS) -> Column:
    """Names of the issues of one graded row with ``prompt``, ``input_tokens`` and ``correct``."""
    return F.array_compact(
        F.array(
            F.when(~F.contains(F.col("prompt"), F.lit(SYSTEM_MARKER)), F.lit("no_system_prompt")),
            F.when(flag_long_input(F.col("input_tokens"), threshold), F.lit("input_near_limit")),
            F.when(~F.col("correct"), F.lit("answer_mismatch")),
        )
    )


def audit_samples(graded: DataFrame, threshold: int = LONG_INPUT_TOKENS) -> DataFrame:
    """Rows per issue, for the issues that occur."""
    issues = graded.select(F.explode(sample_issues(threshold)).alias("issue"))
    return issues.groupBy("issue").agg(F.count(F.lit(1)).alias("n_rows"))


def audit_rows(graded: DataFrame, key: Sequence[str] = ("run_id", "config", "gen", "sample_idx"), profile: str = "full") -> DataFrame:
    """Rows per data issue of graded rows, for the issues that occur: empty fields, no gold row, no answer found, repeated keys.

    ``duplicate_key`` counts the rows beyond the first of each key, a NULL in it being a value like any other.
    """

    def empty(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("")) == ""

    per_row = F.array_compact(
        F.array(
            F.when(empty("question"), F.lit("empty_question")),
            F.when(empty("response"), F.lit("empty_response")),
            F.when(F.col("ground_truth_raw").isNull(), F.lit("no_gold")),
            F.when(F.col("ground_truth_raw") == "", F.lit("empty_gold")),
            F.when(F.col("predicted") == NO_ANSWER[profile], F.lit("no_answer")),
        )
    )
    issues = graded.select(F.explode(per_row).alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n_rows"))
    copies = graded.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("more")).agg(F.sum("more").alias("n_rows"))
    return issues.unionByName(copies.where("n_rows > 0").select(F.lit("duplicate_key").alias("issue"), "n_rows"))


def dataset_profile(df: DataFrame, by: str = "split", texts: Sequence[str] = ("question", "answer"),
                    gold: str = "answer") -> DataFrame:
    """Row count and column names of each split, lengths of its texts in characters, percent of rows per form of gold answer."""
    names = [c for c in df.columns if c != by]
    counters = [F.count(F.lit(1)).alias("n_rows")]
    for c in texts:
        counters += [f(F.char_length(c).cast("long")).alias(f"{c}_{name}_chars") for name, f in (("min", F.min), ("avg", F.avg), ("max", F.max))]
    counters += [F.count_if(F.col("_form") == form).alias(f"_{form}") for form in GOLD_FORMS]
    lengths = [f"{c}_{name}_chars" for c in texts for name in ("min", "avg", "max")]
    return df.withColumn("_form", gold_form(F.col(gold))).groupBy(by).agg(*counters).select(
        by,
        "n_rows",
        F.lit(",".join(names)).alias("columns"),
        *lengths,
        *[_percent(F.col(f"_{form}"), F.col("n_rows")).alias(f"gold_{form}_pct") for form in GOLD_FORMS],
    )


def peak_memory(readings: DataFrame, by: Sequence[str] = ("run_id",), total_gb: str = "total_gb") -> DataFrame:
    """Peak allocated and reserved memory per run, and reserved memory in percent of the device."""
    return _grouped(
        readings,
        by,
        F.max("allocated_gb").alias("peak_allocated_gb"),
        F.max("reserved_gb").alias("peak_reserved_gb"),
        F.max(total_gb).alias("_total"),
    ).select(
        *by,
        "peak_allocated_gb",
        "peak_reserved_gb",
        _percent(F.col("peak_reserved_gb"), F.col("_total")).alias("utilisation_pct"),
    )


def compare_side_by_side(graded: DataFrame, configs: Sequence[str], key: str = "sample_idx", chars: int = 200) -> DataFrame:
    """One row per sample: question, gold answer, then prediction, verdict, shortened response and tokens of each prompt format.

    Conditional aggregates over the given formats: one exchange, with map-side combine. Of several
    generations under one format the first counts. Responses are shortened before they are aggregated.
    """
    details = ("predicted", "correct", "response", "output_tokens")
    result = F.struct("predicted", "correct", preview_text(F.col("response"), chars).alias("response"), "output_tokens")
    aggregates = [F.max("question").alias("question"), F.max("ground_truth").alias("ground_truth")]
    for c in configs:
        chosen = F.col("config") == c
        aggregates.append(F.min_by(F.when(chosen, result), F.when(chosen, F.col("gen"))).alias(f"_{c}"))
    columns = []
    for c in configs:
        columns += [F.col(f"_{c}")[detail].alias(f"{c}_{detail}") for detail in details]
    return graded.groupBy(key).agg(*aggregates).select(key, "question", "ground_truth", *columns)


def compare_runs(graded: DataFrame, run_a, run_b, run: str = "run_id",
                 key: Sequence[str] = ("sample_idx", "config", "gen")) -> DataFrame:
    """Two runs on the generations both hold: accuracies, lift in points, and paired outcome counts.

    Each key is folded into one verdict per run, which replaces the self-join. With a key that leaves out ``gen`` or ``config`` a sample
    counts as right when any of its rows is. Rows with a NULL in the key pair like any other.
    """

    def verdict(run_value) -> Column:
        return F.max(F.when(F.col(run) == F.lit(run_value), F.col("correct").cast("int")))

    paired = (
        graded.where(F.col(run).isin(run_a, run_b))
        .groupBy(*key)
        .agg(verdict(run_a).alias("a"), verdict(run_b).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
    )
    a, b = F.col("a") == 1, F.col("b") == 1
    return paired.agg(
        F.count(F.lit(1)).alias("n_samples"),
        _count_if(a).alias("correct_a"),
        _count_if(b).alias("correct_b"),
        _count_if(~a & b).alias("fixed"),
        _count_if(a & ~b).alias("broken"),
        _count_if(a & b).alias("both"),
        _count_if(~a & ~b).alias("neither"),
    ).withColumns(
        {
            "accuracy_a": _percent(F.col("correct_a"), F.col("n_samples")),
            "accuracy_b": _percent(F.col("correct_b"), F.col("n_samples")),
            "lift": _percent(F.col("correct_b") - F.col("correct_a"), F.col("n_samples")),
        }
    )


def _running(graded: DataFrame, by: list[str], position: str) -> DataFrame:
    counters = graded.groupBy(*by, position).agg(
        F.count(F.lit(1)).alias("seen"), F.sum(F.col("correct").cast("long")).alias("right")
    )
    return running_totals(counters, by, position, ["seen", "right"])


def running_accuracy(graded: DataFrame, by: Sequence[str] = ("run_id",), index: str = "sample_idx") -> DataFrame:
    """Accuracy in percent after each sample, in dataset order, one row per run and sample.

    The counters per sample are stored in rank order when this is called, because the running totals read them more than
    once and the graded rows behind them may be costly.
    """
    by = list(by)
    return _running(graded, by, index).select(
        *by,
        index,
        F.col("cum_seen").alias("seen"),
        F.col("cum_right").alias("correct_so_far"),
        _percent(F.col("cum_right"), F.col("cum_seen")).alias("accuracy"),
    )


def running_accuracy_lagged(graded: DataFrame, by: Sequence[str] = ("run_id",), batch: str = "batch_id") -> DataFrame:
    """The progress value shown before a batch is graded: right answers so far over rows up to the batch end."""
    by = list(by)
    so_far = F.col("cum_right") - F.col("right")
    return _running(graded, by, batch).select(
        *by,
        batch,
        F.col("cum_seen").alias("batch_end"),
        so_far.alias("correct_so_far"),
        _percent(so_far, F.col("cum_seen")).alias("accuracy"),
    )


def batch_token_stats(df: DataFrame, by: Sequence[str] = ("run_id", "batch_id")) -> DataFrame:
    """Padded input and output length of each batch and the share of padding in both, in percent."""
    n = F.col("n_rows")
    return _grouped(
        df,
        by,
        F.count(F.lit(1)).alias("n_rows"),
        F.max("input_tokens").alias("padded_input"),
        F.max("output_tokens").alias("padded_output"),
        F.sum(F.col("input_tokens").cast("long")).alias("_in"),
        F.sum(F.col("output_tokens").cast("long")).alias("_out"),
    ).select(
        *by,
        "n_rows",
        "padded_input",
        "padded_output",
        (n * F.col("padded_input") - F.col("_in")).alias("input_padding"),
        (n * F.col("padded_output") - F.col("_out")).alias("output_padding"),
        (F.lit(100.0) - _percent(F.col("_in") + F.col("_out"), n * (F.col("padded_input") + F.col("padded_output")))).alias(
            "padding_pct"
        ),
    )


def with_batch_padded_tokens(df: DataFrame, by: Sequence[str] = ("run_id", "batch_id"), *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Token counts replaced by those of the padded batch a row was generated in.

    In padded batch generation every row is as long as the longest of its batch, so one long reply
    marks its whole batch as truncated.
    """
    padded = with_group_values(
        df, by, {"_padded_in": F.max("input_tokens"), "_padded_out": F.max("output_tokens")}, hot_rows=hot_rows
    )
    return padded.withColumns({"input_tokens": F.col("_padded_in"), "output_tokens": F.col("_padded_out")}).select(
        *df.columns
    )
