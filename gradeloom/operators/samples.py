"""Samples: column aliases, limits, previews, prompt expansion, batches and the gold join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.prompts import literal_templates, template_array
from gradeloom.functions.text import preview_text

# Accepted column names, the preferred one first.
QUESTION_COLUMNS = ("question", "prompt")
ANSWER_COLUMNS = ("answer", "completion")


def _resolve(df: DataFrame, names: Sequence[str]) -> Column:
    present = [name for name in names if name in df.columns]
    return F.coalesce(F.col(present[0]).cast("string"), F.lit("")) if present else F.lit("")


def resolve_qa_columns(df: DataFrame) -> DataFrame:
    """Canonical ``question`` and ``answer`` columns; other columns stay.

    The choice is by presence of the column, so a NULL ``question`` turns into an empty text and does
    not fall through to ``prompt``.
    """
    keep = [c for c in df.columns if c not in QUESTION_COLUMNS + ANSWER_COLUMNS]
    return df.select(
        *keep, _resolve(df, QUESTION_COLUMNS).alias("question"), _resolve(df, ANSWER_COLUMNS).alias("answer")
    )


def limit_samples(df: DataFrame, n: int, index: str | None = "sample_idx", order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` samples in dataset order; ``n <= 0`` keeps all.

    On a dense index this is a filter that reaches the scan. Without one (``index=None``) the rows are
    taken in the order of ``order_by``.
    """
    if n <= 0:
        return df
    if index is not None:
        return df.where(F.col(index) < n)
    if not order_by:
        raise ValueError("limit_samples needs an index column or order_by")
    return df.orderBy(*order_by).limit(n)


def sample_preview(df: DataFrame, k: int = 3, columns: Sequence[str] = ("question", "answer"), chars: int = 100,
                   index: str = "sample_idx") -> DataFrame:
    """The first ``k`` samples with shortened texts."""
    previews = [preview_text(F.col(c), chars).alias(c) for c in columns]
    return df.orderBy(index).limit(k).select(index, *previews)


def expand_configs(samples: DataFrame, templates: list[str] | DataFrame | None = None, *, max_templates: int = 1000) -> DataFrame:
    """Every sample under every prompt template, with the rendered prompt: a generator, not a join.

    ``templates`` names built-in ones or is a table of ``config, prefix, suffix`` of at most ``max_templates`` rows; a NULL
    prefix or suffix is empty. A table is read when this is called, and one with more rows is an error.
    """
    if isinstance(templates, DataFrame):
        rows = templates.select("config", "prefix", "suffix").limit(max_templates + 1).collect()
        if len(rows) > max_templates:
            raise ValueError(f"the table has more than {max_templates} templates")
        array = literal_templates([(r["config"], r["prefix"] or "", r["suffix"] or "") for r in rows])
    else:
        array = template_array(templates)
    others = [c for c in samples.columns if c not in ("config", "prompt")]
    return samples.select(*others, F.inline(array)).select(
        *others, "config", F.concat("prefix", "question", "suffix").alias("prompt")
    )


def assign_batches(df: DataFrame, batch_size: int = 32, index: str = "sample_idx") -> DataFrame:
    """``batch_id`` and position in the batch, from a dense index."""
    return df.withColumns(
        {
            "batch_id": F.expr(f"`{index}` div {int(batch_size)}"),
            "batch_pos": (F.col(index) % F.lit(batch_size)).cast("int"),
        }
    )


def join_gold(responses: DataFrame, qa: DataFrame, key: str = "sample_idx", how: str = "left") -> DataFrame:
    """Each response beside its question and gold answer, NULL for a response without one.

    A plain equi-join: both sides reach it through their own exchange, so adaptive execution may
    broadcast a side found small enough at run time, and splits a sample that holds a large share of
    all responses. See ``gradeloom.session.tune`` for a grouping by sample that follows the join.
    """
    return responses.join(qa, key, how)
