"""Document pipeline: quality rules, toxicity, near copies, benchmark decontamination, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, with the columns of ``documents``; the last one
returns the token ids. ``run`` writes each stage's rows as Parquet into the shared folder and reads them again for the next, so a
lost executor costs a re-read and never a stage.

Rows: every stage judges each row by its text. Null texts are empty, and the quality rules reject them. Null, shared and repeated ids are
rows of their own; of near copies the one with the smallest id stays, a null id only if there is no other, and of equal ids the one stored
first. Empty tables pass through. Columns besides those of ``documents`` are left out, so their names cannot clash.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import bpe, decontaminate, near_dup, quality, toxicity
from gradeloom.operators.indexing import index_by_storage
from gradeloom.session import tune
from gradeloom.sources.workdir import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with ``row``, a number of their own, from their place in storage: ids may be null or shared."""
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_line"))
    except AnalysisException:  # not read straight from files
        return _numbered(stored(docs, "documents"))
    return index_by_storage(placed, "_file", "_line", "row")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    tune(spark)
    return quality.quality_filter(docs).select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a model learned from this stage's input."""
    tune(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity_filter(docs, model).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8), the one with the smallest id, row by row."""
    tune(spark)
    rows = _numbered(docs.select(*COLUMNS))
    groups = near_dup.near_duplicates(rows, shingle=5, percent=80, id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = rows.select("doc_id", "row").join(groups, "row").groupBy("component_id").agg(F.min(first)["row"].alias("_kept"))
    return rows.join(kept, F.col("row") == F.col("_kept"), "left_semi").select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    tune(spark)
    return decontaminate.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of each document."""
    tune(spark)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode_and_decode(docs, ranks, keep_ids=True)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near copies", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", token_stage),
]

#: The learned toxicity model and the BPE merges cannot be stated in SQL; tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
