"""Registered queries of this subpackage: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import alignment, bpe, chat, decontaminate, divergence, embeddings, licenses, near_dup, quality, suffix_tree, token_files, toxicity, urls
from gradeloom.llm.twins import TWINS  # noqa: F401
from gradeloom.session import tune
from gradeloom.sources.workdir import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), ranks)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_files.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    path = new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer, path, end_id=2)
    return token_files.read_token_files(spark, path)


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.formatted(chat.segments(chat.turns(rows))))


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = token_files.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    right = alignment.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align_documents(table(spark, sf_dir, "documents"), left, right)


@query
def op12_embedding_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), min_docs=30, top=50)
