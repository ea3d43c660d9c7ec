"""Evaluation tables derived from the order, line item, event and conversation tables.

The test tables hold no question/answer data, so these views build it from whole tables with plain
column expressions; their size follows that of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GENERATIONS = 4
RUN_CONFIGS = ("no_system", "standard", "cot")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when a scan has fewer tasks than there are cores; larger scans stay as they are.

    A table of one small file is read by one task, which would then do all the work per row alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _text(value: Column) -> Column:
    return value.cast("string")


def _expected(key: Column, cust: Column) -> Column:
    return cust % 97 + key % 13


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_idx, question, answer``: gold answers in every documented shape, by ``sample_idx % 8``."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    a, b, total, shape = _text(cust % 97), _text(key % 13), _text(_expected(key, cust)), key % 8
    sign = F.when(cust % 2 == 0, F.lit("-")).otherwise(F.lit("1,"))
    answer = (
        F.when(shape <= 3, F.concat(F.lit("It has <<"), a, F.lit("+"), b, F.lit("="), total, F.lit(">> items.\n#### "), total))
        .when(shape == 4, F.concat(F.lit("It has <<1+2="), total, F.lit(">> items in 2 days")))
        .when(shape == 5, F.concat(F.lit("A total of "), total, F.lit(" items")))
        .when(shape == 6, F.lit("  no digits here\n"))
        .otherwise(F.concat(F.lit("#### "), sign, total))
    )
    question = F.concat(F.lit("Order "), _text(key), F.lit(": what is "), a, F.lit(" plus "), b, F.lit("?"))
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    return orders.select(key.alias("sample_idx"), question.alias("question"), answer.alias("answer"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four generations per sample in nine reply shapes, with token counts, run and prompt format."""
    key, cust, gen = F.col("o_orderkey"), F.col("o_custkey"), F.col("gen")
    p, shape = _text(_expected(key, cust)), (key * 7 + gen) % 9
    replies = [
        F.concat(F.lit("We get \\boxed{"), p, F.lit("}")),
        F.concat(F.lit("boxed{ "), p, F.lit(" } done")),
        F.concat(F.lit("The Answer: "), p, F.lit(".5 and 9")),
        F.concat(F.lit("first 4\ntherefore, the answer is "), p, F.lit(" ok")),
        F.concat(F.lit("x = "), p, F.lit("\nthe end")),
        F.concat(p, F.lit(" is the answer, not 3")),
        F.concat(F.lit("got 3 and then "), p, F.lit(" stop.")),
        F.lit("I do not know"),
    ]
    response = F.when(shape == 0, replies[0])
    for i, reply in enumerate(replies[1:], start=1):
        response = response.when(shape == i, reply)
    response = response.otherwise(F.concat(F.lit("\\boxed{\\frac{"), p, F.lit("}{2}}")))
    config = F.element_at(F.array(*[F.lit(c) for c in RUN_CONFIGS]), gen % 3 + 1)
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    gens = F.explode(F.array(*[F.lit(g) for g in range(GENERATIONS)])).alias("gen")
    return orders.select("*", gens).select(
        key.alias("sample_idx"),
        "gen",
        gen.alias("run_id"),
        config.alias("config"),
        response.alias("response"),
        (F.lit(100) + (key * 13 + gen * 7) % 1950).cast("int").alias("input_tokens"),
        (F.lit(20) + (key * 31 + gen * 17) % 237).cast("int").alias("output_tokens"),
    )


def memory_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``config, ts, used_mb`` from the event values."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, F.lit("G2_B2")).otherwise(F.lit("G4_B4")).alias("config"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") * 1024 / 64).alias("used_mb"),
    )


def memory_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_id, allocated_gb, reserved_gb, total_gb`` from the event values."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 7).alias("run_id"),
        (F.col("value") / 64).alias("allocated_gb"),
        (F.col("value") / 32).alias("reserved_gb"),
        F.lit(24.0).alias("total_gb"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_id, step, exit_code, elapsed_s, n_samples, config`` from the orders."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        cust.alias("run_id"),
        key.alias("step"),
        (key % 5).cast("int").alias("exit_code"),
        (F.col("o_totalprice") / 100000).alias("elapsed_s"),
        (key % 4).cast("int").alias("n_samples"),
        F.concat(F.lit("G"), _text(key % 4 + 1), F.lit("_B"), _text((cust % 6 + 1) * 2)).alias("config"),
    )


def logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_id, sample_idx, gen, logp_chosen, logp_rejected, ref_chosen, ref_rejected`` from the line items."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("run_id"),
        F.col("l_orderkey").alias("sample_idx"),
        F.col("l_linenumber").alias("gen"),
        (-F.col("l_quantity") / 10).alias("logp_chosen"),
        (-F.col("l_extendedprice") / 10000).alias("logp_rejected"),
        (-F.col("l_discount") * 10).alias("ref_chosen"),
        (-F.col("l_tax") * 10).alias("ref_rejected"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text``: whole document texts."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, turn, messages``: every conversation turn as a message list of its own."""
    message = F.struct("role", F.col("text").alias("content"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array(message).alias("messages"))
