"""Every registered query against its SQL twin on whole tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gradeloom.functions.rewards import dpo_loss
from gradeloom.plans.catalog import QUERIES
from gradeloom.plans.oracle import ORACLE_SQL
from gradeloom.sources import derived
from oracle_check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, sf_dir, key):
    assert compare(entry.queries()[key](spark, sf_dir), con, entry.oracle_sql()[key]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_known_counts(spark, sf_dir):
    """Counts found independently of both engines' queries, at scale factor 0.01."""
    if not sf_dir.endswith("sf0.01"):
        pytest.skip("counts are those of scale factor 0.01")
    queries = entry.queries()
    graded = queries["grade_answer"](spark, sf_dir)
    assert (graded.count(), graded.where("correct").count()) == (60000, 27535)
    golds = queries["extract_gold"](spark, sf_dir).join(
        queries["extract_gold_calc"](spark, sf_dir).withColumnRenamed("gold", "calc"), "sample_idx"
    )
    assert golds.where("gold <> calc").count() * derived.GENERATIONS == 7476
    losses = derived.logps(spark, sf_dir).select(dpo_loss(F.col("logp_chosen"), F.col("logp_rejected")).alias("x"))
    assert round(losses.agg(F.avg("x")).first()[0], 6) == 0.577905
