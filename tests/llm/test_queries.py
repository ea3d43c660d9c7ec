"""Registered queries of this subpackage: twins, contracts and the pipeline."""

import pytest

import corpus_pipeline
from gradeloom.llm import decontaminate
from gradeloom.llm.queries import QUERIES, TWINS
from oracle_check import compare, connect
from test_operators import brute_components

COLUMNS = {
    "op1": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op2": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    "op3": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op4": {"doc_id", "n_shingles", "component_id", "kept"},
    "op5": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op6": {"doc_id", "held_out", "score", "predicted"},
    "op7": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op8": {"doc_id", "contaminated", "item_ids"},
    "op9": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op10": {"page_id", "host", "path", "rule", "verdict"},
    "op11": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
}


@pytest.mark.parametrize("key", sorted(TWINS))
def test_twin(spark, sf_dir, key):
    assert compare(QUERIES[key](spark, sf_dir), connect(sf_dir), TWINS[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(TWINS)))
def test_whole_table(spark, sf_dir, key):
    out = QUERIES[key](spark, sf_dir)
    assert COLUMNS[key.split("_")[0]] <= set(out.columns)
    name = "pages" if key.startswith("op10") else "documents"
    assert out.count() == spark.read.parquet(f"{sf_dir}/{name}.parquet").count()


def test_toxicity_on_held_out_rows(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = QUERIES["op6_toxicity"](spark, sf_dir).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.94 * len(held)


def test_suffix_tree_beats_single_words_on_held_out_rows(spark, sf_dir):
    row = QUERIES["op3_language_model"](spark, sf_dir).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert row[0] > row[1]


def test_pipeline_does_what_its_operators_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kept_by = {
        "quality rules": lambda d: {r["doc_id"] for r in QUERIES["op1_quality_rules"](spark, sf_dir).where("kept").collect()},
        "near copies": lambda d: {i for i, (_, c) in brute_components([(r["doc_id"], r["text"]) for r in d.collect()], 5).items() if i == c},
        "benchmark decontamination": lambda d: {r["doc_id"] for r in decontaminate.find_overlaps(d, bench).where("not contaminated").collect()},
    }
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        assert 0 < out.count() <= docs.count()
        if name in kept_by:
            assert {r["doc_id"] for r in out.collect()} == kept_by[name](docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = out
        else:
            assert out.count() == docs.count()


def test_stages_judge_rows_whatever_their_ids(spark, sf_dir):
    """Null, shared and repeated ids, null and empty texts, extra columns with the names the stages use."""
    clean = [" ".join(f"{w}{k} of the {w}" for w in ("river", "stone", "lamp", "garden", "window", "letter", "mountain", "paper", "silver", "kitchen")) for k in range(6)]
    near = clean[0] + " and so"
    rows = [(None, clean[0]), (1, clean[1]), (1, clean[2]), (1, clean[2]), (None, clean[3]), (5, near), (None, None), (7, ""), (4, clean[4]), (2, clean[4])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, component_id long, kept boolean"
    docs = spark.createDataFrame([(i, t, "en", None, None, 0, 0, False) for i, t in rows], schema).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    wanted = {
        "quality rules": sorted(map(str, [r for r in rows if r[1]])),
        "near copies": sorted(map(str, [(1, clean[1]), (1, clean[2]), (None, clean[3]), (5, near), (None, None), (7, ""), (2, clean[4])])),
        "benchmark decontamination": sorted(map(str, rows)),
        "toxicity": sorted(map(str, rows)),
    }
    for name, want in wanted.items():
        out = stages[name](spark, docs, sf_dir)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        assert sorted(str((r["doc_id"], r["text"])) for r in out.collect()) == want, name
    tokens = stages["byte-level BPE"](spark, docs, sf_dir).collect()
    assert sorted(str(r["doc_id"]) for r in tokens) == sorted(str(i) for i, _ in rows)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        if name != "toxicity":  # learns from its input
            assert stage(spark, empty, sf_dir).count() == 0, name
