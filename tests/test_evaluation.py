"""The evaluation flow end to end on the documented sample rows."""

import json

from gradeloom.operators import metrics
from gradeloom.operators.inference import GenerationParams
from gradeloom.plans.evaluation import grade_responses, run_evaluation, write_run

QA = [
    (0, "Clips sold in April and May: 48 and half as many?", "48/2 = <<48/2=24>>24\n#### 72"),
    (1, "Sum of the first 10 primes?", "129"),
    (2, "Loaves left?", "36"),
]
REPLIES = {"Clips": "So the total is \\boxed{72}.", "Sum": "The answer: 129", "Loaves": "I think it is 40 in the end"}


def canned():
    """A loader that workers need no module for."""
    replies = dict(REPLIES)

    def load():
        def generate(prompts, params):
            out = [next(reply for word, reply in replies.items() if word in p) for p in prompts]
            return out, [len(p.split()) for p in prompts], [len(r.split()) for r in out]

        return generate

    return load


def test_run_to_written_metrics(spark, tmp_path):
    qa = spark.createDataFrame(QA, "sample_idx bigint, question string, answer string")
    params = GenerationParams(max_new_tokens=8)
    graded = run_evaluation(qa, canned(), ["no_system", "cot"], params, run_id="r", partitions=2)
    assert graded.where("elapsed_s >= 0 and run_id = 'r'").count() == 6
    by_config = {r["config"]: tuple(r)[1:] for r in metrics.eval_summary(graded, by=("config",)).collect()}
    assert by_config.keys() == {"no_system", "cot"}
    assert all(v[:3] == (3, 2, 1) and v[4] == 1 for v in by_config.values())
    wrong = metrics.incorrect_samples(graded).where("config = 'cot'").collect()
    assert [(r["sample_idx"], r["predicted"], r["ground_truth"], r["truncated"]) for r in wrong] == [(2, "40", "36", True)]

    memory = spark.createDataFrame([("r", 2.0, 5.0)], "run_id string, peak_allocated_gb double, peak_reserved_gb double")
    path = write_run(graded, str(tmp_path), "r", params, memory, model_path="tiny")
    assert path == str(tmp_path / "r")
    (line,) = [l for f in (tmp_path / "r" / "metrics").glob("part-*") for l in f.read_text().splitlines()]
    record = json.loads(line)
    assert record["total_samples"] == 6 and record["memory_stats"] == {"peak_allocated_gb": 2.0, "peak_reserved_gb": 5.0}
    assert record["config"] == {"batch_size": 32, "max_new_tokens": 8, "temperature": 0.0, "top_p": 1.0, "model_path": "tiny"}
    assert record["inference_time_seconds"] >= 0 and record["avg_time_per_sample"] >= 0
    assert spark.read.parquet(str(tmp_path / "r" / "details")).count() == 6


def test_profiles_reach_the_grade(spark):
    qa = spark.createDataFrame([(0, "q", "<<1=24>> in 3 days"), (1, "q", "Blue")], "sample_idx bigint, question string, answer string")
    responses = spark.createDataFrame([(0, "a", 1), (0, "24", 1), (1, "\\boxed{blue }", 1)], "sample_idx bigint, response string, output_tokens int")

    def right(**profiles):
        return grade_responses(responses, qa, max_new_tokens=250, **profiles).where("correct").count()

    assert right() == 0
    assert right(gold_profile="calc") == 1
    assert right(gold_profile="calc", grade_profile="nocase") == 2
    assert right(answer_profile="plain", grade_profile="nocase") == 0
