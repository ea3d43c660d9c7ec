from pyspark.sql import functions as F

from gradeloom.functions.prompts import (
    TEMPLATES,
    build_messages,
    extract_system_prompt,
    format_prompt,
    render_chat,
    template_for,
)
from gradeloom.functions.text import preview_text, strip_prompt_echo, strip_space
from gradeloom.operators.samples import expand_configs

SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def test_strip_is_python_strip(spark):
    texts = [SPACES + "a b" + SPACES, "a" + SPACES + "b", SPACES, "", "\u200bx\u200b", "x\n", "\n\nx \n y\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", strip_space(F.col("t")).alias("s")).collect():
        assert row["s"] == row["t"].strip()


def test_strip_is_linear_in_inner_whitespace(spark):
    assert one(spark, F.length(strip_space(F.concat(F.lit("a"), F.repeat(F.lit(" "), 2_000_000), F.lit("b"))))) == 2_000_002


def test_preview_and_echo(spark):
    assert one(spark, preview_text(F.lit("abcdef"), 6)) == "abcdef"
    assert one(spark, preview_text(F.lit("abcdefg"), 6)) == "abcdef..."
    assert one(spark, preview_text(F.lit("答案是七"), 2)) == "答案..."
    marked = F.lit("<|im_start|>user\nq<|im_start|>assistant\n a <|im_start|>assistant\n b \n")
    assert one(spark, strip_prompt_echo(marked, F.lit("zzz"))) == "b"
    assert one(spark, strip_prompt_echo(F.lit("问题reply "), F.lit("问题"))) == "reply "
    assert one(spark, strip_prompt_echo(F.lit("abc"), F.lit("longer than it"))) == ""


def test_templates(spark):
    question = "What is {x} + {{1}}\\?"
    user = "<|im_start|>user\n" + question + "<|im_end|>\n<|im_start|>assistant\n"
    assert one(spark, format_prompt(F.lit(question), "no_system")) == user
    assert (
        one(spark, format_prompt(F.lit(question), "standard"))
        == "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n" + user
    )
    assert "within \\boxed{}.<|im_end|>" in one(spark, format_prompt(F.lit(question), "cot"))
    names = [template_for(s, c) for s in (True, False) for c in (True, False)]
    assert names == ["cot", "standard_boxed", "cot_in_user", "no_system"]
    assert TEMPLATES["cot_in_user"].prefix.endswith("\\boxed{}.\n\n")


def test_expand_and_system_prompt(spark):
    df = spark.createDataFrame([(1, "system?"), (2, "b")], "sample_idx int, question string")
    rows = expand_configs(df).select("config", extract_system_prompt(F.col("prompt")).alias("s")).collect()
    assert len(rows) == 2 * len(TEMPLATES)
    assert all(r["s"] == TEMPLATES[r["config"]].system for r in rows)
    two_lines = F.lit("<|im_start|>system\n  be\nkind \n<|im_end|>\n<|im_start|>user\nq")
    assert one(spark, extract_system_prompt(two_lines)) == "be\nkind"


def test_messages_render_to_the_template(spark):
    df = spark.createDataFrame([("q1",)], "question string")
    for name in ("no_system", "standard", "cot"):
        row = df.select(
            render_chat(build_messages(F.col("question"), TEMPLATES[name].system)).alias("chat"),
            format_prompt(F.col("question"), name).alias("prompt"),
        ).first()
        assert row["chat"] == row["prompt"]
    assert one(spark, F.size(build_messages(F.lit("q"), ""))) == 1
    turns = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in (("user", "a"), ("assistant", "b"))])
    assert one(spark, render_chat(turns)) == (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>assistant\n"
    )
