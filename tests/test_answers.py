"""Extraction: literal vectors, and equality with Python's regex engine on random texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gradeloom.functions.answers import extract_answer, extract_gold, pattern_capture
from gradeloom.functions.patterns import (
    ANSWER_PATTERNS,
    ANSWER_PROFILES,
    GOLD_ANNOTATION,
    GOLD_MARKER,
    NO_ANSWER,
    NUMBER,
)

ANSWER_VECTORS = [
    ("\\boxed{72}", "72", "72", "72"),
    ("boxed{ 5 }", " 5 ", "5", " 5 "),
    ("x \\boxed{\\frac{1}{2}} y", "\\frac{1", "2", "\\frac{1"),
    ("\\boxed{$18}", "$18", "18", "$18"),
    ("The ANSWER: 12.5 ok", "12.5", "12.5", "12.5"),
    ("答案是：42", "42", "42", "42"),
    ("结果-3", "3", "3", "3"),
    ("also 5 apples", "5", "5", "5"),
    ("So, the answer is 17.", "17", "17", "17"),
    ("a = 3\nb - 4\nend", "3", "3", "3"),
    ("12 apples\n30", "30", "30", "30"),
    ("30 is the answer!", "30", "30", "30"),
    ("cost 1,234 total", "234", "234", "234"),
    ("no digits", "无法提取答案", "无法提取答案", "无法提取"),
    ("1\u20282 z", "2", "2", "2"),
    ("٣ foo", "٣", "٣", "٣"),
    ("一共 3 个, 答案 7 元 8", "7", "7", "8"),
    ("", "无法提取答案", "无法提取答案", "无法提取"),
    (None, "无法提取答案", "无法提取答案", "无法提取"),
]

GOLD_VECTORS = [
    ("x\n#### 72", "72", "72"),
    ("####\n 7", "7", "7"),
    ("#### 3.50 kg", "3.50", "3.50"),
    ("#### -5", "5", "5"),
    ("#### 1,000", "1", "1"),
    ("<<48/2=24>>24 in 3 days", "3", "24"),
    ("<<a\nb=4>> 8", "8", "8"),
    ("<<1+1=2>> #### 9", "9", "9"),
    ("  no digits\n", "no digits", "no digits"),
    ("", "", ""),
    (None, "", ""),
]

PIECES = [
    "answer", "ANSWER", "结果", "答案", "答案是", ":", "：", "=", "-", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x1f",
    "\x85", "\u00a0", "\u2003", "\u2028", "\u3000", "1", "42", "3.5", ".", "7.", ",", "1,234", "٣", "５", "𝟗", "boxed{", "BOXED{",
    "\\boxed{", "}", "$", "\\(", "\\)", "(", ")", "therefore", "Thus", "so", "ſo", "the answer is", "The Answer İs", "is the answer",
    "ıs the answer", "####", "<<", ">>", "<<1+1=2>>", "K", "x", "é",
]


def random_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def first_hit(text, names, otherwise):
    hits = (re.search(ANSWER_PATTERNS[n], text, re.IGNORECASE | re.MULTILINE) for n in names)
    return next((m.group(1) for m in hits if m), (re.findall(NUMBER, text) or [otherwise])[-1])


def gold_model(text, profile):
    marked = re.search(GOLD_MARKER, text)
    options = [marked.group(1)] if marked else []
    options += re.findall(GOLD_ANNOTATION, text)[-1:] if profile == "calc" else []
    options += re.findall(NUMBER, text)[-1:]
    return [*options, text if profile == "compare" else text.strip()][0]


def test_answer_vectors(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(ANSWER_VECTORS)], "i int, t string")
    rows = df.select("i", *[extract_answer(F.col("t"), p).alias(p) for p in ("full", "full8", "plain", "compare")]).collect()
    for row in rows:
        text, full, plain, compare = ANSWER_VECTORS[row["i"]]
        assert (row["full"], row["full8"], row["plain"], row["compare"]) == (full, full, plain, compare), text


def test_gold_vectors(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(GOLD_VECTORS)], "i int, t string")
    for row in df.select("i", *[extract_gold(F.col("t"), p).alias(p) for p in ("basic", "calc")]).collect():
        assert (row["basic"], row["calc"]) == GOLD_VECTORS[row["i"]][1:], GOLD_VECTORS[row["i"]][0]
    with pytest.raises(ValueError):
        extract_gold(F.col("t"), "other")


def test_random_texts_equal_python(spark):
    texts = random_texts(20000, 7)
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    answers = [extract_answer(F.col("t"), p).alias(p) for p in ANSWER_PROFILES]
    golds = [extract_gold(F.col("t"), p).alias("gold_" + p) for p in ("basic", "calc", "compare")]
    captures = [pattern_capture(F.col("t"), n).alias("p_" + n) for n in ANSWER_PATTERNS]
    different = []
    for row in df.select("t", *answers, *golds, *captures).collect():
        t = row["t"]
        for p, names in ANSWER_PROFILES.items():
            if row[p] != first_hit(t, names, NO_ANSWER[p]):
                different.append((t, p, row[p], first_hit(t, names, NO_ANSWER[p])))
        for p in ("basic", "calc", "compare"):
            if row["gold_" + p] != gold_model(t, p):
                different.append((t, p, row["gold_" + p], gold_model(t, p)))
        for n, pattern in ANSWER_PATTERNS.items():
            m = re.search(pattern, t, re.IGNORECASE | re.MULTILINE)
            if row["p_" + n] != (m.group(1) if m else None):
                different.append((t, n, row["p_" + n], m and m.group(1)))
        assert row["full"] == row["full8"]
    assert not different, different[:5]


def test_strict_numeric_gold(spark):
    cases = {
        "#### -5": "-5", "#### 1,000": "1000", "#### +2.5": "2.5", "he has 7-5": "5", "loss of -3,250,000.5 now": "-3250000.5",
        "#### 12,34": "12", "#### 1,0000": "1", " Blue ": "Blue", "": "", None: "",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "answer string, want string")
    got = df.select("answer", "want", extract_gold(F.col("answer"), "strict_numeric").alias("got")).where("got is distinct from want")
    assert [tuple(r) for r in got.collect()] == []
