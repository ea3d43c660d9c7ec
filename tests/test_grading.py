import random

from pyspark.sql import functions as F

from gradeloom.functions.grading import flag_long_input, flag_truncated, grade_answer, parse_number

ACCEPTED = ["72", " 72 ", "1e2", ".5", "5.", "+3", "-5", "1_000", "1_0.0_5e1_0", "٣", "\u300042\u3000", "\x857", "1e400", "inf",
            "-Infinity", "nan", "+NaN", "𝟗.5"]
REJECTED = ["\x1c7", "1,000", "1d", "1f", "0x10", "", " ", "1__0", "_1", "1_", "1e", ".", "1_.5", "1 2", "infin", "5\n6", "\\frac{1"]


def as_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def python_grade(a, b, nocase=False):
    x, y = (as_float(a.strip()), as_float(b.strip())) if nocase else (as_float(a), as_float(b))
    if x is not None and y is not None:
        return abs(x - y) < 0.001
    return a.strip().lower() == b.strip().lower() if nocase else a.strip() == b.strip()


def test_numbers_are_those_of_python(spark):
    rng = random.Random(3)
    alphabet = "0123456789.+-eE_ dfxX\u00a0\n٣infa"
    texts = ACCEPTED + REJECTED + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(20000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", parse_number(F.col("t")).alias("x")).collect():
        want = as_float(row["t"])
        assert (row["x"] == want) or (want is not None and want != want and row["x"] != row["x"]), (row["t"], row["x"], want)
    assert all(as_float(t) is not None for t in ACCEPTED) and all(as_float(t) is None for t in REJECTED)


def test_grades_are_those_of_python(spark):
    values = ACCEPTED + REJECTED + ["1", "1.001", "1.0011", "0.999", "72.0", "ABC", " abc\u2003", "Straße", "STRASSE", "18", "$18"]
    pairs = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(pairs, "a string, b string")
    graded = df.select(
        "a", "b", grade_answer(F.col("a"), F.col("b")).alias("x"), grade_answer(F.col("a"), F.col("b"), "nocase").alias("n")
    )
    for r in graded.collect():
        assert r["x"] == python_grade(r["a"], r["b"]), (r["a"], r["b"])
        assert r["n"] == python_grade(r["a"], r["b"], True), (r["a"], r["b"])


def test_documented_edge_cases(spark):
    df = spark.createDataFrame([("1", "1.001"), ("inf", "inf"), ("nan", "nan"), (None, ""), ("1,000", "1000")], "a string, b string")
    got = [r["g"] for r in df.select(grade_answer(F.col("a"), F.col("b")).alias("g")).collect()]
    assert got == [True, False, False, True, False]


def test_flags(spark):
    row = spark.range(1).select(
        flag_truncated(F.lit(512), 512).alias("a"), flag_truncated(F.lit(511), 512).alias("b"),
        flag_long_input(F.lit(1900)).alias("c"), flag_long_input(F.lit(1901)).alias("d"),
    ).first()
    assert tuple(row) == (True, False, False, True)
