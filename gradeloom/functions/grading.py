"""Grading of a predicted answer against a gold answer, and flags on token counts."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions.text import FLOAT_SPACES, strip_space

# Tolerance of the numeric comparison, prompt warning threshold.
TOLERANCE = 0.001
LONG_INPUT_TOKENS = 1900

_PLAIN_NUMBER = r"\A[+-]?[0-9]+(?:\.[0-9]*)?\z"
_DIGITS = r"[0-9](?:_?[0-9])*"
_NUMBER = rf"(?i)\A[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|inf(?:inity)?|nan)\z"


@lru_cache(maxsize=1)
def _unicode_digits() -> tuple[str, str]:
    """All non-ASCII decimal digits and the ASCII digit each stands for."""
    digits = [chr(cp) for cp in range(128, sys.maxunicode + 1) if unicodedata.category(chr(cp)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def parse_number(text: Column) -> Column:
    """The double a Python ``float()`` call reads from the text, NULL where it raises.

    A plain cast is both wider (it takes ``1d``) and narrower (no ``1_000``, no non-ASCII digits or
    spaces), hence the check of the literal before it. Unlike ``strip``, ``float`` leaves the separators
    U+001C..U+001F in place and fails on them. Plain ASCII numbers, nearly all there are, leave at the
    first branch. Of the checked literals only a signed NaN has no cast.
    """
    literal = strip_space(F.translate(text, *_unicode_digits()), FLOAT_SPACES)
    bare = F.translate(literal, "_+", "")
    return F.when(F.rlike(text, F.lit(_PLAIN_NUMBER)), text.try_cast("double")).when(
        F.rlike(literal, F.lit(_NUMBER)), F.coalesce(bare.try_cast("double"), F.lit(float("nan")))
    )


def grade_answer(predicted: Column, gold: Column, profile: str = "exact") -> Column:
    """Numeric equality within the tolerance when both sides are numbers, else equality of stripped strings.

    ``nocase`` strips before it reads numbers and compares strings without regard to case. NaN and
    infinities never grade right. The numeric comparison is NULL exactly when a side is no number, so
    each side is parsed once.
    """
    if profile not in ("exact", "nocase"):
        raise ValueError(f"unknown grading profile {profile!r}; known: exact, nocase")
    predicted, gold = F.coalesce(predicted, F.lit("")), F.coalesce(gold, F.lit(""))
    left, right = strip_space(predicted), strip_space(gold)
    if profile == "exact":
        a, b = parse_number(predicted), parse_number(gold)
    else:
        a, b = parse_number(left), parse_number(right)
        left, right = F.lower(left), F.lower(right)
    return F.coalesce(F.abs(a - b) < F.lit(TOLERANCE), left == right)


def flag_truncated(output_tokens: Column, max_new_tokens: int) -> Column:
    """Whether generation used up its token budget."""
    return output_tokens >= F.lit(max_new_tokens)


def flag_long_input(input_tokens: Column, threshold: int = LONG_INPUT_TOKENS) -> Column:
    """Whether a prompt is close to the input budget."""
    return input_tokens > F.lit(threshold)
