"""Answer extraction from generated text and from gold answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions.patterns import (
    ANSWER_PATTERNS,
    ANSWER_PROFILES,
    GOLD_ANNOTATION,
    GOLD_MARKER,
    NO_ANSWER,
    NUMBER,
    SIGNED_NUMBER,
    answer_regex,
    gold_regex,
)
from gradeloom.functions.text import strip_space


def _last_match(text: Column, regex: str, group: int) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(regex), F.lit(group)), F.lit(-1))


def _up_to_last(text: Column, closing: str) -> Column:
    """The text up to its last ``closing``, empty without one: spares openers that nothing closes."""
    tail = F.substring_index(text, closing, -1)
    return F.left(text, F.char_length(text) - F.char_length(tail))


# What every match of a pattern ends in.
_CLOSING = {"boxed_latex": "}", "boxed_plain": "}", "boxed_in_parens": "\\)"}


def _within(text: Column, name: str) -> Column:
    return _up_to_last(text, _CLOSING[name]) if name in _CLOSING else text


def pattern_capture(text: Column, name: str) -> Column:
    """What one named pattern captures, NULL when it does not match. No capture is empty, so one run tells both."""
    return F.nullif(F.regexp_extract(_within(text, name), answer_regex(name), 1), F.lit(""))


def pattern_matches(text: Column, name: str) -> Column:
    """Whether one named pattern matches; a NULL text does not."""
    return F.coalesce(F.rlike(_within(text, name), F.lit(answer_regex(name))), F.lit(False))


def extract_answer(text: Column, profile: str = "full") -> Column:
    """First pattern of the profile that hits, else the last number, else the profile's sentinel.

    ``coalesce`` runs a pattern only when none before it hits, and two guards skip whole groups of patterns
    without changing the outcome: every boxed form contains a closing brace, and all other patterns need a digit. A
    pattern that has an earlier one as a part cannot hit where that one did not, so it is left out.
    """
    every, sentinel = ANSWER_PROFILES[profile], F.lit(NO_ANSWER[profile])
    names = [name for k, name in enumerate(every) if not any(ANSWER_PATTERNS[earlier] in ANSWER_PATTERNS[name] for earlier in every[:k])]
    boxed = [name for name in names if name.startswith("boxed")]
    others = [pattern_capture(text, name) for name in names if name not in boxed]
    number = _last_match(text, gold_regex(NUMBER), 0)
    parts = [F.when(F.rlike(text, F.lit(gold_regex(r"\d"))), F.coalesce(*others, number)), sentinel]
    if boxed:
        parts.insert(0, F.when(F.contains(text, F.lit("}")), F.coalesce(*[pattern_capture(text, name) for name in boxed])))
    return F.coalesce(*parts)


def extract_gold(answer: Column, profile: str = "basic") -> Column:
    """The gold number: after the marker, else (``calc``) the last annotation, else the last number, else the text.

    ``basic`` and ``calc`` strip the text they fall back to, ``compare`` keeps it as it is. ``strict_numeric`` is ``basic``
    with signs and thousands separators, given without ``+`` and commas.
    """
    if profile not in ("basic", "calc", "compare", "strict_numeric"):
        raise ValueError(f"unknown gold profile {profile!r}; known: basic, calc, compare, strict_numeric")
    text = F.coalesce(answer, F.lit(""))
    if profile == "strict_numeric":
        marked = F.nullif(F.regexp_extract(text, gold_regex(rf"####\s*({SIGNED_NUMBER})"), 1), F.lit(""))
        number = F.coalesce(marked, _last_match(text, gold_regex(SIGNED_NUMBER), 0))
        return F.coalesce(F.translate(number, "+,", ""), strip_space(text))
    marker = gold_regex(GOLD_MARKER)
    fallbacks = [_last_match(text, gold_regex(NUMBER), 0), text if profile == "compare" else strip_space(text)]
    if profile == "calc":
        fallbacks.insert(0, _last_match(_up_to_last(text, ">>"), gold_regex(GOLD_ANNOTATION), 1))
    return F.coalesce(F.nullif(F.regexp_extract(text, marker, 1), F.lit("")), *fallbacks)


GOLD_FORMS = ("marker", "annotation", "number", "text")


def gold_form(answer: Column) -> Column:
    """Which form gives a gold answer under ``calc``: one of ``GOLD_FORMS``. A NULL answer is an empty text."""
    text = F.coalesce(answer, F.lit(""))
    return (
        F.when(F.rlike(text, F.lit(gold_regex(GOLD_MARKER))), F.lit("marker"))
        .when(F.rlike(_up_to_last(text, ">>"), F.lit(gold_regex(GOLD_ANNOTATION))), F.lit("annotation"))
        .when(F.rlike(text, F.lit(gold_regex(r"\d"))), F.lit("number"))
        .otherwise(F.lit("text"))
    )
