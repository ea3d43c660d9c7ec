"""Answer patterns, cascade profiles and their sentinels.

Patterns are kept in Python notation, the notation the expected results are defined in.
``java_regex`` turns one into the spelling with the same meaning in Spark's regex engine.
"""

from __future__ import annotations

import re

# ---- Fixed values: patterns, profiles and sentinels decide the extracted answer. ----

NUMBER = r"\d+(?:\.\d+)?"

ANSWER_PATTERNS = {
    "boxed_latex": r"\\boxed\{([^}]+)\}",
    "boxed_in_parens": r"\\\([^)]*\\boxed\{([^}]+)\}[^(]*\\\)",
    "boxed_in_dollars": r"\$[^$]*\\boxed\{([^}]+)\}[^$]*\$",
    "boxed_plain": r"boxed\{([^}]+)\}",
    "answer_word": r"(?:answer|结果|答案是?)\s*[:：]?\s*[=-]?\s*(\d+(?:\.\d+)?)",
    "answer_word_short": r"(?:answer|结果)\s*[:：]?\s*[=-]?\s*(\d+(?:\.\d+)?)",
    "conclusion_word": r"(?:therefore|thus|so)\s*,?\s*(?:the answer is)?\s*[=-]?\s*(\d+(?:\.\d+)?)",
    "sign_at_line_end": r"[=-]\s*(\d+(?:\.\d+)?)\s*$",
    "number_at_line_end": r"(\d+(?:\.\d+)?)\s*(?:is the answer|$)",
}

ANSWER_PROFILES = {
    "full": ("boxed_latex", "boxed_plain", "answer_word", "conclusion_word", "sign_at_line_end", "number_at_line_end"),
    "full8": (
        "boxed_latex",
        "boxed_in_parens",
        "boxed_in_dollars",
        "boxed_plain",
        "answer_word",
        "conclusion_word",
        "sign_at_line_end",
        "number_at_line_end",
    ),
    "plain": ("answer_word", "conclusion_word", "sign_at_line_end", "number_at_line_end"),
    "compare": ("boxed_latex", "boxed_plain", "answer_word_short", "sign_at_line_end"),
}

NO_ANSWER = {"full": "无法提取答案", "full8": "无法提取答案", "plain": "无法提取答案", "compare": "无法提取"}

GOLD_MARKER = r"####\s*(\d+(?:\.\d+)?)"
GOLD_ANNOTATION = r"<<.*?=(\d+(?:\.\d+)?)>>"

# ---- End of fixed values. ----

# A number with sign and thousands separators. A sign counts unless it stands behind a word, as in ``7-5``.
SIGNED_NUMBER = r"(?:(?<![\w)])[+-])?(?:\d{1,3}(?:,\d{3})+(?!\d)|\d+)(?:\.\d+)?"

# Java's Unicode \s lacks the four separators U+001C..U+001F that Python's has.
JAVA_SPACE = r"[\s\x1C-\x1F]"


def java_regex(pattern: str, flags: str) -> str:
    """The Java spelling of a Python pattern.

    ``d`` keeps ``$`` and ``.`` to ``\\n`` alone, ``U`` makes ``\\d`` and ``\\s`` Unicode-aware; without
    either, Java finds a different answer in texts that hold U+2028 or non-ASCII digits and spaces.

    Two changes keep matching linear and the matches as they are: runs of spaces are possessive unless a line end
    may follow, as nothing else that follows starts with a space; and a pattern that begins with a number does not
    begin within one, where the leftmost match never starts.
    """
    if pattern.startswith(r"(\d+"):
        pattern = r"(?<!\d)" + pattern
    possessive = re.sub(r"\\s\*(?!\$|\(\?:[^)]*\$\))", lambda _: JAVA_SPACE + "*+", pattern)
    return f"(?{flags})" + possessive.replace(r"\s", JAVA_SPACE)


# What goes before a pattern to find its leftmost match with fewer tries. A closing bracket ends what the opener of
# ``boxed_in_parens`` reaches, so of the openers between two of them the first one matches if any does.
_FIRST_OPENER = {"boxed_in_parens": r"(?:\A|\))(?:(?!\\\()[^)])*+"}


def answer_regex(name: str) -> str:
    """The case-insensitive, multi-line form of one named answer pattern."""
    return java_regex(_FIRST_OPENER.get(name, "") + ANSWER_PATTERNS[name], "imdU")


def gold_regex(pattern: str) -> str:
    return java_regex(pattern, "dU")
