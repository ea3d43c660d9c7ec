"""Text helpers with Python string semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ASSISTANT_MARKER = "<|im_start|>assistant"


# The characters ``str.strip`` removes, and those among them that ``float`` accepts around a number.
STRIP_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
FLOAT_SPACES = "".join(c for c in STRIP_SPACES if not "\x1c" <= c <= "\x1f")


def strip_space(text: Column, spaces: str = STRIP_SPACES) -> Column:
    """Strip all Unicode whitespace from both ends (``trim`` alone removes the ASCII space only)."""
    return F.btrim(text, F.lit(spaces))


def preview_text(text: Column, n: int) -> Column:
    """The first ``n`` characters, with ``...`` after them when the text is longer."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def strip_prompt_echo(full_text: Column, prompt: Column, marker: str = ASSISTANT_MARKER) -> Column:
    """The reply inside a decoded text: after the last marker, or else after the prompt's length."""
    reply = strip_space(F.substring_index(full_text, marker, -1))
    behind_prompt = F.substring(full_text, F.length(F.coalesce(prompt, F.lit(""))) + 1, F.length(full_text))
    return F.when(F.contains(full_text, F.lit(marker)), reply).otherwise(behind_prompt)
