"""Quality rules as a short-circuit cascade.

A rule is a comparison of two counts of a text. Each rule's cost and rejection share are measured on a sample of the table;
rules run in falling order of rejections per cost, and a rule sees only texts that all earlier ones kept. As a text is kept when
no rule rejects it, the order changes the cost and never the result. Counts are computed for the texts that a rule still sees,
once per text.

Rows: one row out per row in. A null text is empty, an empty text has no words and is rejected by ``few_words``. Texts are
processed whole, repeated rows are judged alike, an empty table gives an empty table. Columns of the input beside the id and the
text are left out, so their names cannot clash.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.textbatch import Words, byte_array, per_text_sum, slices, split_words, text_bytes

WINDOW = 8
SAMPLE_ROWS = 1000
SAMPLE_CHARS = 50_000

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True


@dataclass(frozen=True)
class Rule:
    """Rejects a text when ``a * left > b * right``; the constant 1 may stand for a count."""

    name: str
    a: int
    left: str
    b: int
    right: str

    def rejects(self, texts: "Texts", rows: np.ndarray) -> np.ndarray:
        return self.a * texts.counts(self.left, rows) > self.b * texts.counts(self.right, rows)


BASE_RULES = (
    Rule("few_words", 20, "one", 1, "n_words"),
    Rule("repeated_words", 100, "n_repeat_words", 30, "n_words"),
)
RULES = (
    Rule("symbols", 100, "n_symbols", 5, "word_chars"),
    Rule("duplicate_lines", 100, "n_dup_lines", 50, "n_lines"),
    Rule("capitals", 100, "n_upper", 60, "n_letters"),
    Rule("variety", 1, "n_words", 1, "distinct_words_squared"),  # distinct words grow about with the root of a text's length
    Rule("short_words", 2, "n_words", 1, "word_chars"),
)
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Texts:
    """Texts of a slice with counts that are computed for the asked rows only, each once."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        self.n = len(texts)
        self.data, self.offsets = text_bytes(texts)
        self._words: Words | None = None
        self._codes: np.ndarray | None = None
        self._known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def words(self) -> Words:
        if self._words is None:
            self._words = split_words(self.data, self.offsets)
        return self._words

    @property
    def word_codes(self) -> np.ndarray:
        """Equal numbers for equal words."""
        if self._codes is None:
            self._codes = codes(self.words.array())
        return self._codes

    def counts(self, name: str, rows: np.ndarray) -> np.ndarray:
        values, known = self._known.setdefault(name, (np.zeros(self.n, np.int64), np.zeros(self.n, bool)))
        missing = rows[~known[rows]]
        if len(missing):
            few = len(missing) < self.n // 2
            part = Texts(self.texts.take(pa.array(missing))) if few else self
            values[missing] = COUNTS[name](part) if few else COUNTS[name](part)[missing]
            known[missing] = True
        return values[rows]


def codes(values: pa.Array) -> np.ndarray:
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _bytes_in(kind: np.ndarray):
    return lambda t: per_text_sum(kind[t.data], t.offsets)


def _word_chars(t: Texts) -> np.ndarray:
    return per_text_sum(_STARTS_CHARACTER[t.words.data], t.words.offsets[t.words.first])


def _lines(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Per line with a word: its text, and a code that is equal for equal lines."""
    feeds = t.data == 0x0A
    lines = split_words(t.data, t.offsets, np.arange(256) == 0x0A)  # empty lines have no word anyway
    inked = np.concatenate(([0], np.cumsum(~(feeds | np.isin(t.data, np.frombuffer(b" \t\x0b\x0c\r", np.uint8))))))
    at = np.flatnonzero(~feeds)
    starts, ends = at[lines.offsets[:-1]], at[lines.offsets[1:] - 1] + 1
    has_word = inked[ends] > inked[starts]
    return lines.text[has_word], codes(byte_array(lines.data, lines.offsets))[has_word]


def _n_lines(t: Texts) -> np.ndarray:
    return np.bincount(_lines(t)[0], minlength=t.n)


def _repeats(owner: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """Per text its values less its distinct ones."""
    distinct = np.unique(code * n + owner) % n if len(code) else owner
    return np.bincount(owner, minlength=n) - np.bincount(distinct, minlength=n)


def _n_dup_lines(t: Texts) -> np.ndarray:
    return _repeats(*_lines(t), t.n)


def _n_distinct_words(t: Texts) -> np.ndarray:
    return t.words.count - _repeats(t.words.text, t.word_codes, t.n)


def _n_repeat_words(t: Texts, window: int = WINDOW) -> np.ndarray:
    """Words in windows that stand twice or more in their text. Codes of 1, 2, 4, 8 words are exact, not hashes."""
    code, owner = t.word_codes, t.words.text
    step = 1
    while step < window:
        if len(code) <= step:
            return np.zeros(t.n, np.int64)
        code = codes(pa.array(code[:-step] * (int(code.max()) + 1) + code[step:]))
        step *= 2
    whole = owner[: len(code)] == owner[window - 1 :]
    places = np.flatnonzero(whole)
    same = codes(pa.array(code[places] * t.n + owner[places]))
    often = places[np.bincount(same)[same] > 1] if len(same) else places
    change = np.zeros(len(owner) + 1, np.int64)
    np.add.at(change, often, 1)
    np.add.at(change, often + window, -1)
    return per_text_sum(np.cumsum(change[:-1]) > 0, t.words.first)


COUNTS = {
    "one": lambda t: np.ones(t.n, np.int64),
    "n_words": lambda t: t.words.count,
    "word_chars": _word_chars,
    "n_symbols": _bytes_in(_SYMBOLS),
    "n_upper": _bytes_in(_UPPER),
    "n_letters": _bytes_in(_LETTER),
    "n_lines": _n_lines,
    "n_dup_lines": _n_dup_lines,
    "distinct_words_squared": lambda t: _n_distinct_words(t) ** 2,
    "n_repeat_words": _n_repeat_words,
}


def cascade(texts: Texts, rules: Sequence[Rule], rows: np.ndarray, timings: dict[str, list[float]] | None = None) -> np.ndarray:
    """Which of the rows no rule rejects. ``timings`` collects seconds, texts seen and texts rejected per rule."""
    alive = rows
    for rule in rules:
        if not len(alive):
            break
        began = time.perf_counter()
        out = rule.rejects(texts, alive)
        if timings is not None:
            seen = timings.setdefault(rule.name, [0.0, 0.0, 0.0])
            seen[0] += time.perf_counter() - began
            seen[1] += len(alive)
            seen[2] += int(out.sum())
        alive = alive[~out]
    return np.isin(rows, alive)


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of at most ``sample_rows`` rows, none above ``SAMPLE_CHARS``.

    The sample is taken from the first partitions that yield it, so no more of the table is read, and measured on the driver: each
    rule alone on fresh texts, so that no rule profits from counts of another.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(text.alias("text")).where(F.char_length("text") <= SAMPLE_CHARS).take(sample_rows)
    timings: dict[str, list[float]] = {}
    for part in slices([pa.RecordBatch.from_pydict({"text": pa.array([r["text"] for r in rows], pa.string())})]):
        for rule in rules:
            texts = Texts(part.column("text"))
            cascade(texts, [rule], np.arange(texts.n), timings)
    gain = {name: rejected / max(seconds, 1e-9) for name, (seconds, _, rejected) in timings.items()}
    return sorted(rules, key=lambda r: (-gain.get(r.name, 0.0), [x.name for x in rules].index(r.name)))


def quality_verdicts(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    base_rules: Sequence[Rule] = BASE_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: Sequence[str] = BASE_COUNTS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id``, the asked counts, ``base_failed`` (a base rule rejects) and ``kept`` (no rule rejects).

    With no ``counts``, base rules take part in the cascade like all others and nothing else is computed.
    """
    ordered = order_rules(docs, rules if counts else [*base_rules, *rules], text_col, sample_rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = Texts(part.column("text"))
            rows = np.arange(texts.n)
            out = {"doc_id": part.column("doc_id")} | {c: pa.array(texts.counts(c, rows)) for c in counts}
            if counts:
                failed = np.any([r.rejects(texts, rows) for r in base_rules], axis=0)
                kept = np.zeros(texts.n, dtype=bool)
                good = np.flatnonzero(~failed)
                kept[good] = cascade(texts, ordered, good)
                out |= {"base_failed": pa.array(failed), "kept": pa.array(kept)}
            else:
                out |= {"kept": pa.array(cascade(texts, ordered, rows))}
            yield pa.RecordBatch.from_pydict(out)

    columns = "".join(f", {c} bigint" for c in counts) + (", base_failed boolean" if counts else "")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(judge, f"doc_id bigint{columns}, kept boolean")


def quality_filter(
    docs: DataFrame,
    rules: Sequence[Rule] = (*BASE_RULES, *RULES),
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows of ``docs`` whose text no rule rejects, with all their columns, filtered where they lie."""
    ordered = order_rules(docs, rules, text_col, sample_rows)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            texts = Texts(part.column(text_col))
            yield part.filter(pa.array(cascade(texts, ordered, np.arange(texts.n))))

    return docs.mapInArrow(keep, docs.schema)
