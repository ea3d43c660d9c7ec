"""Chat formatting: a state machine over roles and a declarative template, in DataFrame functions only.

``turns`` reads a conversation's rows in the order of ``turn`` (ties: by role, then text), checks the order of roles against
``MACHINE`` and gives each turn its state. ``segments`` emits the template's text segments of each turn, each with a loss flag. ``formatted``
puts a conversation's segments together and keeps the spans that count for the loss.

A turn's state follows from the roles before it. The machine's transitions are functions on states, which compose: turns are cut
into runs of ``RUN`` turn numbers, and those with more rows (equal or missing numbers) into steps of ``RUN`` rows. Each run becomes one
function, a window composes the functions of the runs before, and the states within a run follow. So no array of the check sees more
than a run's turns or a conversation's runs, and no text. Spans are taken per run and moved to the run's start.

Control strings inside texts and roles are escaped reversibly: a backslash is put after the ``<`` of every ``<``, backslashes, ``|``
sequence, so an escaped text contains no ``<|``. In roles, line breaks and backslashes are escaped as well.

Rows: null texts and roles are empty; a null turn number comes first; repeated rows are turns of their own; conversations with a null id are one
conversation. An invalid order is flagged (``valid`` false, from the first offending turn on) and formatted all the same. Texts are
formatted whole. Other columns are left out, so their names cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Allowed role after each state; a turn's state is its role. ``start`` is before the first turn, anything else is ``error``.
MACHINE = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
    ("assistant", "tool"): "tool",
    ("tool", "assistant"): "assistant",
}
FINAL = ("assistant",)
RUN = 64
PAGE = 8_192


@dataclass(frozen=True)
class Template:
    """Segments of each turn: literal text, or the fields ``role`` and ``text``; and the roles whose text counts for the loss."""

    segments: tuple[tuple[str, str], ...] = (("literal", "<|im_start|>"), ("role", ""), ("literal", "\n"), ("text", ""), ("literal", "<|im_end|>\n"))
    loss_roles: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape_text(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    marked = F.replace(unescape_text(c), F.lit("\\\\"), F.lit("\\\0"))
    return F.replace(F.replace(marked, F.lit("\\n"), F.lit("\n")), F.lit("\\\0"), F.lit("\\"))


def _states() -> list[str]:
    return ["start", *dict.fromkeys(MACHINE.values()), "error"]


def _step(state: Column, role: Column) -> Column:
    """The state after a turn of ``role``."""
    out = F.lit("error")
    for (before, allowed), after in MACHINE.items():
        out = F.when((state == before) & (role == allowed), F.lit(after)).otherwise(out)
    return out


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, copy, role, text, state``: rows in the order ``conv_id, turn, role, text, copy`` with the state after each."""
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    run = F.floor(F.coalesce(F.col("turn"), F.lit(-(2**62))) / RUN)
    return _with_states(rows.withColumn("run", run))


def _in_steps(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their ``place`` in the run, and ``run`` cut into steps of ``RUN`` rows."""
    place = F.row_number().over(Window.partitionBy("conv_id", "run").orderBy(*order))
    step = F.floor((F.col("place") - 1) / RUN)
    return rows.withColumn("place", place).withColumn("run", F.struct("run", step.alias("step")))


def _with_states(rows: DataFrame) -> DataFrame:
    # rows that differ in their texts only are alike for the machine
    roles = _in_steps(rows.select("conv_id", "run", "turn", "role"), "turn", "role").groupBy("conv_id", "run").agg(F.array_sort(F.collect_list(F.struct("place", "role"))).alias("roles"))
    after = {s: F.aggregate("roles", F.lit(s), lambda state, r: _step(state, r["role"])) for s in _states()}
    functions = roles.select("conv_id", "run", F.create_map(*[x for s, c in after.items() for x in (F.lit(s), c)]).alias("effect"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    composed = F.aggregate(F.coalesce(F.collect_list("effect").over(before), F.array().cast("array<map<string,string>>")), F.lit("start"), lambda state, f: f[state])
    entry = functions.select(F.col("conv_id").alias("c"), F.col("run").alias("r"), composed.alias("entry"))
    keyed = _in_steps(rows, "turn", "role", "text")
    joined = keyed.join(entry, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")))
    inner = Window.partitionBy("conv_id", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    state = F.aggregate(F.collect_list("role").over(inner), F.col("entry"), _step)
    return joined.select("conv_id", "turn", "run", "place", "role", "text", state.alias("state"))


def segments(turn_rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, run, place, segment, text, loss``: the template's segments of every turn, in order within a turn by ``segment``."""
    counts = F.col("role").isin(*template.loss_roles)
    parts = []
    for k, (kind, literal) in enumerate(template.segments):
        text = {"literal": F.lit(literal), "role": escape_role(F.col("role")), "text": escape_text(F.col("text"))}[kind]
        parts.append(F.struct(F.lit(k).alias("segment"), text.alias("text"), (counts if kind == "text" else F.lit(False)).alias("loss")))
    return turn_rows.select("conv_id", "run", "place", "state", F.inline(F.array(*parts)))


def formatted(segment_rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, spans, valid``: spans are ``start, length`` in characters of the parts that count for the loss.

    Runs are put together first and then conversations, as a conversation is one string in the end.
    """
    order = lambda fields: F.array_sort(F.collect_list(F.struct(*fields)))
    runs = segment_rows.groupBy("conv_id", "run").agg(
        order(("place", "segment", "text", "loss")).alias("parts"),
        F.max((F.col("state") == "error").cast("int")).alias("broken"),
        F.max_by("state", F.struct("place", "segment")).alias("last"),
    )
    texts = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    lengths = F.transform("parts", lambda p: F.struct(F.char_length(p["text"]).cast("long").alias("length"), p["loss"].alias("loss")))
    runs = runs.select("conv_id", "run", "broken", "last", texts.alias("text"), F.char_length(texts).cast("long").alias("length"), _spans(lengths).alias("spans"))
    whole = runs.groupBy("conv_id").agg(order(("run", "text", "length", "spans")).alias("runs"), F.max("broken").alias("broken"), F.max_by("last", "run").alias("last"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("runs", lambda r: r["text"]), "").alias("formatted"),
        _moved("runs").alias("spans"),
        ((F.col("broken") == 0) & F.col("last").isin(*FINAL)).alias("valid"),
    )


_NO_SPANS = "array<struct<start:bigint,length:bigint>>"


def _spans(lengths: Column) -> Column:
    """Starts and lengths of a run's flagged parts, from lengths and flags of all its parts."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_NO_SPANS).alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        here = F.array(F.struct(acc["at"].alias("start"), p["length"].alias("length")))
        return F.struct((acc["at"] + p["length"]).alias("at"), F.when(p["loss"], F.concat(acc["spans"], here)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(lengths, start, add, lambda acc: acc["spans"])


def _moved(runs: str) -> Column:
    """The spans of all runs, each moved by the lengths of the runs before its own."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))
    starts = F.aggregate(runs, start, lambda acc, r: F.struct((acc["at"] + r["length"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")), lambda acc: acc["starts"])
    moved = lambda z: F.transform(z["runs"]["spans"], lambda s: F.struct((s["start"] + z["at"]).alias("start"), s["length"].alias("length")))
    return F.flatten(F.transform(F.arrays_zip(F.col(runs).alias("runs"), starts.alias("at")), moved))


def parsed(chats: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, turns, loss_texts, ...`` read back from the formatted string and its spans alone."""
    opening, closing = template.segments[0][1], template.segments[-1][1]
    pieces = F.slice(F.split("formatted", _quoted(opening)), 2, 2**30)
    bodies = F.transform(pieces, lambda p: p.substr(F.lit(1), F.char_length(p) - len(closing)))

    def turn(body: Column) -> Column:
        cut = F.instr(body, F.lit("\n"))
        return F.struct(unescape_role(body.substr(F.lit(1), cut - 1)).alias("role"), unescape_text(body.substr(cut + 1, F.char_length(body))).alias("text"))

    return chats.select("conv_id", "formatted", "valid", F.transform(bodies, turn).alias("turns"), F.transform(_cut(F.col("formatted"), F.col("spans")), unescape_text).alias("loss_texts"))


def _cut(text: Column, spans: Column) -> Column:
    """The spans' texts. A place in a string is found by walking from its start, so the string is cut into pages first, and spans are cut from those."""
    pages = F.transform(F.sequence(F.lit(0).cast("long"), F.floor(F.char_length(text) / PAGE)), lambda k: text.substr((k * PAGE + 1).cast("int"), F.lit(PAGE)))

    def one(pages: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / PAGE), F.floor((s["start"] + s["length"]) / PAGE)
        some = F.array_join(F.slice(pages, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return some.substr((s["start"] - first * PAGE + 1).cast("int"), s["length"].cast("int"))

    # bound to a name, the pages are made once and not once per span
    return F.flatten(F.transform(F.array(pages), lambda p: F.transform(spans, lambda s: one(p, s))))


def _quoted(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def digests(chats: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid`` of formatted conversations, read back."""
    back = parsed(chats, template)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
