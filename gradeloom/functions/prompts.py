"""ChatML prompts: named templates, rendering of message lists, system prompt lookup."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions.text import ASSISTANT_MARKER, strip_space

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
SYSTEM_MARKER = "<|im_start|>system\n"
_OPEN_REPLY = ASSISTANT_MARKER + "\n"


@dataclass(frozen=True)
class Template:
    """A system turn (if any) and the text put in front of the question inside the user turn."""

    system: str | None = None
    user_prefix: str = ""

    @property
    def prefix(self) -> str:
        system_turn = "" if self.system is None else _turn("system", self.system)
        return f"{system_turn}{TURN_START}user\n{self.user_prefix}"

    @property
    def suffix(self) -> str:
        return TURN_END + _OPEN_REPLY


def _turn(role: str, content: str) -> str:
    return f"{TURN_START}{role}\n{content}{TURN_END}"


# The wording of each named prompt format.
TEMPLATES = {
    "no_system": Template(),
    "standard": Template("You are a helpful assistant."),
    "cot": Template(
        "You are a helpful assistant. Please think step by step and show your work. "
        "Put your final answer within \\boxed{}."
    ),
    "cot_short": Template(
        "You are a helpful assistant. Please think step by step and put your final answer within \\boxed{}."
    ),
    "cot_unboxed": Template("You are a helpful assistant. Please think step by step and show your work."),
    "standard_boxed": Template("You are a helpful assistant. Please put your final answer within \\boxed{}."),
    "cot_in_user": Template(
        None, "Please think step by step and show your work. Put your final answer within \\boxed{}.\n\n"
    ),
}


def template_for(use_system: bool = True, use_cot: bool = False) -> str:
    """The template name behind the two prompt switches."""
    if use_system:
        return "cot" if use_cot else "standard_boxed"
    return "cot_in_user" if use_cot else "no_system"


def format_prompt(question: Column, template: str = "standard") -> Column:
    """The rendered prompt. The question is concatenated, so braces in it stay as they are."""
    t = TEMPLATES[template]
    return F.concat(F.lit(t.prefix), question, F.lit(t.suffix))


def literal_templates(rows: Sequence[tuple[str | None, str, str]]) -> Column:
    """A literal array of ``(config, prefix, suffix)``, to explode against samples without a join."""
    names = ("config", "prefix", "suffix")
    structs = [F.struct(*[F.lit(value).cast("string").alias(name) for name, value in zip(names, row)]) for row in rows]
    return F.array(*structs).cast("array<struct<config: string, prefix: string, suffix: string>>")


def template_array(names: list[str] | None = None) -> Column:
    """The built-in templates of these names, all of them by default."""
    return literal_templates([(name, TEMPLATES[name].prefix, TEMPLATES[name].suffix) for name in (names or list(TEMPLATES))])


def build_messages(question: Column, system_prompt: str | None = None) -> Column:
    """A message list: the system turn when one is given, then the question as user turn."""
    turns = [("system", F.lit(system_prompt))] if system_prompt else []
    turns.append(("user", question))
    return F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in turns])


def render_chat(messages: Column) -> Column:
    """The prompt text of a message list, with the reply turn opened at its end."""
    turns = F.transform(
        messages,
        lambda m: F.concat(F.lit(TURN_START), m["role"], F.lit("\n"), m["content"], F.lit(TURN_END)),
    )
    return F.concat(F.array_join(turns, ""), F.lit(_OPEN_REPLY))


def extract_system_prompt(prompt: Column) -> Column:
    """The stripped system text of a rendered prompt, NULL when there is no system turn."""
    regex = r"(?s)<\|im_start\|>system\n(.*?)<\|im_end\|>"
    return F.when(F.rlike(prompt, F.lit(regex)), strip_space(F.regexp_extract(prompt, regex, 1)))
