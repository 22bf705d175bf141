"""Conversations as training text, by a declarative template and a state machine over roles.

The template gives each role an opening, a closing and a loss flag, and the machine says
which role may follow which. A conversation becomes segments: opening, text, closing of
each turn; only the text of roles with the flag carries loss. Inside texts one backslash is
put after the first character of each control string (and of each one that already has
backslashes there), so that no text can open or close a turn and the change can be undone.

Built from DataFrame functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mark:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Control strings start with ``<`` or ``[`` and hold neither of the two after that start."""

    marks: dict[str, Mark]
    follows: dict[str, tuple[str, ...]]  # state -> roles allowed next; "" is the start
    final: tuple[str, ...]
    other: tuple[str, str] = ("[TURN=", " [/TURN]")  # marks of roles without a Mark
    controls: tuple[str, ...] = field(default=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[TURN=", "[/TURN]"))


TEMPLATE = Template(
    marks={
        "system": Mark("<<SYS>>", "<</SYS>>"),
        "user": Mark("[INST] ", " [/INST]"),
        "assistant": Mark("<s>", "</s>", loss=True),
    },
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",),
)


def _rests(template: Template) -> str:
    return "|".join(re.escape(c[1:]) for c in template.controls)


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_rests(template)})", r"$1$2\\$3")


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\({_rests(template)})", "$1$2$3")


def _by_role(role: Column, template: Template, pick, otherwise: Column) -> Column:
    """``pick(mark)`` of the role's mark."""
    out = None
    for name, mark in template.marks.items():
        out = (F if out is None else out).when(role == name, pick(mark))
    return out.otherwise(otherwise)


def _segments(turns: str, template: Template) -> Column:
    def of_turn(t: Column) -> Column:
        role = t["role"]
        opening = _by_role(
            role, template, lambda m: F.lit(m.opening), F.concat(F.lit(template.other[0]), F.url_encode(role), F.lit("] "))
        )
        closing = _by_role(role, template, lambda m: F.lit(m.closing), F.lit(template.other[1]))
        loss = _by_role(role, template, lambda m: F.lit(m.loss), F.lit(False))
        part = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
        return F.array(part(opening, F.lit(False)), part(escape(t["text"], template), loss), part(closing, F.lit(False)))

    return F.flatten(F.transform(turns, of_turn))


def _first_bad(turns: str, template: Template) -> Column:
    """Number (from 0) of the first turn whose role may not come there; the number of turns
    if the conversation ends in a state that is not final; NULL if all is in order."""
    table = F.create_map(
        *[F.lit(x) for state, roles in template.follows.items() for role in roles for x in (f"{state}\n{role}", role)]
    )
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, turn: Column) -> Column:
        allowed = F.try_element_at(table, F.concat(acc["state"], F.lit("\n"), turn["role"])).isNotNull()
        return F.struct(
            turn["role"].alias("state"),
            (acc["at"] + 1).alias("at"),
            F.coalesce(acc["bad"], F.when(~allowed, acc["at"])).alias("bad"),
        )

    def end(acc: Column) -> Column:
        return F.coalesce(acc["bad"], F.when(~acc["state"].isin(*template.final), acc["at"]))

    return F.aggregate(turns, start, step, end)


def format_chats(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = TEMPLATE,
) -> DataFrame:
    """One row per conversation: its key, ``segments`` (array of text and loss flag),
    ``formatted`` (their texts joined), ``valid`` and ``bad_turn`` (see ``_first_bad``).

    Every conversation is formatted, also one that breaks the order of roles; ``valid`` is
    then false. A role without a mark gets the general marks and no loss.

    - NULL role or text: empty. NULL turn: before all others. NULL conversation: one more group.
    - Equal turn numbers: by role, then text. Repeated rows stay, each as a turn of its own.
    - No rows: no rows. Other columns are not read, so their names cannot clash.

    A conversation is gathered in one row, as its text is one output value; Spark's limit of
    2 GB for a value is the limit for one conversation.
    """
    one = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    chats = rows.groupBy(F.col(f"`{conversation}`").alias(conversation)).agg(F.sort_array(F.collect_list(one)).alias("_turns"))
    return (
        chats.withColumns({"segments": _segments("_turns", template), "bad_turn": _first_bad("_turns", template)})
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .withColumn("valid", F.col("bad_turn").isNull())
        .drop("_turns")
    )


def read_back(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Array of (role, text) that a formatted conversation was made from."""
    openings = [m.opening for m in template.marks.values()] + [template.other[0]]
    parts = F.split(formatted, "(?=" + "|".join(re.escape(o) for o in openings) + ")")

    def turn(part: Column) -> Column:
        inner = lambda o, c: F.substring(part, F.lit(o + 1), F.length(part) - (o + c))
        head = F.length(F.regexp_extract(part, r"^\[TURN=[^\]]*\] ", 0))
        text = F.substring(part, head + 1, F.length(part) - head - len(template.other[1]))
        role = F.url_decode(F.regexp_extract(part, r"^\[TURN=([^\]]*)\] ", 1))
        for name, m in reversed(template.marks.items()):
            here = F.startswith(part, F.lit(m.opening))
            text = F.when(here, inner(len(m.opening), len(m.closing))).otherwise(text)
            role = F.when(here, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.transform(F.filter(parts, lambda p: p != ""), turn)


def loss_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
