"""Conversations as training texts with a loss mask, by relational operations only.

The turns of a conversation are collected as structs and sorted; neighbours of one role form one message, whose turns
stay apart by a mark; marks and texts are concatenated. Control strings inside texts get one more backslash behind
their first character than they have, which is undone by taking one away. The mask is a list of byte ranges of the
formatted text that hold what the assistant says.

A conversation of any length is put together in two steps: turns are collected in blocks of ``BLOCK`` turn numbers,
each formatted where it is collected, before the blocks of a conversation meet.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers whose turns are collected together first.
BLOCK = 256


@dataclass(frozen=True)
class Template:
    """Marks around messages. ``roles``: role -> (mark before, mark behind); other roles carry their name in a mark."""

    roles: tuple[tuple[str, str, str], ...] = (
        ("system", "<<SYS>>\n", "\n<</SYS>>\n"),
        ("user", "[INST] ", " [/INST]"),
        ("assistant", "<s> ", " </s>"),
    )
    other: tuple[str, str, str] = ("[ROLE]", "[AS]", "[/ROLE]")
    between: str = "[TURN]"
    learned: str = "assistant"

    def controls(self) -> list[str]:
        marks = [m for _, before, behind in self.roles for m in (before, behind)] + [*self.other, self.between]
        return sorted({mark.strip() for mark in marks})


def _between_first_and_rest(template: Template, inside: str) -> str:
    """A pattern for ``inside`` right behind the first character of a control string with any backslashes in it."""
    by_first: dict[str, list[str]] = {}
    for mark in template.controls():
        by_first.setdefault(mark[0], []).append(_quoted(mark[1:]))
    return "|".join(
        rf"(?<={_quoted(first)}){inside}(?=\\*(?:{'|'.join(rests)}))" for first, rests in sorted(by_first.items())
    )


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text).replace("\n", r"\n")


def escaped(text: Column, template: Template = Template()) -> Column:
    """Every control string, with or without backslashes behind its first character, gets one more there."""
    return F.regexp_replace(text, _between_first_and_rest(template, ""), r"\\")


def unescaped(text: Column, template: Template = Template()) -> Column:
    """One backslash less behind the first character of control strings that have any there."""
    return F.regexp_replace(text, _between_first_and_rest(template, r"\\"), "")


def _mark(role: Column, template: Template, at: int) -> Column:
    """The mark before (1) or behind (2) a message of a role."""
    before, middle, behind = template.other
    mark = F.concat(F.lit(before), escaped(role, template), F.lit(middle)) if at == 1 else F.lit(behind)
    for known in reversed(template.roles):
        mark = F.when(role == known[0], F.lit(known[at])).otherwise(mark)
    return mark


def _starts(lengths: str) -> Column:
    """Where each element of an array of lengths begins, counted in chunks so that long arrays stay cheap."""
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK),
    )

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda done, value: done + value)

    sums = F.transform(chunks, total)
    return F.flatten(
        F.transform(
            F.arrays_zip(chunks.alias("own"), F.transform(sums, lambda s, b: total(F.slice(sums, 1, b))).alias("base")),
            lambda c: F.transform(c["own"], lambda n, i: c["base"] + total(F.slice(c["own"], 1, i))),
        )
    )


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template = Template(),
) -> DataFrame:
    """Per conversation: conv, n_turns, formatted, loss (byte ranges: start, length).

    Turns are ordered by turn number, then by role and text; a null number comes first, repeated rows are repeated
    turns. A null text is an empty text, a null role the role without a name. Rows without conversation form one
    conversation, null. An empty table gives no rows. Further columns are not read.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        escaped(F.coalesce(F.col(text_col).cast("string"), F.lit("")), template).alias("body"),
    )
    block = F.floor(F.col("turn") / BLOCK).alias("block")
    rows = rows.groupBy("conv", block).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "body"))).alias("own"))
    rows = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "own"))).alias("blocks"))
    rows = rows.select("conv", F.flatten(F.transform("blocks", lambda b: b["own"])).alias("turns"))

    def piece(one: Column, i: Column) -> Column:
        before = F.get("turns", i - 1)["role"]
        after = F.get("turns", i + 1)["role"]
        opens = F.coalesce(before != one["role"], F.lit(True))
        closes = F.coalesce(after != one["role"], F.lit(True))
        return F.struct(
            F.when(opens, _mark(one["role"], template, 1)).otherwise(F.lit(template.between)).alias("pre"),
            one["body"].alias("body"),
            F.when(closes, _mark(one["role"], template, 2)).otherwise(F.lit("")).alias("post"),
            (one["role"] == template.learned).alias("learned"),
        )

    rows = rows.select("conv", F.transform("turns", piece).alias("pieces"))
    lengths = F.transform(
        "pieces", lambda p: (F.octet_length(p["pre"]) + F.octet_length(p["body"]) + F.octet_length(p["post"])).cast("long")
    )
    rows = rows.select("conv", "pieces", lengths.alias("lengths"))
    rows = rows.select("conv", "pieces", _starts("lengths").alias("starts"))
    ranges = F.transform(
        "pieces",
        lambda p, i: F.struct(
            p["learned"].alias("learned"),
            (F.get("starts", i) + F.octet_length(p["pre"])).alias("start"),
            F.octet_length(p["body"]).cast("long").alias("length"),
        ),
    )
    return rows.select(
        "conv",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["pre"], p["body"], p["post"])), "").alias("formatted"),
        F.transform(
            F.filter(ranges, lambda r: r["learned"]), lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"))
        ).alias("loss"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text, as structs of role and text: what ``format_conversations`` was given."""
    marks = [known[1] for known in template.roles] + [template.other[0]]
    messages = F.split(formatted, "(?=" + "|".join(_quoted(mark) for mark in marks) + ")")

    def turns(message: Column) -> Column:
        before, middle, behind = template.other
        name = F.substring_index(message, middle, 1)
        role = unescaped(F.substring(name, len(before) + 1, F.length(name)), template)
        body = F.substring(
            message, F.length(name) + 1 + len(middle), F.length(message) - F.length(name) - len(middle + behind)
        )
        for known, start, end in reversed(template.roles):
            begins = message.startswith(start)
            role = F.when(begins, F.lit(known)).otherwise(role)
            own = F.substring(message, F.lit(len(start) + 1), F.length(message) - len(start) - len(end))
            body = F.when(begins, own).otherwise(body)
        texts = F.split(body, _quoted(template.between))
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t, template).alias("text")))

    return F.flatten(F.transform(messages, turns))


def read_loss(formatted: str, loss: str, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, without anything between its ranges."""
    data = F.encode(formatted, "UTF-8")
    parts = F.transform(
        loss,
        lambda r: unescaped(
            F.decode(F.substring(data, (r["start"] + 1).cast("int"), r["length"].cast("int")), "UTF-8"), template
        ),
    )
    return F.array_join(parts, "")
