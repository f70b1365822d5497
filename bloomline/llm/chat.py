"""Chat formatting: a finite-state machine over roles checks turn order; a declarative template writes text segments
with loss flags (DataFrame functions only). A conversation becomes one row, so its turns meet in one task.

Every turn is written as ``opener + " " + text + " " + closer``. Inside a text each control string gets one backslash in
front; a control string of the template always follows a space or the start, never a backslash, so reading back is
exact: split at unescaped control strings, then take that one backslash away.

Defined results: turns are ordered by (turn, role, text), nulls first; repeated rows stay; null text is empty and null
role is the empty role; roles that the template does not name are written by its generic marker, whose text starts with
the role's length and a line break, then the escaped role and text; rows with null conversation id form one conversation; an empty table gives none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """markers: role -> (opener, closer); loss: roles under the loss mask; moves: state -> {role: next state}."""

    markers: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    other: tuple[str, str] = ("<<TURN>>", "<</TURN>>")
    loss: frozenset[str] = frozenset({"assistant"})
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "ready", "user": "asked"},
            "ready": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    accepting: frozenset[str] = frozenset({"asked", "answered"})

    def controls(self) -> list[str]:
        return [c for pair in [*self.markers.values(), self.other] for c in pair]

    def pattern(self) -> str:
        return "|".join(re.escape(c).replace("/", "/") for c in self.controls())


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, f"({template.pattern()})", r"\\$1")


def unescape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, rf"\\({template.pattern()})", "$1")


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    entries = [F.lit(x) for kv in pairs.items() for x in kv]
    return F.try_element_at(F.create_map(*entries), key)


def format_chats(
    turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, bad_turn (place of the first refused turn, from 0),
    segments array<struct<text, loss>> and formatted, their concatenation."""
    t = template or Template()
    turn = F.struct(
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    convs = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )
    moves = {f"{state}>{role}": to for state, m in t.moves.items() for role, to in m.items()}

    def step(acc: Column, x: Column) -> Column:
        to = _lookup(moves, F.concat(acc.state, F.lit(">"), x.role))
        alive = acc.bad.isNull()
        return F.struct(
            F.when(alive & to.isNotNull(), to).otherwise(acc.state).alias("state"),
            F.when(alive & to.isNull(), acc.n).otherwise(acc.bad).alias("bad"),
            (acc.n + 1).alias("n"),
        )

    start = F.struct(F.lit("start").alias("state"), F.lit(None).cast("int").alias("bad"), F.lit(0).alias("n"))
    end = F.aggregate("turns", start, step)

    def written(x: Column) -> Column:
        known = x.role.isin(*t.markers)
        opener = F.coalesce(_lookup({r: m[0] for r, m in t.markers.items()}, x.role), F.lit(t.other[0]))
        closer = F.coalesce(_lookup({r: m[1] for r, m in t.markers.items()}, x.role), F.lit(t.other[1]))
        # A role may hold any character, line breaks too: its length says where the text begins.
        body = F.when(known, escape(x.text, t)).otherwise(
            escape(F.concat(F.length(x.role).cast("string"), F.lit("\n"), x.role, x.text), t)
        )
        segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            segment(F.concat(opener, F.lit(" ")), F.lit(False)),
            segment(body, x.role.isin(*t.loss)),
            segment(F.concat(F.lit(" "), closer), F.lit(False)),
        )

    return convs.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        end.alias("fsm"),
        F.flatten(F.transform("turns", written)).alias("segments"),
    ).select(
        "conv_id",
        "n_turns",
        (F.col("fsm.bad").isNull() & F.col("fsm.state").isin(*t.accepting)).alias("valid"),
        F.col("fsm.bad").alias("bad_turn"),
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
    )


def read_chats(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Adds turns array<struct<role, text>> parsed from formatted, and loss_text, the unescaped text under the mask."""
    t = template or Template()
    openers = {m[0]: r for r, m in t.markers.items()}
    alt = lambda xs: "|".join(re.escape(x) for x in xs)
    piece = (
        rf"(?s)(?<!\\)({alt([*openers, t.other[0]])}) (.*?) "
        rf"(?:{alt([*(m[1] for m in t.markers.values()), t.other[1]])})"
    )
    marks, bodies = (F.regexp_extract_all("formatted", F.lit(piece), F.lit(k)) for k in (1, 2))

    def turn(mark: Column, body: Column) -> Column:
        text, role = unescape(body, t), _lookup(openers, mark)
        cut = F.instr(text, "\n")
        size = F.substring(text, F.lit(1), cut - 1).try_cast("int")
        return F.struct(
            F.coalesce(role, F.substring(text, cut + 1, size)).alias("role"),
            F.when(role.isNotNull(), text).otherwise(F.substring(text, cut + 1 + size, F.length(text))).alias("text"),
        )

    masked = F.filter("segments", lambda s: s.loss)
    return formatted.withColumns(
        {
            "turns": F.zip_with(marks, bodies, turn),
            "loss_text": F.array_join(F.transform(masked, lambda s: unescape(s.text, t)), ""),
        }
    )
