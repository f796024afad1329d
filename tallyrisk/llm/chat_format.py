"""Chat formatting [native]: a role automaton and a declarative template, in DataFrame functions only.

``turn_order`` runs a finite-state machine over the roles of each conversation.  The state after a
turn is the turn's role, so a transition is the pair (previous role, role) and needs one look back.
``format_chats`` writes each conversation as one text and as a list of segments with loss flags, and
``read_chats`` reads the text back.

The template marks turns with control strings.  Inside texts and roles these strings are escaped: the
escape character becomes ``\\0`` and control string number i becomes ``\\i``, so an escaped text holds no
control string and the mapping can be undone.  The end mark must not overlap itself (no proper prefix
of it is also its suffix), so the first end mark after a text is always the true one.

Defined results: a null text is the empty text and a null role the empty role; turns are ordered by
(turn, role, text) with null turns first; repeated rows are repeated turns; a null conv_id is a
conversation of its own; an empty table gives an empty result; extra columns are ignored.  A conversation that
breaks the turn order is formatted too and marked ``valid = false``.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Turn = open + role + sep + text + close; ``controls`` are escaped inside roles and texts."""
    open: str = "### "
    sep: str = ": "
    close: str = "</turn>\n"
    controls: tuple[str, ...] = ("###", "</turn>")
    role_controls: tuple[str, ...] = ("###", "</turn>", ":")
    role_names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User",
                                                                "assistant": "Assistant"})
    loss_roles: tuple[str, ...] = ("assistant",)
    escape: str = "\\"

    def __post_init__(self):
        assert len(self.role_controls) <= 8 and set(self.controls) <= set(self.role_controls)
        end = next(c for c in self.controls if self.close.startswith(c))
        assert not any(end.endswith(end[:i]) for i in range(1, len(end))), "the end mark overlaps itself"


#: Automaton of the turn order: state (previous role; "" at the start) to the roles allowed next, and final states.
TRANSITIONS = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
FINAL = ("assistant",)


def escaped(col: Column, controls: tuple[str, ...], template: Template) -> Column:
    e = template.escape
    col = F.replace(col, F.lit(e), F.lit(e + "0"))
    for c in controls:
        col = F.replace(col, F.lit(c), F.lit(f"{e}{template.role_controls.index(c) + 1}"))
    return col


def unescaped(col: Column, controls: tuple[str, ...], template: Template) -> Column:
    e = template.escape
    for c in controls:
        col = F.replace(col, F.lit(f"{e}{template.role_controls.index(c) + 1}"), F.lit(c))
    return F.replace(col, F.lit(e + "0"), F.lit(e))


def _role_out(role: Column, template: Template) -> Column:
    """A role's written form: its display name, or the escaped role behind ``\\9`` if it has none."""
    out = F.concat(F.lit(template.escape + "9"), escaped(role, template.role_controls, template))
    for k, v in template.role_names.items():
        out = F.when(role == k, v).otherwise(out)
    return out


def _role_in(written: Column, template: Template) -> Column:
    out = unescaped(F.substr(written, F.lit(len(template.escape) + 2)), template.role_controls, template)
    for k, v in template.role_names.items():
        out = F.when(written == v, k).otherwise(out)
    return out


def turn_order(turns: Column) -> Column:
    """True where the roles of an ordered array of turns are accepted by the automaton."""
    def step(state: Column, turn: Column) -> Column:
        allowed = reduce(or_, [(state == a) & (turn["role"] == b) for a, to in TRANSITIONS.items() for b in to])
        return F.when(allowed, turn["role"]).otherwise(F.lit("!"))

    return F.aggregate(turns, F.lit(""), step).isin(*FINAL)


def format_chats(df: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, valid, segments array<struct<text, loss>>, formatted: one row per conversation."""
    turns = df.select(F.col("conv_id"), F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                                 F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.open), _role_out(t["role"], template), F.lit(template.sep))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escaped(t["text"], template.controls, template).alias("text"),
                                t["role"].isin(*template.loss_roles).alias("loss")),
                       F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")))

    out = convs.select("conv_id", turn_order(F.col("turns")).alias("valid"),
                       F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_chats(formatted: Column, template: Template = Template()) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.split(F.substr(formatted, F.lit(1), F.length(formatted) - len(template.close)),
                     "\\Q" + template.close + "\\E")
    body = F.transform(pieces, lambda p: F.substr(p, F.lit(len(template.open) + 1)))

    def turn(p: Column) -> Column:
        at = F.instr(p, template.sep)
        return F.struct(_role_in(F.substr(p, F.lit(1), at - 1), template).alias("role"),
                        unescaped(F.substr(p, at + len(template.sep)), template.controls, template).alias("text"))

    return F.transform(body, turn)


def loss_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescaped(s["text"], template.controls, template)), "")


def digest(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """Digest columns of formatted conversations, all derived from the formatted text and its segments."""
    read = chats.select("conv_id", "valid", F.length("formatted").cast("long").alias("formatted_chars"),
                        read_chats(F.col("formatted"), template).alias("turns"),
                        loss_text(F.col("segments"), template).alias("loss"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(written, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "valid")
