"""Chat formatting from a declarative template, with a finite-state machine over roles.

All of it is DataFrame expressions. The template names the marks round a turn
and the roles trained on; the machine names the roles that may follow each
role. Where a role or text holds a mark, a backslash goes behind the mark's
first character (also where backslashes stand there already), and reading back
takes one away: texts without marks stay as they are, and all come back whole.

Per conversation: the formatted text, its segments (text, loss flag), whether
the order of roles is accepted, and the first turn at which it is not.

Rules for odd rows: a null text is empty; a null or unknown role is formatted
under its own name (null: empty) without loss and is not accepted; rows of one
turn number follow each other by role and text; a null turn comes first; a null
conv_id is a conversation of its own; repeated rows are kept. Extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Template:
    """Marks, loss by role, and the machine: roles that may follow a state (the last role; "" at the start).

    A turn is ``open role says text close``. No mark may end as it or another begins.
    """

    open: str = "<|turn|>"
    says: str = "<|says|>"
    close: str = "</s>"
    trained: tuple[str, ...] = ("assistant",)
    follow: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)


    def _marks(self, slashes: str) -> str:
        """The first character of a mark, if (so many) backslashes and the mark's rest follow."""
        marks = (self.open, self.says, self.close)
        return "(" + "|".join(f"{re.escape(m[0])}(?=\\\\{slashes}{re.escape(m[1:])})" for m in marks) + ")"

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self._marks("*"), r"$1\\")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self._marks("+") + r"\\", "$1")


def _accepted(role: Column, before: Column, template: Template) -> Column:
    moves = [(a, b) for a, after in template.follow.items() for b in after]
    moves = F.array(*[F.struct(F.lit(a).alias("from"), F.lit(b).alias("to")) for a, b in moves])
    return F.array_contains(moves, F.struct(before.alias("from"), role.alias("to")))


def format_chats(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, formatted, segments, accepted, first_bad_turn."""
    template = template or Template()
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def pieces(t: Column) -> Column:
        """Header without loss, body with the role's loss, end mark without."""
        header = F.concat(F.lit(template.open), template.escaped(t["role"]), F.lit(template.says))
        return F.array(
            F.struct(header.alias("text"), F.lit(False).alias("loss")),
            F.struct(template.escaped(t["text"]).alias("text"), t["role"].isin(*template.trained).alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
        )

    # The machine's state is the role before; a transition is looked up for every turn at once.
    roles = F.concat(F.array(F.lit("")), F.transform("turns", lambda t: t["role"]))
    steps = F.transform("turns", lambda t, i: _accepted(t["role"], F.get("roles", i), template))
    bad = F.array_position("steps", False)
    return (
        grouped.withColumn("roles", roles)
        .withColumn("steps", steps)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.flatten(F.transform("turns", pieces)).alias("segments"),
            ((bad == 0) & F.element_at("roles", -1).isin(*template.final)).alias("accepted"),
            F.when(bad > 0, F.get("turns", (bad - 1).cast("int"))["turn"]).alias("first_bad_turn"),
        )
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    )


def read_back(formatted: Column, template: Template) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    parts = F.split(formatted, re.escape(template.close), -1)
    body = F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.split(F.substr(p, F.lit(len(template.open) + 1)), re.escape(template.says), 2),
    )
    return F.transform(
        body,
        lambda p: F.struct(
            template.unescaped(F.get(p, F.lit(0))).alias("role"),
            template.unescaped(F.get(p, F.lit(1))).alias("text"),
        ),
    )


def read_loss(segments: Column, template: Template) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: template.unescaped(s["text"])), "")


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """The figures of the formatted text: read back from the marks and the loss mask, not from the source."""
    template = template or Template()
    turns = F.transform(
        read_back(F.col("formatted"), template),
        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
    )
    return (
        chats.withColumn("turns", turns)
        .withColumn("loss", read_loss(F.col("segments"), template))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.encode(F.array_join("turns", ""), "UTF-8"), 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
            "accepted",
            "first_bad_turn",
        )
    )
