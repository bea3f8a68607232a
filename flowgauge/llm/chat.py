"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BROKEN = "start", "broken"


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are learned, and which role may follow which state.

    A turn is opening + role + after_role + text + closing. States are roles, besides ``start``. The control strings must
    begin with ``<|``, which escaping keeps out of texts.
    """

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    turns: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )


def escaped(text: Column) -> Column:
    """Texts in which ``<|`` cannot occur: a backslash is put between ``<``, any backslashes, and ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    """The exact inverse of ``escaped``."""
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def format_chats(
    rows: DataFrame,
    template: Template = Template(),  # noqa: B008
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments, state, first_bad_turn.

    ``segments`` are (text, loss) in order and concatenate to ``formatted``; only texts of learned roles bear loss.
    ``state`` is the state after the last turn, or ``broken`` if a role came that the state before it does not allow;
    ``first_bad_turn`` is that turn's 0-based position, else null. Broken conversations are formatted all the same: the
    caller decides.

    Turns are ordered by turn, role and text, nulls first, so ties and repeated rows have a fixed order and are all kept.
    Null texts and roles are empty ones; roles are written url-encoded, so any role can be read back. Null conversation
    ids form one conversation. No rows give no rows; other columns are not read. A conversation is one value by nature
    and is held by one task; the number of conversations is not.
    """
    slim = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    chats = slim.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    allowed = [f"{state}\n{r}" for state, roles in template.turns.items() for r in roles]

    def step(seen: Column, row: Column) -> Column:
        after = F.concat(seen["state"], F.lit("\n"), row["role"])
        good = (seen["state"] != BROKEN) & after.isin(allowed)
        return F.struct(
            F.when(good, row["role"]).otherwise(F.lit(BROKEN)).alias("state"),
            (seen["n"] + 1).alias("n"),
            F.when((seen["state"] != BROKEN) & ~good, seen["n"]).otherwise(seen["bad"]).alias("bad"),
        )

    first = F.struct(F.lit(START).alias("state"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("bad"))

    def piece(content: Column, loss: Column | bool) -> Column:
        return F.struct(content.alias("text"), (loss if isinstance(loss, Column) else F.lit(loss)).alias("loss"))

    segments = F.flatten(
        F.transform(
            "rows",
            lambda r: F.array(
                piece(F.concat(F.lit(template.opening), F.url_encode(r["role"]), F.lit(template.after_role)), False),
                piece(escaped(r["text"]), r["role"].isin(list(template.learned))),
                piece(F.lit(template.closing), False),
            ),
        )
    )
    walked = chats.select("conv_id", segments.alias("segments"), F.aggregate("rows", first, step).alias("fsm"))
    return walked.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.col("fsm.state").alias("state"),
        F.col("fsm.bad").alias("first_bad_turn"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:  # noqa: B008
    """The (role, text) turns of a formatted conversation, parsed back from it."""
    parts = F.split(formatted, _literal(template.opening), -1)
    parts = F.slice(parts, F.lit(2), F.size(parts))

    def turn(part: Column) -> Column:
        cut = F.locate(template.after_role, part)
        body = part.substr(cut + len(template.after_role), F.length(part))
        body = body.substr(F.lit(1), F.length(body) - len(template.closing))
        return F.struct(F.url_decode(part.substr(F.lit(1), cut - 1)).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def learned_texts(segments: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"]))


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"
