"""Conversations as marked-up text from a declarative template, with a loss flag on each segment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around a turn, the roles whose text bears loss, and the turn order as a state machine.

    The state is the role of the turn before (``start`` before the first); ``follows`` lists the roles that
    may come next in each state, ``ends`` the states a conversation may end in.
    """

    turn_start: str = "<|im_start|>"
    header_end: str = "\n"
    turn_end: str = "<|im_end|>"
    turn_gap: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant", "tool"),
    })
    ends: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    """No ``<|`` is left: a backslash goes between, one more where there are some already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Roles stand on a line of their own: ``%``, line feeds and ``<`` become percent codes."""
    for plain, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def turns(rows: DataFrame, template: ChatTemplate) -> DataFrame:
    """One row per turn, in place, with the state machine's verdict on it (``allowed``).

    Rows are ordered by turn, then role, then text; null turns come first, a null role or text is an empty
    string. A window streams each conversation in order, so none is held in memory here.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    kept = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
    state = F.coalesce(F.lag("role").over(order), F.lit(START))
    steps = F.create_map(*[c for s, nxt in template.follows.items() for c in (F.lit(s), F.array(*map(F.lit, nxt)))])
    return (kept.withColumn("place", F.row_number().over(order))
            .withColumn("allowed", F.coalesce(F.array_contains(F.try_element_at(steps, state), F.col("role")), F.lit(False))))


def segments(role: Column, text: Column, template: ChatTemplate) -> Column:
    """The three text segments of a turn; only the middle one, of a loss role, bears loss."""
    part = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    return F.array(
        part(F.concat(F.lit(template.turn_start), escape_role(role), F.lit(template.header_end)), no),
        part(escape(text), role.isin(*template.loss_roles)),
        part(F.lit(template.turn_end + template.turn_gap), no))


def format_chats(rows: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """``(conv_id, segments, valid)`` of every conversation; the formatted text is all segments in order.

    ``valid``: every turn was allowed and the last one may end a conversation. Conversations in a wrong
    order are formatted all the same. A conversation is one value, as its text has to be, so its turns meet
    in one row; nothing else is gathered. Null ids form one conversation.
    """
    t = template or ChatTemplate()
    marked = turns(rows, t).select("conv_id", F.struct("place", "allowed", "role", segments(
        F.col("role"), F.col("text"), t).alias("segments")).alias("turn"))
    whole = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    last = F.element_at("turns", -1)["role"]
    return whole.select(
        "conv_id", F.flatten(F.col("turns.segments")).alias("segments"),
        (F.forall("turns", lambda x: x["allowed"]) & last.isin(*t.ends)).alias("valid"))


def formatted(parts: Column) -> Column:
    """The formatted text of a segment array."""
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def parse(text: Column, template: ChatTemplate | None = None) -> Column:
    """Turns ``array<struct<role, text>>`` read back from formatted text alone."""
    t = template or ChatTemplate()
    # Control strings are escaped in roles and texts, so splitting finds the turns.
    cut = F.split(text, _literal(t.turn_start))
    pieces = F.slice(cut, F.lit(2), F.size(cut))
    tail = len(t.turn_end + t.turn_gap)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, t.header_end, 1)
        skip = F.char_length(head) + len(t.header_end)
        body = F.substring(p, skip + 1, F.char_length(p) - skip - tail)
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def loss_text(parts: Column) -> Column:
    """All text that bears loss, unescaped, in order."""
    return F.array_join(F.transform(F.filter(parts, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def _literal(mark: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and c != "_" else c for c in mark)
