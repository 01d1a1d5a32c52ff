"""Chat formatting from event logs: fold events into messages, render, mask the loss.

DataFrame functions only. A conversation log has events of four kinds:

``message``     the whole text of a message; starts it, or replaces what was there
``delta``       more text, appended to the message
``edit``        replaces the message's text
``regenerate``  drops the message's text; deltas after it stream the new one

A message is the text of its last ``message``, ``edit`` or ``regenerate`` (or
of nothing) followed by the deltas after that.

A message renders as ``<turn>ROLE\\nTEXT</turn>\\n``. In role and text ``\\``
becomes ``\\b`` and ``<`` becomes ``\\l``; in a role a line feed becomes
``\\n``. So no text can hold a turn mark, and the mapping has an inverse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template.
OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """One row per message: ``conv_id``, ``message_id``, ``first_seq``, ``role``, ``text``.

    ``events``: conv_id, message_id, seq, kind, role, text. Grouping is by
    (conversation, message), so a conversation with very many events is spread
    over the tasks. Null text is empty. Events with equal seq are ordered by
    kind, then text. The role is that of the message's first event. An event
    of an unknown or null kind counts as ``message``. Null ids group together.
    """
    event = F.struct(
        F.col("seq"),
        F.coalesce(F.col("kind"), F.lit("message")).alias("kind"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
    )
    log = events.groupBy("conv_id", "message_id").agg(F.array_sort(F.collect_list(event)).alias("log"))
    # The last event that sets the text anew; everything before it is history.
    last = F.aggregate(
        F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(F.lit(0))),
        F.lit(0),
        lambda a, i: F.greatest(a, i),
    )
    live = F.slice(F.col("log"), last + 1, F.size("log") - last)
    text = F.array_join(F.transform(live, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"])), "")
    return log.select(
        "conv_id",
        "message_id",
        F.col("log")[0]["seq"].alias("first_seq"),
        F.col("log")[0]["role"].alias("role"),
        text.alias("text"),
    )


def format_conversations(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``segments``, an array of (text, loss).

    The formatted conversation is the segments' texts one after the other; the
    loss mask covers the segments with ``loss`` set, which are exactly the
    escaped texts of messages whose role is in ``loss_roles``.

    Messages are in the order of their first event's seq, then role, then
    text; null seqs come first. A conversation is one output value, so its
    messages meet in one row by nature; its events don't (:func:`fold_events`).
    Conversations with a null id form one conversation. No events, no rows.
    """
    messages = fold_events(events)
    body = F.struct("first_seq", "role", "text")
    whole = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(body)).alias("messages"))
    segments = F.flatten(
        F.transform(
            "messages",
            lambda m: F.array(
                F.struct(F.concat(F.lit(OPEN), escape_role(m["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(m["text"]).alias("text"), m["role"].isin(*loss_roles).alias("loss")),
                F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    return whole.select("conv_id", segments.alias("segments"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))


def parse_turns(formatted: Column) -> Column:
    """An array of (role, text) read back from the formatted text alone."""
    parts = F.filter(F.split(formatted, F.lit(CLOSE)), lambda p: p != "")
    inner = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.replace(inner(p), F.lit(OPEN), F.lit(""))).alias("role"),
            unescape(F.substring(p, F.length(inner(p)) + 2, F.length(p))).alias("text"),
        ),
    )
