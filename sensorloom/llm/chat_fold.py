"""Chat logs folded into training conversations, in DataFrame operations only.

A log has one row per event: which conversation, a sequence number, which message, what happened and a text.
``message`` opens a message with its role and first text, ``delta`` appends streamed text,
``edit`` replaces the text so far, ``regenerate`` discards it (the deltas after it are the new answer) and ``delete`` removes the message.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's control strings.
START, STOP = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


_LINE = "<|n|>"


def escaped(text: Column) -> Column:
    """No control string is left: a backslash comes between ``<`` and ``|``, one more where there are some already."""
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A turn's role ends at its first line end, so that a role's own are control strings."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(_LINE))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(_LINE), F.lit("\n")))


def folded(log: DataFrame, key: Sequence[str] = ("message",)) -> DataFrame:
    """(conv_id, key, first, role, text) from (conv_id, seq, key, event, role, text): the messages as they stand at the end.

    ``key`` are the columns that name a message within its conversation.
    A null text is empty, a null role an empty role. Events that are no known kind change nothing. A message without
    a ``message`` event has an empty role. Equal sequence numbers are taken in the order of event and text. A repeated row counts as often as it stands.
    Events are dealt once, by message. A window, which spills, tells each event whether later ones discard it, so only the text
    that stays is gathered, per message and never per conversation. A log that is dealt by some of these columns is not dealt again.
    """
    by = ["conv_id", *key]
    # A message's own row comes first of those of the same number.
    rank = F.when(F.col("event") == "message", 0).when(F.col("event") == "delta", 2).otherwise(1)
    d = log.where(F.col("event").isin("message", "delta", "edit", "regenerate", "delete")).select(
        *by, "event", F.struct(F.col("seq"), rank.alias("rank")).alias("at"), "role", F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy(*by)
    opened = F.when(F.col("event") == "message", F.struct("at", F.coalesce("role", F.lit("")).alias("role")))
    d = d.select(
        *by, "at", "event", "text", F.min("at").over(w).alias("first"), F.min(opened).over(w)["role"].alias("role"),
        F.max(F.when(F.col("event").isin("edit", "regenerate"), F.col("at"))).over(w).alias("cut"), F.max(F.col("event") == "delete").over(w).alias("gone"))
    stays = (F.col("cut").isNull() | (F.col("at") >= F.col("cut"))) & (F.col("event") != "regenerate")
    # A regenerated message may have no text yet, so its first event stays without one.
    d = d.where(~F.col("gone") & (stays | (F.col("at") == F.col("first"))))
    parts = F.array_sort(F.collect_list(F.when(stays, F.struct("at", "text"))))
    d = d.groupBy(*by).agg(F.min("first").alias("first"), F.min("role").alias("role"), parts.alias("parts"))
    return d.select(*by, "first", F.coalesce("role", F.lit("")).alias("role"), F.concat_ws("", "parts.text").alias("text"))


def render(messages: DataFrame, key: Sequence[str] = ("message",)) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans): one string per conversation in order of ``first`` and ``key``.

    A turn is start mark, role, line end, text, stop mark, line end, with role and text escaped.
    ``loss_spans`` are the (begin, size) of the assistants' texts in code points of ``formatted``; places are running sums over the sorted turns.
    A conversation is one string, so its size bounds the memory of the task that joins it; its turns arrive one by one, in any order.
    """
    text = escaped(F.col("text"))
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    turns = messages.select("conv_id", "first", *key, F.struct(
        F.concat(head, text, F.lit(STOP + "\n")).alias("turn"), F.length(head).alias("head"), F.length(text).alias("size"), (F.col("role") == LEARNED).alias("learned")).alias("_t"))
    before = Window.partitionBy("conv_id").orderBy("first", *key).rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("_t.turn")).over(before), F.lit(0))
    d = turns.select("conv_id", F.struct(at.cast("long").alias("at"), "_t.*").alias("t"))
    d = d.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    learned = F.filter("ts", lambda t: t["learned"])
    return d.select(
        "conv_id", F.size("ts").cast("long").alias("n_turns"), F.concat_ws("", "ts.turn").alias("formatted"),
        F.transform(learned, lambda t: F.struct((t["at"] + t["head"]).alias("begin"), t["size"].alias("size"))).alias("loss_spans"))


def turns_of(formatted: Column) -> Column:
    """The array of (role, text) that a formatted string holds."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    turn = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
    return F.transform(turn, lambda t: F.struct(
        unescaped_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescaped(_body(t)).alias("text")))


def _body(turn: Column) -> Column:
    """What stands between the first line end and the stop mark with its line end."""
    begin = F.instr(turn, "\n") + 1
    return F.substring(turn, begin, F.length(turn) - begin + 1 - len(STOP) - 1)


def learned_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped span by span."""
    return F.concat_ws("", F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["begin"] + 1).cast("int"), s["size"]))))


def format_log(log: DataFrame, key: Sequence[str] = ("message",)) -> DataFrame:
    """``render`` of ``folded``. An empty log gives an empty result; further columns of the log are ignored."""
    return render(folded(log, key), key)


#: The columns that name a message in the log of a table.
MESSAGE = ("turn", "message")


def log_of(conversations: DataFrame, piece: int = 400) -> DataFrame:
    """The log that a table (conv_id, turn, role, text) stands for: each row opens a message and streams its text in pieces.

    A message is named by ``MESSAGE``. Rows with the same turn are messages of their own, in the order of role and text's hash.
    Rows are dealt once by conversation and turn, and numbered, cut and, by ``folded``, put together where they are.
    """
    d = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.repartition("conv_id", "turn").withColumn("hash", F.unhex(F.md5("text")))
    # Equal rows: one message each, told apart by a number; in which order they get it makes no difference.
    same = Window.partitionBy("conv_id", "turn", "role", "hash").orderBy("hash")
    message = F.struct("role", "hash", F.row_number().over(same).alias("copy"))
    d = d.select("conv_id", "turn", "role", "text", message.alias("message"))
    last = F.greatest(F.ceil(F.length("text") / piece), F.lit(1)).cast("int")
    d = d.withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
    opened = F.col("_piece") == 0
    return d.select(
        "conv_id", "turn", (F.coalesce("turn", F.lit(-1)) * (1 << 32) + F.col("_piece")).alias("seq"), "message",
        F.when(opened, "message").otherwise("delta").alias("event"), F.when(opened, F.col("role")).alias("role"),
        F.when(~opened, F.substring(F.col("text"), (F.col("_piece") - 1) * piece + 1, F.lit(piece))).alias("text"))
