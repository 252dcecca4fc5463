"""Chat formatting from event logs, in DataFrame functions only.

A log holds events of messages: a ``delta`` adds text to its message, an ``edit`` puts its text in
place of what stood there, a ``regenerate`` empties the message so that later deltas write it anew.
Events are dealt by conversation, folded in their sequence into final messages, and rendered.

A turn is rendered as ``<s>[INST] role [/INST] text</s>``. A control string inside a role or text gets
one more backslash behind its first character, which reading takes away again; so every text comes
back as it was, one that already holds such an escaped string too. A conversation is one row of the
output, so its messages meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import let

DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
TRAINED = "assistant"
#: Characters of a delta that a finished text is cut into.
DELTA_CHARS = 512
#: Messages of a conversation have numbers below this in a log made of finished turns.
_SEQUENCE = 1 << 24


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(/?s>|/?INST\])", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(/?s>|/?INST\])", "$1$2$3")


def log_of(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The event log (conv_id, seq, message, kind, role, text) of finished turns, each text in deltas.

    Turns are numbered in order of ``turn``, then role and text; equal rows are messages of their
    own. A null role or text counts as empty, null turns come first.
    """
    rows = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    # one pass over a text cuts it, however long it is; an empty one is one empty delta
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0))
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    rows = rows.select("conv_id", "role", "message", F.posexplode_outer(cut).alias("part", "text"))
    return rows.select("conv_id", (F.col("message") * _SEQUENCE + F.coalesce("part", F.lit(0))).alias("seq"), "message", F.lit(DELTA).alias("kind"),
                       "role", F.coalesce("text", F.lit("")).alias("text"))


def folded(log: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final messages of a log.

    The role is that of the message's first event. What stands before the last edit or regeneration
    of a message is dropped before anything is gathered. Null texts count as empty, unknown kinds
    as deltas; events with equal ``seq`` are taken by kind, then text. The text of a regeneration is its first delta.
    """
    mine = Window.partitionBy("conv_id", "message")
    reset = F.max(F.when(F.col("kind").isin(EDIT, REGENERATE), F.col("seq"))).over(mine)
    role = F.coalesce(F.first("role", ignorenulls=True).over(mine.orderBy("seq", "kind", "text").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(""))
    live = log.withColumn("reset", reset).withColumn("role", role).where("reset IS NULL OR seq >= reset")
    pieces = F.array_sort(F.collect_list(F.struct("seq", F.coalesce("kind", F.lit(DELTA)).alias("kind"),
                                                  F.coalesce("text", F.lit("")).alias("text"))))
    return live.groupBy("conv_id", "message").agg(F.first("role").alias("role"), pieces.alias("pieces")).select(
        "conv_id", "message", "role", F.array_join(F.col("pieces.text"), "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the text of every conversation and the stretches to train on.

    ``loss`` has, for every assistant text, its turn (from 0), its place in the rendered turn, its place in
    ``formatted`` and its length, all in code points from 0.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    rows = messages.withColumn("head", head).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("chars", F.char_length("head") + F.char_length("body") + len(CLOSE))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("chars").over(before), F.lit(0)) + F.char_length("head"))
    turn = F.struct("message", F.concat("head", "body", F.lit(CLOSE)).alias("shown"), (F.col("role") == TRAINED).alias("trained"),
                    F.char_length("head").alias("at"), "start", F.char_length("body").cast("long").alias("length"))
    spans = F.filter(F.transform("turns", lambda t, i: F.when(t["trained"], F.struct(i.alias("turn"), t["at"].alias("at"), t["start"].alias("start"),
                                                                                     t["length"].alias("length")))), lambda s: s.isNotNull())
    return (rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
            .select("conv_id", F.array_join(F.col("turns.shown"), "").alias("formatted"), spans.alias("loss")))


def formatted(log: DataFrame) -> DataFrame:
    """Conversations of an event log, rendered. An empty log gives no rows; a null conv_id is a conversation too."""
    return rendered(folded(log))


def parsed(output: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_texts) read back from rendered conversations.

    A text is cut into turns once, and what the mask covers is taken from its turn, so the work is linear in
    the length of a conversation.
    """
    def read(shown: Column) -> Column:
        cut = F.transform(shown, lambda t: F.split(F.substring(t, F.lit(len(OPEN) + 1), F.char_length(t)), r" \[/INST\] ", 2))
        turns = F.transform(cut, lambda t: F.struct(unescape(t[0]).alias("role"), unescape(t[1]).alias("text")))
        texts = F.transform("loss", lambda s: unescape(F.substring(F.get(shown, s["turn"]), s["at"] + 1, s["length"].cast("int"))))
        return F.struct(turns.alias("turns"), texts.alias("loss_texts"))

    # every turn closes, so what stands behind the last close is empty
    shown = F.split("formatted", CLOSE)
    back = let(F.slice(shown, 1, F.size(shown) - 1), read)
    return output.select("conv_id", "formatted", back.alias("back")).select("conv_id", "formatted", "back.*")
