"""Chat formatting from an event log, with DataFrame functions only.

The log of a conversation is its events in sequence. A message begins with its first event;
deltas append to it, an edit replaces its text, and a regeneration throws its text away so
that later deltas build it anew. Folded messages, in the order in which they began, are
rendered by a template that marks turns and escapes its own control strings inside texts.

Template, for each turn:  <s>[INST] role [/INST] text </s>
Escapes, reversed in opposite order:  & to &amp;  < to &lt;  [ to &#91;
No raw < or [ is left in a role or text, so marks cannot be forged and splitting is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The marks of the template and its escapes.
OPEN, ROLE_END, CLOSE = "<s>[INST] ", " [/INST] ", " </s>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))

EVENTS = "conv_id, seq, message, kind, role, text"
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def fold_messages(events: DataFrame) -> DataFrame:
    """(conv_id, began, message, role, text) of the final messages of a log with the columns EVENTS.

    Events of a message fold by seq, ties by kind and text; a null text counts as empty. The
    text is that of the events from the last message, edit or regenerate event on, one
    after the other; a regenerate event adds none. The role is that of the message's first
    event; null counts as empty. A message is gathered into one row, as its text is.
    """
    event = F.struct(F.col("seq"), F.col("kind"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    whole = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    last = F.greatest(F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != DELTA, i).otherwise(F.lit(0)))), F.lit(0))
    live = F.slice("log", last + 1, F.size("log"))
    text = F.array_join(F.transform(live, lambda e: F.when(e["kind"] == REGENERATE, F.lit("")).otherwise(e["text"])), "")
    return whole.select("conv_id", "message", F.col("log")[0]["seq"].alias("began"), F.col("log")[0]["role"].alias("role"), text.alias("text"))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, loss_spans) for each conversation of fold_messages().

    loss_spans are (start, length) in code points of formatted, from 0: the escaped texts of the
    roles in loss_roles, in order. Messages that began together are ordered by message.
    """
    order = Window.partitionBy("conv_id").orderBy("began", "message")
    turn = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(ROLE_END), escape(F.col("text")), F.lit(CLOSE))
    parts = messages.select("conv_id", "began", "message", "role", turn.alias("turn"), F.char_length(escape(F.col("text"))).cast("long").alias("n"))
    start = F.sum(F.char_length("turn")).over(order) - F.col("n") - len(CLOSE)
    parts = parts.withColumn("start", start).withColumn("loss", F.col("role").isin(*loss_roles))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("began", "message", "turn", "start", "n", "loss"))).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["n"].alias("length")))
    return whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), spans.alias("loss_spans"))


def format_chats(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), placed: bool = False) -> DataFrame:
    """Formatted conversations of a log: fold_messages() and render() under one shuffle by conversation.

    placed: events are partitioned by conv_id already, so that not even that is needed.

    Events with null conv_id make one conversation; repeated events each count; a log without
    events gives no rows. Other columns are ignored.
    """
    log = events.select(*(x.strip() for x in EVENTS.split(",")))
    return render(fold_messages(log if placed else log.repartition("conv_id")), loss_roles)


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.filter(pieces, lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), ROLE_END, 1)).alias("role"),
            unescape(F.substr(x, F.locate(ROLE_END, x) + len(ROLE_END))).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one span after the other."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The log of a table with a row for each turn: each row is a message of its own, also where rows repeat. Partitioned by conv_id."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.repartition("conv_id").select(
        "conv_id", F.col("turn").cast("long").alias("seq"), F.row_number().over(order).cast("long").alias("message"), F.lit(MESSAGE).alias("kind"), "role", "text"
    )


def chat_report(formatted: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted conversations."""
    read = formatted.select("conv_id", parse_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
