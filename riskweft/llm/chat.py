"""Chat formatting from an event log.

Events of a conversation stand by `seq`. A message is built from its events:
`message` and `edit` set its whole text, `regenerate` empties it, `delta`
appends to it, `delete` withdraws it until a later event sets it again. So a
message is what its last setting event and the deltas after it say. Messages
are then rendered, one turn each, by a template whose control strings are
escaped inside texts and roles, so the output can be read back exactly.

Everything is DataFrame expressions. Events are first grouped by message,
messages by runs of TURN_RUN message numbers, and only the runs by
conversation: a conversation with very many turns arrives as few large rows.

Nulls: a null text or role is empty; a null conv_id is a conversation of its
own; a null event type is `message`. Events of one message with equal seq
stand by event type (in the order named above) and text, repeated events
count each. An empty log gives no conversation. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
TURN_RUN = 64
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """No '#' and no '</turn>' is left; a backslash always starts one of three pairs."""
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("#"), F.lit("\\h"))
    return F.replace(text, F.lit("</turn>"), F.lit("\\l/turn>"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as a log of `message` events; every row, repeated ones too, is a message of its own."""
    same = Window.partitionBy("conv_id", "turn", "role", "text").orderBy(F.lit(1))
    return turns.select("conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").alias("seq"), F.col("turn").alias("msg"),
        F.concat_ws("\n", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")), F.row_number().over(same).cast("string")).alias("sub"),
        "role", F.lit("message").alias("event"), "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """conv_id, seq, msg, sub, role, event, text -> one row per message that still stands: conv_id, msg, sub, role, text.

    msg orders the messages of a conversation, sub those of one msg; sub may be absent.
    """
    if "sub" not in events.columns:
        events = events.withColumn("sub", F.lit(""))
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in (("message", 0), ("edit", 1), ("regenerate", 2), ("delta", 3), ("delete", 4)) for x in pair]), F.col("event"))
    rows = events.select(
        "conv_id", "msg", "sub", "role", F.coalesce("event", F.lit("message")).alias("event"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("seq", F.lit(0)).alias("seq")
    )
    rows = rows.withColumn("at", F.struct("seq", F.coalesce(rank, F.lit(0)).alias("rank"), "text"))
    message = ["conv_id", "msg", "sub"]
    one = Window.partitionBy(*message)
    set_at = F.max(F.when(F.col("event") != "delta", F.col("at"))).over(one)
    rows = rows.withColumn("set_at", set_at).where("set_at IS NULL OR at >= set_at")
    pieces = F.array_sort(F.collect_list(F.when(F.col("event").isin("message", "edit", "delta"), F.struct("at"))))
    set_kind = F.max("set_at")["rank"]
    folded = rows.groupBy(*message).agg(
        F.coalesce(F.min_by("role", F.struct("at", "role")), F.max("role"), F.lit("")).alias("role"),
        F.array_join(F.transform(pieces, lambda x: x["at"]["text"]), "").alias("text"),
        F.max(F.when(F.col("event") == "delta", 1)).alias("has_delta"), set_kind.alias("set_kind"),
    )
    return folded.where("set_kind IS NULL OR set_kind <> 4 OR has_delta = 1").select(*message, "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """conv_id, msg, sub, role, text -> conv_id, n_turns, parts, mask, formatted.

    formatted is the parts one after the other; mask says which parts are learned (the texts of the assistant).
    """
    text = escape(F.col("text"))
    turn = F.struct(
        F.col("msg"), F.col("sub"), F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(MIDDLE)).alias("head"),
        text.alias("text"), (F.col("role") == LEARNED_ROLE).alias("learned"),
    )
    run = F.coalesce(F.floor(F.col("msg") / TURN_RUN), F.lit(-1)).alias("run")
    runs = messages.groupBy("conv_id", run).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = F.flatten(F.transform("turns", lambda t: F.array(t["head"], t["text"], F.lit(CLOSE))))
    mask = F.flatten(F.transform("turns", lambda t: F.array(F.lit(False), t["learned"], F.lit(False))))
    runs = runs.select("conv_id", "run", F.size("turns").alias("n"), parts.alias("parts"), mask.alias("mask"))
    whole = runs.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("run", "parts", "mask"))).alias("runs"))
    whole = whole.select(
        "conv_id", "n_turns", F.flatten(F.transform("runs", lambda r: r["parts"])).alias("parts"), F.flatten(F.transform("runs", lambda r: r["mask"])).alias("mask")
    )
    return whole.withColumn("formatted", F.array_join("parts", ""))


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold(events))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct<role, text>."""
    turns = F.filter(F.split(formatted, CLOSE), lambda x: x != "")
    head = F.length(F.lit(OPEN))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, MIDDLE, 1)
        body = F.substr(piece, F.length(role) + F.lit(len(MIDDLE) + 1))
        return F.struct(unescape_role(F.substr(role, head + 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, turn)


def learned_text(parts: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(F.arrays_zip(parts.alias("p"), mask.alias("m")), lambda x: x["m"]), lambda x: unescape(x["p"])), "")
