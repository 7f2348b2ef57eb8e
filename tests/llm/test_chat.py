from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweft.llm import chat

EVENTS = "conv_id long, seq long, msg long, role string, event string, text string, n long"


def formatted(spark, rows):
    done = chat.format_chats(spark.createDataFrame([(*r, 1) for r in rows], EVENTS))
    done = done.select("conv_id", chat.read_back(F.col("formatted")).alias("said"), chat.learned_text(F.col("parts"), F.col("mask")).alias("learned"))
    return {r["conv_id"]: ([(t["role"], t["text"]) for t in r["said"]], r["learned"]) for r in done.collect()}


def test_events_fold_into_messages(spark):
    rows = [
        (1, 1, 0, "user", "message", "hi"), (1, 9, 0, "user", "edit", "hello"),
        (1, 2, 1, "assistant", "delta", "wro"), (1, 3, 1, "assistant", "delta", "ng"), (1, 4, 1, "assistant", "regenerate", None),
        (1, 6, 1, "assistant", "delta", "ht"), (1, 5, 1, "assistant", "delta", "rig"),
        (1, 7, 2, "user", "message", "gone"), (1, 8, 2, "user", "delete", None),
        (1, 10, 3, "user", "delete", None), (1, 11, 3, "user", "delta", "back"),
        (None, 1, 0, None, None, None), (2, 1, 0, "assistant", "message", ""),
    ]
    found = formatted(spark, rows)
    assert found[1] == ([("user", "hello"), ("assistant", "right"), ("user", "back")], "right")
    assert found[None] == ([("", "")], "") and found[2] == ([("assistant", "")], "")


def test_repeated_turns_and_ties_all_stand(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "z")]
    done = chat.format_chats(chat.events_of_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    row = done.select(chat.read_back(F.col("formatted")).alias("said"), "n_turns").first()
    assert row["n_turns"] == 4 and [t["text"] for t in row["said"]] == ["z", "a", "a", "b"]


def test_long_conversation_keeps_its_order(spark):
    turns = spark.range(1000).select(F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.concat(F.col("id"), F.lit(",")).alias("text"))
    row = chat.format_chats(chat.events_of_turns(turns)).select(chat.learned_text(F.col("parts"), F.col("mask")).alias("t")).first()
    assert row["t"] == "".join(f"{i}," for i in range(1000))


def test_empty_log(spark):
    assert chat.format_chats(spark.createDataFrame([], EVENTS)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.text("\\#</turn>\n: bhlcé", max_size=12), st.text("\\#</turn>\n: bhlc### ", max_size=20)), min_size=1, max_size=20))
def test_round_trip(spark, turns):
    rows = [(1, i, i, role, "message", text) for i, (role, text) in enumerate(turns)]
    assert formatted(spark, rows)[1][0] == turns
