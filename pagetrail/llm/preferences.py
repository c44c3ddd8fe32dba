"""Preference formatting: common prompt and paired, masked completions of two conversations.

A conversation is its turns in order (turn, then role and text for repeated numbers;
nulls first). For a chosen and a rejected conversation the longest common prefix of
turns (same role and text) is rendered once as the prompt; the rest of each becomes its
completion. A completion's mask lists the character ranges that are learnt from, the
texts of assistant turns with their end mark; all else is masked out.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``; a null role is written as
``user``, a null text as empty, and ``<|`` within a text gets a zero-width space so it can't
pose as a mark. Equal conversations give empty completions; a pair with a missing or
unknown side has an empty completion there and a prompt without turns. Turns without a
conversation id are ignored, extra columns too; repeated turn rows are turns of their own; empty
tables give no rows. Built-in functions only; a row holds one pair's turns.

``format_answers`` makes the pairs as well: a conversation against itself with the last
answer of the next one, so that the prompt is all before that answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.llm.common import materialize

START, END = "<|im_start|>", "<|im_end|>"


def _rendered(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, _turn))


def _head(t: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(t["role"], F.lit("user")), F.lit("\n"))


def _body(t: Column) -> Column:
    return F.concat(F.replace(F.coalesce(t["text"], F.lit("")), F.lit("<|"), F.lit("<​|")), F.lit(END))


def _turn(t: Column) -> Column:
    return F.concat(_head(t), _body(t), F.lit("\n"))


def _mask(turns: Column) -> Column:
    """Character ranges [start, stop) of assistant texts and their end marks in the rendered turns."""
    steps = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(_turn(t))).alias("at"),
            F.when(
                t["role"] == "assistant",
                F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(_head(t))).alias("start"), (a["at"] + F.length(_head(t)) + F.length(_body(t))).alias("stop")))),
            ).otherwise(a["spans"]).alias("spans"),
        ),
    )
    return steps["spans"]


def _none() -> Column:
    return F.array().cast("array<struct<turn:bigint,role:string,text:string>>")


def _conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): a row per conversation, its turns in order."""
    spot = F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(spot)).alias("turns"))


def format_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, prompt, prompt_turns, chosen, chosen_mask, rejected, rejected_mask) of every row of ``pairs``.

    ``conversations`` has conv_id, turn, role, text; ``pairs`` has pair_id, chosen, rejected (conversation ids).
    """
    turns = _conversations(conversations)
    found = pairs.select("pair_id", "chosen", "rejected")
    for side in ("chosen", "rejected"):
        found = found.join(turns.select(F.col("conv_id").alias(side), F.col("turns").alias(f"{side}_turns")), side, "left")
    a, b = (F.coalesce(f"{side}_turns", _none()) for side in ("chosen", "rejected"))
    return _formatted(found.select("pair_id", a.alias("a"), b.alias("b")))


def _formatted(found: DataFrame) -> DataFrame:
    """Prompt and masked completions of pairs (pair_id, a: chosen turns, b: rejected turns)."""
    same = F.zip_with("a", "b", lambda x, y: x.isNotNull() & y.isNotNull() & x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    unequal = F.array_position(same, F.lit(False))
    found = found.withColumn("common", F.when(unequal == 0, F.size(same)).otherwise(unequal - 1).cast("int"))
    rest = lambda side: F.slice(side, F.col("common") + 1, F.greatest(F.size(side) - F.col("common"), F.lit(0)))
    found = found.select("pair_id", "common", F.slice("a", F.lit(1), F.col("common")).alias("shared"), rest("a").alias("a"), rest("b").alias("b"))
    return found.select(
        "pair_id",
        _rendered(F.col("shared")).alias("prompt"),
        F.col("common").alias("prompt_turns"),
        _rendered(F.col("a")).alias("chosen"),
        _mask(F.col("a")).alias("chosen_mask"),
        _rendered(F.col("b")).alias("rejected"),
        _mask(F.col("b")).alias("rejected_mask"),
    )


def format_answers(conversations: DataFrame) -> DataFrame:
    """The columns of ``format_pairs`` for every conversation against itself with another last answer; pair_id is conv_id.

    The rejected side has the conversation's turns, with the text of its last assistant turn
    taken from the last assistant turn of the next conversation that has one (ascending
    conv_id; after the last: the first). A conversation without an assistant turn is chosen
    over nothing.
    """
    said = F.transform("turns", lambda t: t["role"].eqNullSafe(F.lit("assistant")))
    behind = F.array_position(F.reverse(said), F.lit(True)).cast("int")
    rows = _conversations(conversations).withColumn("last", F.when(behind > 0, F.size("turns") - behind + 1))
    # neighbours within ranges of ids; the first conversation of each range is the next one at the range before
    answers = rows.where("last is not null").select("conv_id", F.struct(F.element_at("turns", F.col("last"))["text"].alias("text")).alias("answer"))
    answers = materialize(answers.repartitionByRange("conv_id").withColumn("part", F.spark_partition_id()), "answers")
    heads = answers.groupBy("part").agg(F.min_by("answer", "conv_id").alias("answer"))
    over = Window.orderBy("part")  # a row a range, as many as partitions
    first = F.first("answer").over(over)
    heads = heads.select("part", F.coalesce(F.lead("answer").over(over), first).alias("after"))
    inside = Window.partitionBy("part").orderBy("conv_id")
    replies = answers.join(F.broadcast(heads), "part").select("conv_id", F.coalesce(F.lead("answer").over(inside), F.col("after"))["text"].alias("reply"))
    other = F.transform(
        "turns", lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.when(i + 1 == F.col("last"), F.col("reply")).otherwise(t["text"]).alias("text")))
    found = rows.join(replies, "conv_id", "left")
    return _formatted(found.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("a"), F.when(F.col("last").isNotNull(), other).otherwise(_none()).alias("b")))
