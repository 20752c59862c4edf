"""Operator 5: preference formatting of chosen and rejected conversations.

The longest common prefix of turns is rendered once as the prompt; what follows in either conversation is rendered as
its completion, with the character ranges that a trainer scores (what the assistant says) as its mask.

Defined results: null roles and texts are empty; turns with equal numbers stand in order of role and text; a
conversation without an assistant turn has no reply to reject and gets the status no_reply; equal conversations get
identical and empty completions; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Conversations of one id range of this length lend each other replies.
BLOCK = 1024


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): a row per conversation, its turns in order."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    out = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return out.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def with_rejected(convs: DataFrame) -> DataFrame:
    """Adds donor_id and rejected: the conversation up to its last reply, then the end of the next conversation of its
    id range (after the last comes the first), a reply to another question."""
    replies = F.transform("turns", lambda x, i: F.when(x["role"] == "assistant", i))
    rows = convs.withColumn("at", F.array_max(replies))
    tail = F.when(F.col("at").isNotNull(), F.slice("turns", F.col("at") + 1, F.size("turns")))
    rows = rows.withColumn("give", F.struct(F.col("conv_id").alias("donor_id"), tail.alias("tail")))
    block = Window.partitionBy(F.floor(F.col("conv_id") / BLOCK), F.col("at").isNull()).orderBy("conv_id")
    rows = rows.withColumn("got", F.coalesce(F.lead("give").over(block), F.first("give").over(block)))
    rejected = F.when(F.col("at").isNotNull(), F.concat(F.slice("turns", 1, F.col("at")), F.col("got.tail")))
    return rows.select("conv_id", F.when(F.col("at").isNotNull(), F.col("got.donor_id")).alias("donor_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    same = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first.cast("int") - 1)


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(_head(x), x["text"], F.lit("<|end|>\n"))), "")


def mask(turns: Column) -> Column:
    """start-end of each assistant text with its end mark in what render() gives, by comma; ends exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(_head(x))
        end = begin + F.length(x["text"]) + len("<|end|>")
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        spans = F.when(x["role"] == "assistant", F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: F.array_join(acc["spans"], ","))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """From (conv_id, donor_id, chosen, rejected): n_common, prompt, both completions and masks, status."""
    rows = pairs.withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected")))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.lit(0), F.size(c) - F.col("n_common")))
    rows = rows.withColumns({"c": rest("chosen"), "r": rest("rejected")})
    status = F.when(F.col("rejected").isNull(), "no_reply").when((F.size("c") == 0) & (F.size("r") == 0), "identical").otherwise("pair")
    whole = F.col("rejected").isNull()
    return rows.select(
        "conv_id",
        "donor_id",
        F.when(whole, F.size("chosen")).otherwise(F.col("n_common")).cast("long").alias("n_common"),
        F.when(whole, render(F.col("chosen"))).otherwise(render(F.slice("chosen", 1, F.col("n_common")))).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        render(F.col("r")).alias("rejected"),
        mask(F.col("c")).alias("chosen_mask"),
        mask(F.col("r")).alias("rejected_mask"),
        status.alias("status"),
    )
