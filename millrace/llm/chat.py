"""Preference pairs of conversations: the common turns once as a prompt, and both completions with masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, SHUT, END = "<|", "|>\n", "<|end|>\n"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(SHUT))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def _mask(turns: Column, trained_role: str) -> Column:
    """Spans of characters (start, length) that a loss counts: text and end mark of the trained role's turns."""
    def step(state: Column, turn: Column) -> Column:
        head, body = F.length(_head(turn)), F.length(turn["text"]) + F.lit(len(END))
        span = F.struct((state["at"] + head).cast("int").alias("start"), body.cast("int").alias("length"))
        spans = F.when(turn["role"] == trained_role, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + head + body).cast("int").alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return F.aggregate(turns, start, step, lambda state: state["spans"])


def preference_pairs(turns: DataFrame, pair_column: str = "pair_id", trained_role: str = "assistant") -> DataFrame:
    """``pair_column, common_turns, prompt, chosen, rejected, chosen_mask, rejected_mask`` per pair.

    ``turns`` has a row per turn: the pair, ``side`` (chosen or rejected), ``turn`` (its order), ``role`` and ``text``. The
    prompt renders the longest run of leading turns with equal role and text on both sides; each completion renders the
    rest of its side. A mask is an array of spans of characters of its completion: the texts and end marks of turns of
    ``trained_role``, never the heads or the turns of others.

    Null roles and texts count as empty strings. Turns of one place are put in order of role and text. If one side is
    missing or is the beginning of the other, its completion is empty with an empty mask; if both are equal, both are.
    Rows without pair, side or turn are left out, other sides too; repeated rows are turns of their own. Other columns
    are ignored, and an empty table gives an empty result. A conversation is one value, as its rendering is.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = turns.filter(F.col(pair_column).isNotNull() & F.col("turn").isNotNull() & F.col("side").isin("chosen", "rejected"))
    sides = rows.select(F.col(pair_column).alias("pair"), "side", turn.alias("turn")).groupBy("pair").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("turn")))).alias(side) for side in ("chosen", "rejected")])
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    equal = F.zip_with(F.slice("chosen", F.lit(1), shorter), F.slice("rejected", F.lit(1), shorter),
                       lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]))
    first = F.array_position(equal, False)
    common = F.when(first > 0, first - 1).otherwise(shorter).cast("int")
    cut = sides.withColumn("common_turns", common).select(
        "pair", "common_turns", F.slice("chosen", F.lit(1), F.col("common_turns")).alias("prompt"),
        *[F.slice(x, F.col("common_turns") + 1, F.size(x)).alias(x) for x in ("chosen", "rejected")])
    return cut.select(
        F.col("pair").alias(pair_column), "common_turns", _rendered(F.col("prompt")).alias("prompt"),
        *[_rendered(F.col(x)).alias(x) for x in ("chosen", "rejected")],
        *[_mask(F.col(x), trained_role).alias(f"{x}_mask") for x in ("chosen", "rejected")])


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Turns of preference pairs made from ``conv_id, turn, role, text``: a conversation against another one's reply.

    Chosen is a conversation up to its last assistant turn. Rejected is the same with the last assistant turn of the
    conversation that differs in the lowest bit of the id; without such a reply it ends before. Conversations without an
    assistant turn are chosen as they are and rejected without their last turn.
    """
    turns = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "role", "text")
    ends = turns.groupBy("conv_id").agg(
        F.max("turn").alias("latest"), F.max(F.when(F.col("role") == "assistant", F.struct("turn", "text"))).alias("reply"))
    replies = ends.filter("reply IS NOT NULL").select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply.text").alias("other"))
    last = F.coalesce(F.col("reply.turn"), F.col("latest"))
    marked = turns.join(ends.select("conv_id", last.alias("last")), "conv_id").filter(F.col("turn") <= F.col("last"))
    own = marked.select("conv_id", F.explode(F.when(F.col("turn") < F.col("last"), F.array(F.lit("chosen"), F.lit("rejected")))
                                             .otherwise(F.array(F.lit("chosen")))).alias("side"), "turn", "role", "text")
    wrong = ends.select("conv_id", last.alias("turn")).join(replies, "conv_id").select(
        "conv_id", F.lit("rejected").alias("side"), "turn", F.lit("assistant").alias("role"), F.col("other").alias("text"))
    return own.unionByName(wrong)
