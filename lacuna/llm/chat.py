"""Chat formatting: keep the longest of cumulative snapshots, then render turns.

Logs often hold a conversation again after every turn.  A snapshot is recognised by
hashes of turn prefixes, which one running aggregate over hashes of turns gives for every
prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: How a turn is rendered.  The role "user" etc. stands as it is.
TEMPLATE = ("<|", "|>\n", "\n<|end|>\n")
#: Turns per rendered row; longer conversations continue in further segments.
SEGMENT_TURNS = 1000


def _turns(conversations: DataFrame) -> DataFrame:
    """The turns with a key of their conversation and two hashes of role and text."""
    role, text = F.col("role").cast("string"), F.col("text").cast("string")
    parts = (role.isNull(), role, text.isNull(), text)
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(*parts).alias("one"),
        F.xxhash64(F.lit("2"), *parts).alias("two"),
    )


def _ranked(turns: DataFrame) -> DataFrame:
    """The turns with ``tie``, their order by role and text among those of one number.

    Only turns whose number repeats are sorted by their texts; all others are 0.
    """
    number = ["key", "turn"]
    again = turns.groupBy(*number).agg(F.count("*").alias("n")).filter("n > 1")
    again = again.select(F.col("key").alias("k"), F.col("turn").alias("t"))
    one_number = (F.col("key") == F.col("k")) & F.col("turn").eqNullSafe(F.col("t"))
    tied = turns.join(again, one_number, "left_semi")
    order = F.dense_rank().over(W.partitionBy(*number).orderBy("role", "text")).alias("tie")
    ranks = tied.select(F.col("key").alias("k"), F.col("turn").alias("t"), F.col("one").alias("o"), F.col("two").alias("w"), order)
    same = one_number & (F.col("one") == F.col("o")) & (F.col("two") == F.col("w"))
    found = turns.join(ranks.distinct(), same, "left").drop("k", "t", "o", "w")
    return found.withColumn("tie", F.coalesce("tie", F.lit(0)))


def _at() -> Column:
    """The position of a turn: by number (null first), equal numbers by role and text."""
    return F.row_number().over(W.partitionBy("key").orderBy("turn", "tie"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``key, conv_id, at, turns, p1, p2``: for each turn its position, the turns of its
    conversation, and two hashes of all turns up to it.

    A prefix hash is the exclusive or of hashes of (position, role, text), so one running
    aggregate over hashes gives it; no text is sorted for it.
    """
    whole = W.partitionBy("key").orderBy("at")
    running = whole.rowsBetween(W.unboundedPreceding, W.currentRow)
    at = turns.select("key", "conv_id", "turn", "tie", "one", "two").withColumn("at", _at())
    return at.select(
        "key",
        "conv_id",
        "at",
        F.max("at").over(whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("turns"),
        F.bit_xor(F.xxhash64("at", "one", "two")).over(running).alias("p1"),
        F.bit_xor(F.xxhash64("two", "one", "at")).over(running).alias("p2"),
    )


PREFIX = ["at", "p1", "p2"]


def maximal(turns: DataFrame) -> DataFrame:
    """``key, n_turns`` of conversations that no other one continues; of equal ones the
    smallest id (a null id only if no other has these turns).  ``turns``: ``prefixes()``."""
    first = F.struct(F.col("conv_id").isNull(), "conv_id", "key")
    ends = turns.filter("at = turns").groupBy(*PREFIX).agg(F.min(first)["key"].alias("key"))
    # One row for each prefix however many conversations share it, folded before the shuffle.
    proper = turns.filter("at < turns").select(*PREFIX).distinct()
    return ends.join(proper, PREFIX, "left_anti").select("key", F.col("at").alias("n_turns"))


def rendered(role: Column, text: Column) -> Column:
    """A turn as training text; a null role is ``unknown``, a null text empty."""
    before, between, after = map(F.lit, TEMPLATE)
    return F.concat(before, F.coalesce(role, F.lit("unknown")), between, F.coalesce(text, F.lit("")), after)


def chat_format(conversations: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Maximal conversations as text: ``conv_id, n_turns, segment, n_segment_turns, text``.

    Turns are ordered by number (null first), equal numbers by role and text (null first),
    repeated rows included; a null role or text is one of its own, unlike the empty one.
    Rows without a ``conv_id`` form one conversation.  Conversations of up to
    ``segment_turns`` turns are one row with segment 0; the texts of a longer one, in
    segment order, add up to it, so no row grows without bound.  Other columns are not
    read; an empty table gives no rows.
    """
    turns = _ranked(_turns(conversations))
    # Texts are shuffled once, by conversation, for all that follows.
    chosen = turns.join(maximal(prefixes(turns)), "key").withColumn("at", _at())
    each = F.struct("at", rendered(F.col("role"), F.col("text")).alias("s"))
    return (
        chosen.withColumn("segment", F.floor((F.col("at") - 1) / segment_turns).cast("long"))
        .groupBy("key", "conv_id", "n_turns", "segment")
        .agg(F.sort_array(F.collect_list(each)).alias("all"))
        .select(
            "conv_id",
            F.col("n_turns").cast("long").alias("n_turns"),
            "segment",
            F.size("all").cast("long").alias("n_segment_turns"),
            F.array_join("all.s", "").alias("text"),
        )
    )
