"""Conversations that begin with the turns of another one, as sequences of turn ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.llm.trie import chunk, numbered, over_chunks
from provender.session import written

#: Conversations of a family share beginnings; up to so many turns are shared, less one.
FAMILY, LONGEST = 5, 9


def turn_id(role: Column, text: Column) -> Column:
    """One text for what is said by whom; null counts as empty."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``seq_id, at, item, weight`` of all rebuilt conversations, and ``seq_id, n`` of each.

    Conversation c takes the first h turns of conversation c - c % 5 (all if there are
    fewer), then its own after its first h; h is the unsigned crc32 of its decimal id
    modulo 9. Turns are ordered by ``turn``, null first; equal ones by their turn id.
    Rows without a conversation are left out. ``weight`` counts the text's bytes in UTF-8.
    """
    conv = F.col("conv_id").cast("bigint")
    turns = conversations.where(conv.isNotNull()).select(
        conv.alias("seq_id"), F.col("turn").cast("bigint").alias("turn"), turn_id(F.col("role"), F.col("text")).alias("item"),
        F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("bigint").alias("weight"))
    own = written(numbered(turns, "seq_id", ["turn", "item", "weight"]).drop("turn"), "turns")
    sizes = own.groupBy("seq_id").agg(F.max("at").alias("own"))
    of = sizes.withColumn("h", F.crc32(F.col("seq_id").cast("string").cast("binary")) % LONGEST).withColumn(
        "giver", F.col("seq_id") - F.col("seq_id") % FAMILY)
    given = F.least("h", F.coalesce("theirs", F.lit(0).cast("bigint")))
    of = written(of.join(sizes.select(F.col("seq_id").alias("giver"), F.col("own").alias("theirs")), "giver", "left").select(
        "seq_id", "giver", "h", "own", given.alias("given")), "rebuilding")
    # At most LONGEST - 1 turns of a giver, for at most FAMILY conversations.
    first = own.where(F.col("at") < LONGEST).withColumnRenamed("seq_id", "giver")
    taken = of.join(first, "giver").where(F.col("at") <= F.col("h")).select("seq_id", "at", "item", "weight")
    kept = own.withColumn("chunk", chunk(F.col("at"))).join(
        over_chunks(of.withColumn("after", F.col("h") + 1), F.col("after"), F.col("own")).drop("own", "giver"), ["seq_id", "chunk"])
    kept = kept.where(F.col("at") > F.col("h")).select("seq_id", (F.col("at") - F.col("h") + F.col("given")).alias("at"), "item", "weight")
    length = F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("bigint"))
    return taken.unionByName(kept), of.select("seq_id", length.alias("n"))
