"""Mixing sources to target weights by systematic sampling.

A source's documents are put in one order, the expected copies of each are summed
along it from one random offset, and a document is emitted once for every whole
number its stretch of the sum crosses. The order goes by size, so a source's taken
words stay near its target whatever the sizes are.

The running sum is made without one task per source: rows are counted per source,
size class and salt (a bounded number of chunks per source), chunk counts are
summed along the source, and only places inside a chunk need the rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provender.llm.names import spare

WORD = r"[^\x20\x09-\x0D]+"
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycled_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Give sources the weights in turn, by code point, a null source last.

    The window sees one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))))


def targets(sources: DataFrame, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Add each source's ``target``: its weight's part of ``share`` times all sizes.

    A target stops at ``limit`` times the source's size and the excess is shared
    again by weight. With the sources in order of where they stop per unit of
    weight, the level at which sharing ends is the first that the next source
    doesn't stop below. Weights must be positive. The window sees one row per source.
    """
    room = F.lit(float(limit)) * F.col("source_size")
    everyone = Window.partitionBy()
    by_stop = Window.orderBy("_stop", F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    levelled = (
        sources.withColumn("_room", room).withColumn("_stop", F.col("_room") / F.col("weight"))
        .withColumn("_goal", F.lit(float(share)) * F.sum("source_size").over(everyone))
        .withColumn("_place", F.row_number().over(by_stop))
        .withColumn("_filled", F.coalesce(F.sum("_room").over(before), F.lit(0.0)))
        .withColumn("_open", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_level", (F.col("_goal") - F.col("_filled")) / F.col("_open"))
    )
    first = F.min(F.when(F.col("_level") <= F.col("_stop"), F.struct("_place", "_level"))).over(everyone)
    level = first.getField("_level")
    return levelled.withColumn("target", F.when(level.isNull(), F.col("_room")).otherwise(
        F.least("_room", F.col("weight") * level))).select(*sources.columns, "target")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0,
        seed: str = "mix", salts: int = 64) -> DataFrame:
    """Every document with the times the mix takes it.

    Adds ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken``
    (``copies * size``); input columns of these names are replaced, others kept.
    Use ``emitted`` for the mixed rows themselves. Runs on the same rows agree.

    A null source is a source of its own, last in order. A null or empty text has
    size 0 and takes 0 words. A source without words has target 0 and no copies.
    Rows that repeat in id and size may swap their copies. An empty table gives no
    rows.
    """
    # Under names of their own, so that columns nobody asks for are never shuffled.
    kept = {f"_kept{i}": c for i, c in enumerate(docs.columns) if c not in ADDED}
    length = F.length(F.bin("size"))
    rows = (
        docs.select(*[F.col(f"`{c}`").alias(name) for name, c in kept.items()],
                    word_count(F.col("text")).alias("size"), "source", F.col("doc_id").alias("_id"))
        .withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        # Four size classes to an octave: the length in bits and the two bits after the first.
        .withColumn("_class", 4 * length + F.when(length < 3, F.lit(0)).otherwise(
            F.expr("CAST(shiftright(size, CAST(length(bin(size)) AS int) - 3) & 3 AS int)")))
        .withColumn("_salt", hex_number(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit(""))), 4) % salts)
    )
    chunks = rows.groupBy("_key", "_class", "_salt").agg(
        F.count("*").alias("_n"), F.sum("size").alias("_words"), F.first("source").alias("source"))
    along = Window.partitionBy("_key").orderBy("_class", "_salt")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    sources = chunks.groupBy("_key").agg(F.first("source").alias("source"), F.sum("_words").alias("source_size"))
    planned = targets(cycled_weights(sources, weights), share, limit).select(
        "_key", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"),
        (hex_number(F.md5(F.concat(F.lit(seed), "_key")), 8) / F.lit(4294967296.0)).alias("_offset"))
    placed = (
        chunks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_key", "_class", "_salt", "_before").join(planned, "_key")
    )
    inside = Window.partitionBy("_key", "_class", "_salt").orderBy("size", "_id")
    sum_at = lambda place: F.floor(F.col("_rate") * place.cast("double") + F.col("_offset"))
    return (
        rows.withColumn("_inside", F.row_number().over(inside)).join(placed, ["_key", "_class", "_salt"])
        .withColumn("_place", F.col("_before") + F.col("_inside"))
        .withColumn("copies", sum_at(F.col("_place")) - sum_at(F.col("_place") - 1))
        .select(*[F.col(name).alias(c) for name, c in kept.items()], "size", "source_size", "target", F.col("copies").cast("bigint").alias("copies"),
                (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as it is taken."""
    kept = [c for c in mixed.columns if c not in ADDED]
    copies, name = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))), spare(mixed.columns, "_copy")
    return mixed.select(*[F.col(f"`{c}`") for c in kept], copies.alias(name)).drop(name)


def hex_number(digest: Column, digits: int) -> Column:
    """The first hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
