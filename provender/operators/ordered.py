"""Ordered rules within a group that stay balanced when one group is huge.

A plain window puts a whole group into one task. These helpers cut each group
into chunks by a fixed width of the order value, run the window per (group,
chunk), and carry the little that crosses a chunk border through a summary with
one row per chunk. The width is a parameter: choose it so that one chunk of the
largest group fits a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provender.functions.text import named


def time_chunk(ts: Column, seconds: int) -> Column:
    """Chunk number of a timestamp."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(seconds)).cast("bigint")


def with_next(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], values: Sequence[str],
              prefix: str = "next_") -> DataFrame:
    """Add the values of the following row of the same group (null on the last)."""
    return _neighbour(df, keys, chunk, order, values, prefix, forward=True)


def with_previous(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], values: Sequence[str],
                  prefix: str = "prev_") -> DataFrame:
    """Add the values of the preceding row of the same group (null on the first)."""
    return _neighbour(df, keys, chunk, order, values, prefix, forward=False)


def _neighbour(df, keys, chunk, order, values, prefix, forward):
    rows = df.withColumn("_chunk", chunk)
    group = [named(k) for k in keys]
    packed = F.struct(*[named(c) for c in order], *[named(v) for v in values if v not in order])
    within = Window.partitionBy(*group, "_chunk").orderBy(*[named(c) for c in order])
    shift = F.lead if forward else F.lag
    rows = rows.withColumn("_near", shift(packed).over(within))

    edge = F.min(packed) if forward else F.max(packed)
    across = Window.partitionBy(*group).orderBy("_chunk")
    borders = (
        df.withColumn("_chunk", chunk).groupBy(*group, "_chunk").agg(edge.alias("_edge"))
        .withColumn("_far", shift("_edge").over(across)).drop("_edge")
    )
    joined = _same_group(rows, borders, keys)
    near = F.coalesce("_near", "_far")
    return joined.select(*[named(c) for c in df.columns],
                         *[near.getField(v).alias(prefix + v) for v in values])


def with_position(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str],
                  position: str = "position", size: str = "group_size") -> DataFrame:
    """Add the 1-based place of a row in its group, and the group's size."""
    rows = df.withColumn("_chunk", chunk)
    group = [named(k) for k in keys]
    within = Window.partitionBy(*group, "_chunk").orderBy(*[named(c) for c in order])
    rows = rows.withColumn("_place", F.row_number().over(within))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        df.withColumn("_chunk", chunk).groupBy(*group, "_chunk").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(whole)).drop("_n")
    )
    joined = _same_group(rows, chunks, keys)
    return joined.select(*[named(c) for c in df.columns],
                         (F.col("_place") + F.col("_before")).cast("bigint").alias(position),
                         F.col("_total").cast("bigint").alias(size))


def _same_group(rows: DataFrame, chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the summary of their chunk; a null key is a group like any other."""
    side = chunks.select(*[named(c).alias(f"_of_{c}") for c in (*keys, "_chunk")],
                         *[named(c) for c in chunks.columns if c not in (*keys, "_chunk")])
    same = None
    for c in (*keys, "_chunk"):
        equal = named(c).eqNullSafe(named(f"_of_{c}"))
        same = equal if same is None else same & equal
    return rows.join(side, same, "left").drop(*[f"_of_{c}" for c in (*keys, "_chunk")])


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows per group.

    The filter on the rank lets Spark keep k rows per group in every input task
    before it shuffles, so a huge group costs k rows per task.
    """
    w = Window.partitionBy(*[named(c) for c in keys]).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
