"""Exact top-k inner products by a vector-approximation file.

Every vector is also kept as one byte per component: the cell of a grid that its
block of vectors lays between the block's least and largest values. A query scans
these small cells first. A cell bounds the score from both sides, and a vector
whose upper bound is below the k-th best lower bound can't be a result. Exact
vectors are then read in the order of their bounds: first the most promising, and
after them only those whose upper bound still reaches the k-th exact score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provender.session import written

#: Vectors of an approximation block, queries of a block, and parts that candidates are dealt to.
BLOCK, QUERIES, STRIPES = 4096, 512, 32
#: Integer scores up to this size are exact in double precision.
EXACT = 2.0**53


def scaled(vector: Column, factor: int = 1024) -> Column:
    """Components as floor(factor * x), x as a double."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(float(factor)) * x))


def top_k(vectors: DataFrame, asks: Column, k: int = 10, factor: int = 1024) -> DataFrame:
    """For every row of ``vectors`` where ``asks`` holds, its k best other rows.

    Returns ``query_id, rank, vec_id, score`` by integer inner product of the
    ``scaled`` components, ties to the smaller ``vec_id``. Rows whose vector is null
    or holds a null or non-finite component take no part; vectors meet only those
    of their own length. So that every score fits 64 bits, components of a vector of d
    lie within 2**31 / sqrt(d) after scaling; a vector beyond that takes no part either.
    A query with fewer candidates gets them all. Rows that
    repeat are candidates each, also those with the query's own id, but not the
    query's own row; equal ids then share an order of their own. An empty table
    gives no rows; extra columns are left out.
    """
    finite = F.forall(F.col("embedding").cast("array<double>"),
                      lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    furthest = F.lit(2.0**31) / (F.sqrt(F.size("embedding").cast("double")) * float(factor))
    small = F.forall(F.col("embedding").cast("array<double>"), lambda x: F.abs(x) <= furthest)
    rows = written(
        vectors.where(F.coalesce(finite & small, F.lit(False)))
        .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"),
                scaled(F.col("embedding"), factor).alias("x"), F.coalesce(asks, F.lit(False)).alias("asks")), "vectors")
    asked = rows.where("asks").select("row", "x")
    n_blocks = max(1, -(-asked.count() // QUERIES))
    cells = written(rows.select("row", "x").mapInArrow(
        _cells, "width int, cell_rows binary, codes binary, low binary, step binary")
        .withColumn("stripe", F.pmod(F.monotonically_increasing_id(), F.lit(STRIPES)).cast("int")), "cells")
    questions = asked.repartition(n_blocks).mapInArrow(_questions, "width int, ask_rows binary, asked binary").withColumn(
        "stripe", F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1))))
    bounds = written(
        cells.join(questions, ["stripe", "width"]).select("ask_rows", "asked", "cell_rows", "codes", "low", "step")
        .mapInArrow(_scan(k), "ask bigint, row bigint, lower double, upper double"), "bounds")

    by_lower = Window.partitionBy("ask").orderBy(F.desc("lower"))
    sure = (
        bounds.select("ask", "lower").withColumn("place", F.row_number().over(by_lower)).where(F.col("place") <= k)
        .groupBy("ask").agg(F.count("*").alias("n"), F.min("lower").alias("least"))
        .select("ask", F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf")).alias("least"))
    )
    left = written(bounds.join(sure, "ask").where(F.col("upper") >= F.col("least")).drop("least", "lower"), "left")

    by_upper = Window.partitionBy("ask").orderBy(F.desc("upper"), "row")
    first = written(_scored(left.withColumn("place", F.row_number().over(by_upper)).where(F.col("place") <= 2 * k)
                            .drop("place"), rows), "scores")
    by_score = Window.partitionBy("ask").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    best = lambda df: df.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    reached = best(first).groupBy("ask").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    rest = (
        left.join(reached, "ask").where((F.col("n") < k) | (F.col("upper") >= F.col("kth")))
        .join(first.select("ask", "row"), ["ask", "row"], "left_anti").select("ask", "row", "upper")
    )
    found = best(first.unionByName(_scored(rest, rows)))
    return found.join(rows.select(F.col("row").alias("ask"), F.col("vec_id").alias("query_id")), "ask").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _scored(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact scores of (ask, row), both vectors read by their row."""
    of = rows.select("row", "vec_id", "x")
    query = rows.where("asks").select(F.col("row").alias("ask"), F.col("x").alias("q"))
    score = F.aggregate(F.zip_with("q", "x", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, p: s + p)
    return pairs.join(query, "ask").join(of, "row").select("ask", "row", "vec_id", score.alias("score"))


def _by_width(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of vectors of one length: the length, the rows, and the vectors."""
    for batch in batches:
        x = batch.column("x")
        lengths = np.diff(x.offsets.to_numpy())
        rows = batch.column("row").to_numpy()
        for width in np.unique(lengths):
            mine = np.flatnonzero(lengths == width)
            for at in range(0, len(mine), size):
                part = mine[at:at + size]
                yield int(width), rows[part], x.take(pa.array(part)).flatten().to_numpy().reshape(len(part), int(width))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for width, rows, x in _by_width(batches, BLOCK):
        low, high = x.min(axis=0, initial=2**62), x.max(axis=0, initial=-2**62)
        step = np.maximum(1, -(-(high - low + 1) // 256))
        codes = ((x - low) // step).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([width], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in (rows, codes, low, step))],
            names=["width", "cell_rows", "codes", "low", "step"])


def _questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for width, rows, x in _by_width(batches, QUERIES):
        yield pa.RecordBatch.from_arrays(
            [pa.array([width], pa.int32()), pa.array([rows.tobytes()], pa.binary()),
             pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())], names=["width", "ask_rows", "asked"])


def _scan(k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The k best lower bounds that this task has seen for each block of queries.
        best: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                raw = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ask_rows, cell_rows = (np.frombuffer(raw[c], dtype=np.int64) for c in ("ask_rows", "cell_rows"))
                low, step = (np.frombuffer(raw[c], dtype=np.int64) for c in ("low", "step"))
                q = np.frombuffer(raw["asked"], dtype=np.int64).reshape(len(ask_rows), -1)
                codes = np.frombuffer(raw["codes"], dtype=np.uint8).reshape(len(cell_rows), -1)
                lower, upper = bound(q, codes, low, step)
                own = ask_rows[:, None] == cell_rows[None, :]
                lower[own] = upper[own] = -np.inf
                seen = lower if raw["ask_rows"] not in best else np.concatenate([best[raw["ask_rows"]], lower], axis=1)
                if seen.shape[1] >= k:
                    seen = np.partition(seen, seen.shape[1] - k, axis=1)[:, -k:]
                    reached = seen.min(axis=1)
                else:
                    reached = np.full(len(q), -np.inf)
                best[raw["ask_rows"]] = seen
                a, b = np.nonzero((upper >= reached[:, None]) & ~own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ask_rows[a]), pa.array(cell_rows[b]), pa.array(lower[a, b]), pa.array(upper[a, b])],
                    names=["ask", "row", "lower", "upper"])

    return scan


def bound(q: np.ndarray, codes: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each query with any vector of each cell."""
    corner = (low + codes.astype(np.int64) * step).astype(np.float64)
    q, width = q.astype(np.float64), (step - 1).astype(np.float64)
    at = q @ corner.T
    # Where doubles may round, the bounds are widened by more than they can.
    size = np.abs(q) @ (np.abs(low) + 256.0 * step)
    loose = np.where(size < EXACT / 4, 0.0, size * 1e-12)
    return (at + (np.minimum(q, 0) @ width - loose)[:, None], at + (np.maximum(q, 0) @ width + loose)[:, None])
