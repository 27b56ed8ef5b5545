"""Connected components of a link table of any size.

Tasks first reduce their own links to forests of stars (a bounded number at a
time). Then two steps alternate until nothing changes: every node's larger
neighbours are tied to its smallest neighbour, and every node and its smaller
neighbours are tied to the smallest of them. Groups of any shape fold in a few
rounds, no task needs a whole group, and each round is a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provender.session import written

#: Links that a task folds at a time.
HELD = 500_000
LINKS = "a bigint, b bigint"


def components(links: DataFrame) -> DataFrame:
    """Every linked node with the smallest node it reaches: ``node``, ``component``.

    ``links`` has the bigint columns ``a`` and ``b``; direction, order and repeats
    don't matter, and a link from a node to itself or with a null adds nothing.
    No links give no rows.
    """
    pairs = links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b")
    stars = written(pairs.mapInArrow(_fold, LINKS).distinct(), "links")
    before = None
    while True:
        now = stars.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("bigint")).alias("sum"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("wide")).first()
        if now.n == 0 or now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                stars.select("b", "b").distinct())
        before = now
        stars = written(_small_star(_large_star(stars)), "stars")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
    return tied.where("a <> b").distinct()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    held = 0
    for batch in batches:
        left.append(batch.column(0).to_numpy())
        right.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= HELD:
            yield stars(np.concatenate(left), np.concatenate(right))
            left, right, held = [], [], 0
    if held:
        yield stars(np.concatenate(left), np.concatenate(right))


def stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Links from each node to the smallest it reaches by these links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = smallest_reached(len(nodes), at[:len(a)], at[len(a):])
    off = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[off]), pa.array(nodes[root[off]])], names=["a", "b"])


def smallest_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1, the smallest node that each reaches."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root
