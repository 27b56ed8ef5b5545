import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from provender.llm import topk


def by_hand(rows, k):
    ok = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for p, (i, a) in enumerate(ok):
        if i is not None and i % 10 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), j)
                            for q, (j, b) in enumerate(ok) if q != p and len(a) == len(b))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, k=10):
    df = spark.createDataFrame([(i, v, 9, "x") for i, v in rows], "vec_id long, embedding array<float>, row int, rank string")
    return sorted(tuple(r) for r in topk.top_k(df.repartition(4), F.col("vec_id") % 10 == 0, k).collect())


@pytest.mark.parametrize("size", [1.0, 1e-4, 3e4])
def test_same_as_brute_force(spark, size, monkeypatch):
    r = np.random.default_rng(5)
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(r.normal(size=(300, 12)) * size)]
    rows += [(i + 300, rows[0][1]) for i in range(25)]  # ties
    monkeypatch.setattr(topk, "STRIPES", 3)
    assert run(spark, rows) == by_hand(rows, 10)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
            (5, [0.0, 0.0]), (10, [1.0, 2.0, 3.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (7, [-1.0, 0.5]), (30, [])]
    assert run(spark, rows, 3) == by_hand(rows, 3)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_bounds_hold():
    r = np.random.default_rng(2)
    x = r.integers(-5000, 5000, (200, 8))
    low = x.min(axis=0)
    step = np.maximum(1, -(-(x.max(axis=0) - low + 1) // 256))
    q = r.integers(-900, 900, (7, 8))
    lower, upper = topk.bound(q, ((x - low) // step).astype(np.uint8), low, step)
    exact = q @ x.T
    assert (lower <= exact).all() and (exact <= upper).all()


def test_components_whose_products_leave_64_bits(spark):
    rows = [(0, [1e16, 1.0]), (100, [1e16, 2.0]), (200, [1e5, 1.0]), (1, [1.0, 1.0]), (2, [-1e6, 3.0]), (3, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, 10).collect()]
    x = {i: [math.floor(1024 * c) for c in v] for i, v in rows if max(map(abs, v)) * 1024 <= 2**31 / 2**0.5}
    assert set(x) == {200, 1, 2}
    assert sorted(got) == sorted((200, n + 1, i, s) for n, (s, i) in enumerate(sorted(
        ((sum(a * b for a, b in zip(x[200], x[i], strict=True)), i) for i in (1, 2)), key=lambda t: (-t[0], t[1]))))
