import numpy as np
import pytest

from provender.llm import embeddings


def by_hand(rows, least=0.93):
    ok = [(i, label, np.array(v, dtype=float)) for i, v, label in rows
          if i is not None and label is not None and v is not None and None not in v
          and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    links = {k: set() for k in range(len(ok))}
    for p, (_, la, a) in enumerate(ok):
        for q in range(p):
            _, lb, b = ok[q]
            if la == lb and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                links[p].add(q)
                links[q].add(p)
    out, seen = [], {}
    for p in range(len(ok)):
        if p not in seen:
            todo, group = [p], {p}
            while todo:
                for q in links[todo.pop()] - group:
                    group.add(q)
                    todo.append(q)
            seen |= {g: min(ok[x][0] for x in group) for g in group}
        out.append((ok[p][0], len(links[p]), seen[p]))
    return sorted(out)


def made(seed, n=500, width=16, labels=3, groups=40):
    r = np.random.default_rng(seed)
    base = r.normal(size=(groups, width))
    x = base[r.integers(0, groups, n)] + r.normal(size=(n, width)) * r.choice([0, .1, .25, 1.5], n)[:, None]
    return [(int(i), [float(np.float32(c)) for c in v], int(r.integers(0, labels))) for i, v in enumerate(x)]


def run(spark, rows, block):
    df = spark.createDataFrame([(i, v, label, True) for i, v, label in rows],
                               "vec_id long, embedding array<float>, label int, kept boolean").repartition(5)
    out = embeddings.near_embeddings(df, 0.93, block).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)
    return out


@pytest.mark.parametrize("block", [1024, 16, 60])
def test_links_and_components(spark, block):
    rows = made(block)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in run(spark, rows, block)) == by_hand(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, [2.0, 4.0], 0), (4, v, None), (5, None, 0), (6, [0.0, 0.0], 0),
            (7, [float("nan"), 1.0], 0), (8, [None, 1.0], 0), (9, [1.0, 2.0, 0.0], 0), (10, [], 0), (11, v, 1),
            (12, [float("inf"), 1.0], 0), (None, v, 0), (13, [3e38, 3e38], 2), (14, [3e38, 3e38], 2), (15, [-0.0, 1.0], 3),
            (16, [0.0, 1.0], 3)]
    out = run(spark, rows, 1024)
    assert len(out) == len(rows)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in out if r.vec_id is not None)
    linked = by_hand(rows)
    rest = [(i, 0, i) for i, *_ in rows if i is not None and i not in {x[0] for x in linked}]
    assert got == sorted(linked + rest)


def test_empty_table(spark):
    assert run(spark, [], 8) == []
