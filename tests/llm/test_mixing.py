import random

import pytest

from provender.llm import mixing


def water(sizes, weights, share=1.5, limit=2.0):
    """Targets by sharing the excess again until none is above its stop."""
    fixed, goal = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in fixed]
        if not open_:
            return fixed
        level = (goal - sum(fixed.values())) / sum(weights[s] for s in open_)
        over = [s for s in open_ if weights[s] * level > limit * sizes[s]]
        if not over:
            return fixed | {s: weights[s] * level for s in open_}
        fixed |= {s: limit * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken_words(spark, seed):
    pick = random.Random(seed)
    names = [None, "b", "a", "é", "z", "A"][: 3 + seed]
    rows = [(i, "w " * min(int(pick.paretovariate(1)), 400), pick.choice(names), "extra", 1) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _key string, target int")
    out = mixing.mix(df.repartition(4)).collect()
    assert len(out) == len(rows) and {r._key for r in out} == {"extra"}
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    wanted = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for s in sizes:
        mine = [r for r in out if r.source == s]
        assert all(abs(r.target - wanted[s]) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - wanted[s]) <= 2 * max(r.size for r in mine)
    again = {r.doc_id: r.copies for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in out}


def test_emitted_rows(spark):
    df = spark.createDataFrame([(i, "one two", "s", 5) for i in range(40)], "doc_id long, text string, source string, n long")
    mixed = mixing.mix(df)
    assert mixing.emitted(mixed).columns == df.columns
    assert mixing.emitted(mixed).count() == sum(r.copies for r in mixed.collect())


def test_empty_null_and_repeated(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, None), (None, "", "a"), (1, "x y", "b")] + [(1, "x y", "b")] * 5
    out = mixing.mix(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == len(rows)
    assert {(r.source, r.taken) for r in out if r.source in (None, "a")} == {(None, 0), ("a", 0)}


def test_emitted_rows_keep_clashing_columns(spark):
    mixed = mixing.mix(spark.createDataFrame([(1, "a b", "s", "kept"), (2, "a", "s", "too")], "doc_id long, text string, source string, _copy string"))
    out = mixing.emitted(mixed)
    assert out.columns == ["doc_id", "text", "source", "_copy"]
    assert {r._copy for r in out.collect()} <= {"kept", "too"}
