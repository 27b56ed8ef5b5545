import random

from pyspark.sql import functions as F

from provender.operators import merge as M
from provender.operators.ordered import top_per_group, with_next, with_position, with_previous
from provender.registry import Registry

REG = Registry.of([("Id", "VARCHAR(100)", False), ("Text", "VARCHAR(max)", True), ("Need", "VARCHAR(max)", False),
                   ("N", "DECIMAL(38, 0)", True), ("Flag", "BIT", False)])
SCHEMA = "Id string, Text string, Need string, N int, Flag boolean"


def merged(spark, stored, incoming):
    number = F.col("N").cast("decimal(38,0)")
    t = spark.createDataFrame(stored, SCHEMA).withColumn("N", number)
    s = spark.createDataFrame([(*r, i) for i, r in enumerate(incoming)], SCHEMA + ", seq int").withColumn("N", number)
    out = M.merge_incidents(t, s, REG, "Id", ["seq"]).select("Id", "Text", "Need", F.col("N").cast("int"), "Flag")
    return {r.Id: tuple(r)[1:] for r in out.collect()}


def test_stored_values_survive_blanks(spark):
    out = merged(spark, [("a", "keep", "need", 5, True), ("z", "other", "n", 1, False)],
                 [("a", "", None, None, False), ("b", None, None, 7, False)])
    assert out == {"a": ("keep", "need", 5, False), "z": ("other", "n", 1, False), "b": (None, "", 7, False)}


def test_rows_of_one_key_fold_in_order(spark):
    out = merged(spark, [("a", "old", "n", 1, True)], [("a", "v1", None, 2, False), ("a", "", "m", None, False), ("a", "v3", "", None, True)])
    assert out == {"a": ("v3", "m", 2, True)}


def test_fold_equals_merging_one_by_one(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), rng.choice(["", None, "x", "y"]), rng.choice([None, "p", ""]), rng.choice([None, 1, 2]), rng.choice([True, False]))
            for _ in range(60)]
    want = {}
    for key, text, need, n, flag in rows:
        old = want.get(key, (None, "", None, None))
        want[key] = (text or old[0], need or old[1], old[2] if n is None else n, flag)
    assert merged(spark, [], rows) == want


def test_change_detection(spark):
    schema = "id int, v struct<a:int,b:array<string>>, w string"
    stored = spark.createDataFrame([(1, (1, ["x"]), None), (2, (2, ["y"]), "q"), (3, (None, []), None)], schema)
    new = spark.createDataFrame([(1, (1, ["x"]), None), (2, (2, ["z"]), "q"), (3, (None, []), "now"), (4, (4, None), None)], schema)
    got = {r.id: r.change for r in M.detect_changes(stored, new, "id", ["v", "w"]).collect()}
    assert got == {2: "changed", 3: "changed", 4: "added"}
    forced = {r.id: r.change for r in M.detect_changes(stored, new, "id", ["v", "w"], force=True).collect()}
    assert forced[1] == "forced" and len(forced) == 4


def test_evolution_ignores_case(spark):
    out = M.evolve(spark.createDataFrame([("1",)], "ID string"), REG)
    assert out.columns == ["ID", "Flag", "N", "Need", "Text"]


def test_duplicates_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, v string")
    assert [tuple(r) for r in M.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert sorted(tuple(r) for r in M.latest_per_key(df, ["k"], ["t"]).collect()) == [(1, 2, "b"), (2, 1, "c")]
    assert sorted(tuple(r) for r in M.latest_per_key(df, ["k"], ["t"], oldest=True).collect()) == [(1, 1, "a"), (2, 1, "c")]


def test_ordered_rules_with_one_huge_group(spark):
    """Chunked neighbours and positions equal the plain ones, with a third of all rows in one group."""
    rng = random.Random(3)
    keys = [0] * 200 + [rng.randrange(1, 30) for _ in range(400)]
    rng.shuffle(keys)
    rows = [(k, rng.randrange(0, 5000), i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, t int, id int")
    chunk = F.floor(F.col("t") / 100).cast("bigint")
    after = {r.id: r.next_id for r in with_next(df, ["k"], chunk, ["t", "id"], ["id"]).collect()}
    before = {r.id: r.prev_id for r in with_previous(df, ["k"], chunk, ["t", "id"], ["id"]).collect()}
    place = {r.id: (r.position, r.group_size) for r in with_position(df, ["k"], chunk, ["t", "id"]).collect()}
    groups = {}
    for k, t, i in rows:
        groups.setdefault(k, []).append((t, i))
    for g in groups.values():
        ids = [i for _, i in sorted(g)]
        for n, i in enumerate(ids):
            assert after[i] == (ids[n + 1] if n + 1 < len(ids) else None)
            assert before[i] == (ids[n - 1] if n else None)
            assert place[i] == (n + 1, len(ids))


def test_top_keeps_few_rows_per_task(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, 1).otherwise(F.col("id")))
    out = top_per_group(df, ["k"], [F.col("id").desc()], 3)
    assert [r.id for r in out.where("k = 1").orderBy("rank").collect()] == [899, 898, 897]
    assert out.count() == 103
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_window_difference(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(tuple(r) for r in M.window_difference(a, b, "k").collect()) == [(1, "left_only"), (3, "right_only")]


def test_preview(spark):
    t = spark.createDataFrame([(1, "a"), (2, None)], "k int, c string")
    s = spark.createDataFrame([(1, ""), (2, "n"), (3, "x")], "k int, c string")
    got = {r.k: tuple(r)[1:] for r in M.merge_preview(t, s, "k", ["c"]).collect()}
    assert got == {1: ("a", "", "a", False), 2: ("null", "n", "n", True), 3: ("null", "x", "x", True)}
