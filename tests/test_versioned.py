import os

import pytest
from pyspark.sql import functions as F

from provender.sources import versioned as V


def rows(spark, pairs):
    return spark.createDataFrame([(k, v) for k, v in pairs], "k string, v long")


def stored(spark, table):
    return sorted((r.k or "", r.v) for r in V.read_current(spark, table, ["k"]).collect())


def test_replace_reads_its_own_table(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        V.read_table(spark, table)
    V.replace_table(spark, table, rows(spark, [("a", 1)]))
    V.replace_table(spark, table, V.read_table(spark, table).withColumn("v", F.col("v") + 1))
    assert [tuple(r) for r in V.read_table(spark, table).collect()] == [("a", 2)]
    V.replace_table(spark, table, rows(spark, []))
    assert V.read_table(spark, table).collect() == [] and V.current(spark, table).number == 3


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    V.replace_table(spark, table, rows(spark, [("a", 1)]))
    monkeypatch.setattr(V, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):  # the data is written, the switch is not made
        V.replace_table(spark, table, rows(spark, [("b", 2)]))
    monkeypatch.undo()
    assert len(os.listdir(f"{table}/data")) == 2
    assert [tuple(r) for r in V.read_table(spark, table).collect()] == [("a", 1)]
    # One that died while it wrote the manifest: the file is there and is not whole.
    with open(f"{table}/versions/{2:012d}.json", "w") as cut:
        cut.write('{"number": 2, "sch')
    assert [tuple(r) for r in V.read_table(spark, table).collect()] == [("a", 1)]
    V.replace_table(spark, table, rows(spark, [("c", 3)]))
    assert [tuple(r) for r in V.read_table(spark, table).collect()] == [("c", 3)] and V.current(spark, table).number == 3


def test_two_writers_of_one_version(spark, tmp_path):
    table = str(tmp_path / "t")
    V.replace_table(spark, table, rows(spark, [("a", 1)]))
    V.replace_table(spark, table, rows(spark, [("b", 1)]), number=2)
    with pytest.raises(V.Conflict):
        V.replace_table(spark, table, rows(spark, [("c", 1)]), number=2)
    assert [r.k for r in V.read_table(spark, table).collect()] == ["b"]


def test_current_rows_equal_a_dictionary(spark, tmp_path):
    import random

    pick, table, want = random.Random(1), str(tmp_path / "t"), {}
    for batch in range(7):
        put = {pick.choice([f"k{i}" for i in range(30)] + [None]): pick.randrange(100) for _ in range(10)}
        V.put_rows(spark, table, rows(spark, put.items()), ["k"], batch, count=4, chain=2)
        want |= put
        assert stored(spark, table) == sorted((k or "", v) for k, v in want.items())
    again = rows(spark, [("k1", -1)])
    V.put_rows(spark, table, again, ["k"], 6)  # a repeat of a stored batch
    assert stored(spark, table) == sorted((k or "", v) for k, v in want.items())
    only = V.buckets_of(rows(spark, [("k1", 0)]), ["k"], spark, table)
    assert len(only) == 1 and {r.k for r in V.read_current(spark, table, ["k"], only).collect()} <= set(want)


def test_bytes_read_per_batch_stay_flat(spark, tmp_path):
    table, read = str(tmp_path / "t"), []
    for batch in range(20):
        put = rows(spark, [(f"key {i}", batch * 1000 + i) for i in range(200)])
        only = V.buckets_of(put, ["k"], spark, table, count=2)
        read.append(sum(os.path.getsize(os.path.join(p, f)) for p in V.bucket_paths(spark, table, only) for f in os.listdir(p)))
        V.put_rows(spark, table, put, ["k"], batch, count=2, chain=4)
    assert max(read[10:]) <= 1.1 * max(read[1:10])
    assert len(stored(spark, table)) == 200
