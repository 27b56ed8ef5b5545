import os
import random

import pandas as pd
from pyspark.sql import functions as F

from provender.operators.ordered import time_chunk
from provender.streaming import capture as SC
from provender.streaming import completion as ST
from provender.streaming.triage import start_triage

SCHEMA = "item bigint, n bigint, v string, ts timestamp"


def batches(spark, folder, parts):
    """Land parts as files one after the other; each is a micro-batch."""
    def land(i):
        spark.createDataFrame(parts[i], SCHEMA.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{folder}/{i}")
    return land


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_capture_resumes_and_writes_changes_only(spark, tmp_path):
    src, store, mark = (str(tmp_path / n) for n in ("src", "store", "mark"))
    land = batches(spark, src, [[(1, 1, "a", "2026-01-01"), (1, 2, "b", "2026-01-02"), (2, 1, "x", "2026-01-01")],
                                [(1, 3, "b", "2026-01-03"), (2, 2, "y", "2026-01-03"), (3, 1, "q", "2026-01-03")]])
    run = lambda: SC.start_capture(stream(spark, src), "item", ["ts", "n"], ["v"], store, mark, preexisting_handled=True).awaitTermination()
    land(0)
    run()
    assert sorted((r.item, r.v, r.change, r.handled) for r in SC.current_state(spark, store, "item").collect()) == [
        (1, "b", "added", True), (2, "x", "added", True)]
    land(1)
    run()
    run()  # nothing new: nothing is written
    rows = SC.changes(spark, store)
    assert sorted((r.item, r.v, r.change) for r in rows.where("at_batch > 0").collect()) == [(2, "y", "changed"), (3, "q", "added")]
    assert rows.where("at_batch > 0 and handled").count() == 0


def test_capture_reads_side_tables_per_batch(spark, tmp_path):
    src, store, mark = (str(tmp_path / n) for n in ("src", "store", "mark"))
    land = batches(spark, src, [[(1, 1, "a", "2026-01-01")], [(2, 1, "b", "2026-01-01")]])
    flags = iter([True, False])
    land(0)
    land(1)
    SC.start_capture(stream(spark, src), "item", ["n"], ["v"], store, mark,
                     then=lambda df, _: df.withColumn("auto", F.lit(next(flags)))).awaitTermination()
    assert sorted((r.item, r.auto) for r in SC.current_state(spark, store, "item").collect()) in ([(1, True), (2, False)], [(1, False), (2, True)])


def test_supersede_across_batches_equals_one_pass(spark, tmp_path):
    src, store, mark = (str(tmp_path / n) for n in ("src", "store", "mark"))
    rng = random.Random(2)
    jobs = [(rng.choice([1, 1, 2, 3]), i, "", f"2026-01-01 {i // 60:02d}:{i % 60:02d}:00") for i in range(90)]
    land = batches(spark, src, [jobs[:30], jobs[30:60], jobs[60:]])
    for i in range(3):
        land(i)
        s = stream(spark, src).select(F.col("item").alias("doc_id"), F.col("n").alias("job_id"), "ts")
        ST.start_supersede(s, time_chunk(F.col("ts"), 600), ["ts", "job_id"], store, mark).awaitTermination()
    last, want = {}, set()
    for doc, job, _, _ in jobs:
        if doc in last:
            want.add((doc, last[doc], job))
        last[doc] = job
    got = [tuple(r) for r in ST.cancellations(spark, store).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def statuses(spark, folder, parts, expected=2, first=0):
    """Land parts of (job, attachment, status, time); jobs start with the day."""
    for i, part in enumerate(parts, first):
        df = spark.createDataFrame(part, "job_id string, attachment string, status string, ts string")
        df.select("*", F.lit(expected).cast("int").alias("n_expected")).withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
            "started", F.date_trunc("day", "ts")).coalesce(1).write.parquet(f"{folder}/{i}")
    schema = "job_id string, attachment string, status string, ts timestamp, n_expected int, started timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def outcomes(spark, out):
    return sorted(tuple(r) for r in spark.read.schema(ST.OUTCOMES).parquet(out).collect())


def test_completion(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    stream = statuses(spark, src, [
        [("one", "a", "success", "2026-01-01 00:00:00"), ("one", "a", "success", "2026-01-01 00:00:01"),
         ("two", "x", "failure", "2026-01-01 00:00:02"), ("two", None, None, "2026-01-01 00:00:03")],
        [("one", "b", "running", "2026-01-01 00:01:00"), ("two", "x", "success", "2026-01-01 00:01:01"),
         ("retried", "m", "success", "2026-01-01 00:01:02")],
        # The last status counts: the retry of m failed; what is older than m's status changes nothing.
        [("one", "c", "failure", "2026-01-01 00:02:00"), ("retried", "m", "failure", "2026-01-01 00:02:01"),
         ("retried", "n", "success", "2026-01-01 00:02:02")],
        # Repeats after completion.
        [("one", "c", "failure", "2026-01-01 00:02:30"), ("two", "y", "failure", "2026-01-01 00:03:00")]])
    ST.start_completion(stream, out, mark, late="1 hour").awaitTermination()
    assert outcomes(spark, out) == [("one", "complete", 2, 1, "a"), ("retried", "complete", 2, 1, "n"), ("two", "complete", 2, 1, "x")]


def test_time_limit_and_restart(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    first = [[("late", "a", "success", "2026-01-01 01:00:00"), ("done", "a", "success", "2026-01-01 01:00:00")],
             [("done", "b", "success", "2026-01-01 02:00:00"), ("empty", None, None, "2026-01-01 02:00:00")]]
    ST.start_completion(statuses(spark, src, first), out, mark).awaitTermination()
    assert outcomes(spark, out) == [("done", "complete", 2, 2, "a")]
    # A restart goes on where the last run ended; the next days move the clock past the limit.
    stream = statuses(spark, src, [[("new", "a", "success", "2026-01-03 00:00:00")], [("new", "b", "failure", "2026-01-03 01:00:00")]], first=2)
    ST.start_completion(stream, out, mark).awaitTermination()
    assert outcomes(spark, out) == [("done", "complete", 2, 2, "a"), ("empty", "timeout", 0, 0, None),
                                    ("late", "timeout", 1, 1, "a"), ("new", "complete", 2, 1, "a")]


def test_statuses_after_the_limit_do_not_count(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    stream = statuses(spark, src, [[("j", "a", "success", "2026-01-01 00:00:00")]], expected=None)
    ST.start_completion(stream, out, mark, limit="1 hour").awaitTermination()
    assert outcomes(spark, out) == [("j", "complete", 1, 1, "a")]
    other = tmp_path / "b"
    df = spark.createDataFrame([("k", "a", "success", "2026-01-01 05:00:00", 1, "2026-01-01")], "job_id string, attachment string, status string, ts string, n_expected int, started string")
    df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("started", F.col("started").cast("timestamp")).write.parquet(f"{other}/0")
    stream = spark.readStream.schema(spark.read.parquet(f"{other}/0").schema).parquet(f"{other}/*")
    ST.start_completion(stream, str(tmp_path / "out2"), str(tmp_path / "mark2"), limit="1 hour").awaitTermination()
    assert outcomes(spark, str(tmp_path / "out2")) == [("k", "timeout", 0, 0, None)]


def test_text_ids(spark, tmp_path):
    src, store, mark = (str(tmp_path / n) for n in ("src", "store", "mark"))
    land = batches(spark, src, [[(1, 1, "a", "2026-01-01")], [(1, 2, "b", "2026-01-02"), (2, 1, "c", "2026-01-02")], [(1, 3, "b", "2026-01-03")]])
    for i in range(3):
        land(i)
        s = stream(spark, src).withColumn("item", F.concat(F.lit("id-"), F.col("item")))
        SC.start_capture(s, "item", ["n"], ["v"], store, mark).awaitTermination()
        jobs = stream(spark, src).select(F.concat(F.lit("d"), F.col("item")).alias("doc_id"), F.concat(F.lit("j"), F.col("n"), F.col("item")).alias("job_id"), "ts")
        ST.start_supersede(jobs, time_chunk(F.col("ts"), 600), ["ts", "job_id"], f"{store}-jobs", f"{mark}-jobs").awaitTermination()
    assert sorted((r.item, r.v) for r in SC.current_state(spark, store, "item").collect()) == [("id-1", "b"), ("id-2", "c")]
    assert sorted((r.item, r.at_batch) for r in SC.changes(spark, store).collect()) == [("id-1", 0), ("id-1", 1), ("id-2", 1)]
    assert sorted(tuple(r) for r in ST.cancellations(spark, f"{store}-jobs").collect()) == [("d1", "j11", "j21"), ("d1", "j21", "j31")]


def test_triage_stream_reads_partners_per_batch(spark, tmp_path):
    mirror = "struct<version:int,deleted:boolean,type_name:string,status:string,draft:boolean,us:boolean>"
    doc = (1, False, "GFSI Audit", "Awaiting Approval", False, False)
    schema = f"doc_id string, business_id string, mirror {mirror}"
    for i, part in enumerate([[("d1", "b1", doc), ("d2", "b1", None)], [("d3", "b1", doc)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/src/{i}")
    known = iter([[], [("b1", "p1")]])
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src/*")
    start_triage(events, lambda s: s.createDataFrame(next(known), "business_id string, masterid string"),
                 lambda s: s.createDataFrame([], "doc_id string, open_jobs long"), f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    routes = [r.route for r in spark.read.parquet(f"{tmp_path}/out").orderBy("batch").collect()]
    assert routes == ["diagnostic", "queue"]


class Kept:
    """A state of one work item that counts its calls."""

    def __init__(self):
        self.value, self.rows, self.calls = None, {}, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def containsKey(self, key):
        self.calls += 1
        return key in self.rows

    def getValue(self, key):
        self.calls += 1
        return self.rows[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.rows[key] = value

    def iterator(self):
        return iter(self.rows.items())

    def clear(self):
        self.rows, self.value = {}, None

    def registerTimer(self, at):
        pass


def test_state_is_asked_once_an_attachment(spark):
    """Thousands of statuses of two attachments in a batch take a few calls of the state, with the same outcome."""
    watch = ST.Completion("24 hours")
    watch.handle, watch.job, watch.attachments = Kept(), Kept(), Kept()
    frame = pd.DataFrame({"attachment": ["a", "b"] * 2000, "status": ["failure", "success"] * 2000, "n_expected": 3, "started": 0,
                          "at": range(4000)})
    assert list(watch.handleInputRows(("j",), iter([frame, frame]), None)) == []
    assert watch.attachments.calls <= 6
    assert watch.attachments.rows == {("a",): ("failure", 3998, 0), ("b",): ("success", 3999, 1)}
    last = pd.DataFrame({"attachment": ["c"], "status": ["success"], "n_expected": [None], "started": 0, "at": [0]})
    done = next(watch.handleInputRows(("j",), iter([last]), None))
    assert done.iloc[0].tolist() == ["j", "complete", 3, 2, "c"]
