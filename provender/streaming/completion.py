"""Completion of work items, their time limit, and superseding of open ones, as streams.

Completion keeps keyed state: per work item the last final status of each attachment, and
an event-time timer at its time limit. A final status replaces the attachment's earlier
one (an extraction may be tried again); a repeat changes nothing. State ends with the
limit, so it is bounded by the work items of one limit. Rows are taken in any order and
never held together, so a work item with very many statuses costs its attachments only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from provender.functions.text import named
from provender.operators.documents import FINAL_STATUSES
from provender.operators.ordered import with_next
from provender.sources import versioned

BATCH = "batch"
#: Keyed state of this kind is kept by the RocksDB provider.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTCOMES = "job_id string, outcome string, n_final bigint, n_success bigint, chosen string"
_JOB = "expected bigint, deadline bigint, n_final bigint, n_success bigint, done boolean"
_ATTACHMENT = "status string, at bigint, first bigint"


def _trigger(writer, interval: str | None):
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """The store that keyed state needs, for queries started within."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


class Completion(StatefulProcessor):
    """Watches one work item: done when all its attachments are final, too late at its limit."""

    def __init__(self, limit: str) -> None:
        self.limit = int(pd.Timedelta(limit).total_seconds() * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", _JOB)
        self.attachments = handle.getMapState("attachments", "attachment string", _ATTACHMENT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        expected, deadline, n_final, n_success, done = self.job.get() if self.job.exists() else (None, None, 0, 0, False)
        told: dict[str, tuple] = {}  # attachments of this batch: each is read at most once and written at most once
        for frame in rows:
            if deadline is None:
                deadline = int(frame["started"].iloc[0]) + self.limit
                self.handle.registerTimer(deadline // 1000)
            n = frame["n_expected"].max()
            if not pd.isna(n):
                expected = max(int(n), expected or 0)
            if done:
                continue
            final = frame[frame["status"].isin(FINAL_STATUSES) & frame["attachment"].notna() & (frame["at"] < deadline)]
            for attachment, status, at in zip(final["attachment"].tolist(), final["status"].tolist(), final["at"].tolist(), strict=True):
                known = told.get(attachment) or self._stored(attachment)
                kept = (status, at) if known is None or (at, status) > (known[1], known[0]) else known[:2]
                if known is None:
                    n_final += 1
                n_success += (kept[0] == "success") - (known is not None and known[0] == "success")
                told[attachment] = (*kept, at if known is None else min(at, known[2]))
        complete = not done and n_final > 0 and n_final >= (n_final if expected is None else expected)
        self.job.update((expected, deadline, n_final, n_success, done or complete))
        if complete:
            yield self._outcome(key, "complete", n_final, n_success, told)
            # What is left is a mark, so that repeats are known as such until the limit.
            self.attachments.clear()
        else:
            for attachment, value in told.items():
                self.attachments.updateValue((attachment,), value)

    def _stored(self, attachment: str) -> tuple | None:
        return self.attachments.getValue((attachment,)) if self.attachments.containsKey((attachment,)) else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.job.exists():
            _, _, n_final, n_success, done = self.job.get()
            if not done:
                yield self._outcome(key, "timeout", n_final, n_success, {})
        self.attachments.clear()
        self.job.clear()

    def _outcome(self, key, outcome: str, n_final: int, n_success: int, told: dict[str, tuple]) -> pd.DataFrame:
        """``told`` is newer than what is stored."""
        seen = {k[0]: v for k, v in self.attachments.iterator()} | told
        chosen = min(((v[2], k) for k, v in seen.items() if v[0] == "success"), default=(0, None))[1]
        return pd.DataFrame({"job_id": [key[0]], "outcome": [outcome], "n_final": [n_final], "n_success": [n_success],
                             "chosen": [chosen]})


def outcomes(statuses: DataFrame, limit: str = "24 hours", late: str = "0 seconds") -> DataFrame:
    """One row per work item that completes or runs out of time, as a stream.

    ``statuses``: ``job_id, attachment, status, n_expected, started, ts``; any row opens
    its work item, one without an attachment does nothing else. ``n_expected`` may be
    null: then the attachments seen are all. A status counts before ``started`` plus
    ``limit``, the last one (by ``ts``, then status) of each attachment. A work item is
    ``complete`` at the end of the batch in which its attachments are all final, once;
    ``chosen`` is the success that became final first. It is a ``timeout`` when the
    watermark passes its limit before that. ``late`` is what rows may arrive behind.
    Ids may be of any type and come out as text.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    marked = statuses.withWatermark("ts", late).select(
        F.col("job_id").cast("string").alias("job_id"), F.col("attachment").cast("string").alias("attachment"), "status",
        F.col("n_expected").cast("bigint").alias("n_expected"), micros("started").alias("started"), micros("ts").alias("at"), "ts")
    return marked.groupBy("job_id").transformWithStateInPandas(
        Completion(limit), OUTCOMES, outputMode="append", timeMode="eventtime")


def start_completion(statuses: DataFrame, out: str, checkpoint: str, limit: str = "24 hours", late: str = "0 seconds",
                     interval: str | None = None) -> StreamingQuery:
    """Write the outcomes of work items below ``out``, each once."""
    with _state_store(statuses.sparkSession):
        writer = outcomes(statuses, limit, late).writeStream.format("parquet").outputMode("append").option("path", out).option(
            "checkpointLocation", checkpoint)
        return _trigger(writer, interval).start()


def start_supersede(jobs: DataFrame, chunk: Column, order: Sequence[str], store: str, checkpoint: str,
                    interval: str | None = None) -> StreamingQuery:
    """Write each batch's jobs with the newer job that cancels them.

    ``jobs``: ``doc_id, job_id`` and the order columns. A batch's first job of a
    document also cancels the document's open job of earlier batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, opened = batch.sparkSession, f"{store}/open"
        told = versioned.current(spark, opened)
        if told is not None and batch_id <= told.batch:
            return  # a repeat of a batch that is stored
        linked = with_next(batch, ["doc_id"], chunk, order, ["job_id"]).select(
            "doc_id", "job_id", F.col("next_job_id").alias("cancelled_by"), F.col("next_job_id").isNull().alias("last"))
        first = batch.groupBy("doc_id").agg(
            F.min_by("job_id", F.struct(*[named(c) for c in order])).alias("cancelled_by"))
        only = versioned.buckets_of(first, ["doc_id"], spark, opened)
        # Only the buckets of this batch's documents are read.
        before = versioned.read_current(spark, opened, ["doc_id"], only, schema=batch.select("doc_id", "job_id").schema)
        carried = before.join(first, "doc_id").select("doc_id", "job_id", "cancelled_by", F.lit(False).alias("last"))
        folder = f"{store}/jobs/{BATCH}={batch_id:012d}"
        linked.unionByName(carried).write.mode("overwrite").parquet(folder)
        still = spark.read.parquet(folder).where("last").select("doc_id", "job_id")
        versioned.put_rows(spark, opened, still, ["doc_id"], batch_id)

    writer = jobs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def cancellations(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/jobs").where("cancelled_by is not null").select("doc_id", "job_id", "cancelled_by")
