"""Routing of changed documents as a stream.

Each micro-batch of change events is cut to those that carry a mirrored document, joined
with the partners and open jobs as they stand at that moment, and routed. The side tables
are asked for anew per batch, so a partner that is resolved between two batches counts in
the second.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from provender.operators.documents import is_supported, triage

BATCH = "batch"


def triggers(mirror: Column) -> Column:
    """Whether a change event starts the handling of a document: it carries the mirrored object."""
    return mirror.isNotNull()


def routed(events: DataFrame, partners: DataFrame, open_jobs: DataFrame) -> DataFrame:
    """The mirrored documents of change events with their route.

    ``events``: ``doc_id, business_id`` and ``mirror``, a struct of ``version, deleted,
    type_name, status, draft, us``. ``partners``: ``business_id, masterid``; ``open_jobs``:
    ``doc_id, open_jobs``, one row per id each. Events without a mirror are dropped.
    """
    docs = events.where(triggers(F.col("mirror"))).select("doc_id", "business_id", "mirror.*")
    known = docs.join(partners, "business_id", "left").join(open_jobs, "doc_id", "left").withColumn(
        "open_jobs", F.coalesce("open_jobs", F.lit(0)))
    return known.withColumn("route", triage(
        F.col("deleted"), F.col("type_name"), F.col("status"), is_supported(F.col("type_name")), F.col("draft"),
        F.col("masterid").isNotNull(), F.col("us"), F.col("open_jobs")))


def start_triage(events: DataFrame, partners: Callable[[SparkSession], DataFrame], open_jobs: Callable[[SparkSession], DataFrame],
                 out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Write the routed documents of each batch to a folder of its own; a repeated batch replaces its folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        routed(batch, partners(spark), open_jobs(spark)).write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id:012d}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
