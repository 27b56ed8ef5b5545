"""Change capture and triage over a stream of landed items.

Each micro-batch is reduced to the latest row per key and compared with the stored
versions. The mirror is a bucketed table with one current row per key: a batch reads only
the buckets of its own keys. The changes of each batch are also written to a folder of
their own; a batch that is run again after a failure replaces that folder, and the mirror
takes each batch once (exactly once).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from provender.functions.text import named
from provender.operators.merge import content_hash, latest_per_key
from provender.sources import versioned

BATCH = "batch"
#: Sub-folders of a store: current rows by key, and what each batch changed.
MIRROR, CHANGES = "mirror", "changes"


def start_capture(
    items: DataFrame,
    key: str,
    order: Sequence[str],
    compare: Sequence[str],
    store: str,
    checkpoint: str,
    then: Callable[[DataFrame, int], DataFrame] | None = None,
    preexisting_handled: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Write only new and changed items to ``store``, one folder per batch.

    ``then`` maps the changed items of a batch before they are written (for
    example adds a triage route); it runs once per batch, so side tables it
    reads are current. ``preexisting_handled`` marks the items of the very
    first batch as already handled. ``interval`` polls on; without it the query
    ends when all landed files are read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, mirror = batch.sparkSession, f"{store}/{MIRROR}"
        latest = latest_per_key(batch, [key], order).withColumn("version", content_hash(compare)).persist()
        told = versioned.current(spark, mirror)
        if told is not None and batch_id <= told.batch:
            latest.unpersist()
            return  # a repeat of a batch that is stored
        only = versioned.buckets_of(latest, [key], spark, mirror)
        old = versioned.read_current(spark, mirror, [key], only, [key, "version"], latest.schema).withColumnsRenamed(
            {key: "_key", "version": "_version"})
        changed = latest.join(old, named(key).eqNullSafe(F.col("_key")), "left").withColumn(
            "change", F.when(F.col("_version").isNull(), "added").when(F.col("_version") != F.col("version"), "changed")
        ).where("change is not null").drop("_key", "_version")
        if then is not None:
            changed = then(changed, batch_id)
        handled = F.lit(preexisting_handled and batch_id == 0)
        folder = f"{store}/{CHANGES}/{BATCH}={batch_id:012d}"
        changed.withColumn("handled", handled).withColumn("at_batch", F.lit(batch_id).cast("bigint")).write.mode(
            "overwrite").parquet(folder)
        latest.unpersist()
        versioned.put_rows(spark, mirror, spark.read.parquet(folder), [key], batch_id)

    writer = items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def changes(spark: SparkSession, store: str) -> DataFrame:
    """All new and changed items with the batch that brought them."""
    return spark.read.option("basePath", f"{store}/{CHANGES}").parquet(f"{store}/{CHANGES}").drop(BATCH)


def current_state(spark: SparkSession, store: str, key: str) -> DataFrame:
    """The mirror as it stands: the last written row per key."""
    return versioned.read_current(spark, f"{store}/{MIRROR}", [key])
