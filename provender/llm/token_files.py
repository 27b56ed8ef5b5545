"""Token ids as Parquet list columns that can be read in part.

Documents are written in ascending id order, one shard per range of ids. Ids are
dictionary-coded (a vocabulary fits one dictionary page), the increasing metadata
columns are delta-coded, row groups and pages are small and of fixed size, and the
writer adds page indexes, so a reader of some documents, or of the counts alone,
touches few pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from provender.llm.tokens import encoder

SCHEMA = "doc_id bigint, shard int, start_in_shard bigint, n_tokens bigint, ids array<int>"
#: Documents encoded at a time.
STEP = 256
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 128 << 10


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shards: int | None = None) -> None:
    """Write ``doc_id, shard, start_in_shard, n_tokens, ids`` in ascending id order.

    ``shards`` (default: Spark's shuffle partitions) is the number of id ranges. Rows
    with one id lie together in input order and may fill several shards, so a
    repeated id makes no hot task. A null id comes first, a null text is an empty
    one: it has the end id alone. An empty table writes files without rows; extra
    columns are left out.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = int(end_id).to_bytes(4, "little")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start, encode = TaskContext.get().partitionId(), 0, encoder(tokenizer).encode
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                rows = batch.slice(at, STEP)
                ids = [x + end for x in encode(rows.column("text").to_pylist())]
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                values = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"),
                    pa.array(np.full(len(ids), shard, dtype=np.int32)),
                    pa.array(start + bounds[:-1]),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values)),
                ], names=["doc_id", "shard", "start_in_shard", "n_tokens", "ids"])
                start += int(bounds[-1])

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    )
    (
        ordered.select("doc_id", "text").mapInArrow(encoded, SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#start_in_shard", "false")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored documents with ``start``, the ids of all documents before each.

    Offsets come from the counts alone. The broadcast table has one row per shard,
    a number the writer sets.
    """
    stored = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    )
    return stored.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids")


def with_checksum(tokens: DataFrame, name: str = "ids_crc32") -> DataFrame:
    """Replace ``ids`` by the unsigned CRC-32 of them as little-endian 32-bit integers."""
    kept = [c for c in tokens.columns if c != "ids"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            bounds = ids.offsets.to_numpy()
            raw = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(crc, pa.int64())],
                                             names=[*kept, name])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tokens.schema.fields if f.name != "ids")
    return tokens.mapInArrow(sums, f"{schema}, {name} bigint")
