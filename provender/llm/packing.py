"""Packing without padding: documents cut into pieces of binary length.

A document of ``n`` ids becomes ``n // width`` pieces of the full width, then one
piece for every set bit of the rest, longest first. Each piece is a sequence by
itself, so no sequence crosses documents and none is padded; sequences of equal
length form a bucket, from which batches of one shape are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provender.llm.tokens import encoder

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
#: Documents encoded at a time.
STEP = 256


def binary_lengths(n: int, width: int) -> list[int]:
    """Powers of two that sum to n, the width at most, longest first."""
    rest = n % width
    bits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [width] * (n // width) + bits


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, width: int = 2048) -> DataFrame:
    """One row per piece: where it lies in its document, its ids and its sequence.

    ``ids`` holds little-endian unsigned 32-bit ids. ``sequence_id`` is unique: the
    bucket in the top bits, then the task, then the place in the task's bucket; its
    ``offset`` is 0, as a piece fills its sequence. Nothing is shuffled.

    A null or empty text gives the end id alone. Repeated rows are packed as often
    as they occur, each with its own sequences. An empty table gives no rows; extra
    columns are left out.
    """
    if width < 1 or width & (width - 1):
        raise ValueError("width must be a power of two")
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, used, encode = TaskContext.get().partitionId(), {}, encoder(tokenizer).encode
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                rows = batch.slice(at, STEP)
                out = []
                for doc_id, ids in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist()), strict=True):
                    ids += end
                    total, start = len(ids) // 4, 0
                    for length in binary_lengths(total, width):
                        place = used[length] = used.get(length, -1) + 1
                        sequence = length.bit_length() - 1 << 58 | part << 32 | place
                        out.append((doc_id, start, length, ids[4 * start:4 * (start + length)], total, sequence, 0))
                        start += length
                yield _batch(out)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(pieces, SCHEMA)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store sequences by length: one folder holds sequences of one shape."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
