"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within the allowed distance
have a segment that differs in few bits, so each fingerprint enumerates a small
Hamming ball around each of its segments, fetches the fingerprints that have one of
those values in their own segment table, and the whole distance is verified.

Equal fingerprints are one entry. Fingerprints whose balls share a value and that
agree elsewhere lie around one point, within twice the radius of each other; the
smallest and the largest around each point are tied before anything is paired, and
entries that are tied already need no pair. So a crowd of near copies costs about its
size, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.llm.components import components
from provender.session import written

SEED = 42
BITS = 64
#: Shingles hashed and counted at a time, so a very long text needs no more memory.
STEP = 1 << 16


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Bits set in over half of the hashes of a text's word shingles, as an unsigned number."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    size = min(shingle, len(words))
    n = len(words) - size + 1
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, STEP):
        part = words[at:at + STEP + size - 1]
        joined = map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False)) if size > 1 else part
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), dtype="<u8", count=min(STEP, n - at))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text_key: Column | None = None) -> DataFrame:
    """``doc_id`` and the signed 64-bit ``fingerprint`` of every row's whole ``text``; ``text_key`` goes along if given."""
    names = ["doc_id", "fingerprint"] + (["text_key"] if text_key is not None else [])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names=names)

    more = [] if text_key is None else [text_key.alias("text_key")]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *more) \
        .mapInArrow(made, "doc_id bigint, fingerprint bigint" + (", text_key string" if more else ""))


def near_fingerprints(points: DataFrame, distance: int, segments: int = 2) -> DataFrame:
    """Components of distinct fingerprints under links of at most ``distance`` bits.

    ``points`` has distinct bigint ``fingerprint``; returns ``fingerprint`` and
    ``root``, equal for fingerprints that reach each other. One that has no link is
    its own root.
    """
    if not 0 <= distance < BITS or not 1 <= segments <= BITS:
        raise ValueError("distance and segments must lie below the number of bits")
    radius = distance // segments
    # Few and narrow rows that become many: deal them out before they do.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = points.select("fingerprint").repartition(parts, "fingerprint").withColumn("tie", F.col("fingerprint"))
    if radius and 2 * radius <= distance:
        around = points.select("fingerprint", F.explode(_balls(segments, radius, whole=True)).alias("hub"))
        ends = around.groupBy("hub").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"))
        tied = components(ends.where("a <> b").select("a", "b")).withColumnRenamed("node", "fingerprint")
        points = points.drop("tie").join(tied, "fingerprint", "left").select(
            "fingerprint", F.coalesce("component", "fingerprint").alias("tie"))
        points = written(points, "points").repartition(parts, "fingerprint")

    # Values of different segments lie in different bits, so a value stands for its segment too.
    entries = points.select(F.col("fingerprint").alias("b"), F.col("tie").alias("b_tie"),
                            F.explode(_balls(segments, 0)).alias("value"))
    asked = points.select(F.col("fingerprint").alias("a"), F.col("tie").alias("a_tie"),
                          F.explode(_balls(segments, radius)).alias("value"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    found = asked.join(entries, "value").where((F.col("a_tie") != F.col("b_tie")) & apart)
    crossed = components(found.select(F.col("a_tie").alias("a"), F.col("b_tie").alias("b")))
    return points.join(crossed.withColumnRenamed("node", "tie"), "tie", "left").select(
        "fingerprint", F.coalesce("component", "tie").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, segments: int = 2) -> DataFrame:
    """Every row of ``docs`` as ``doc_id, fingerprint, component_id``.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the smallest
    ``doc_id`` reachable over links of at most ``distance`` differing bits. A null or
    empty text has fingerprint zero, which links like any other. A null id gets a
    row, but is never a component's id unless the component has no other; repeated
    rows keep their number. An empty table gives no rows; extra columns are left out.
    """
    marked = written(fingerprints(docs, shingle), "fingerprints")
    groups = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = written(near_fingerprints(groups, distance, segments), "roots")
    least = groups.join(roots, "fingerprint").groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = roots.join(least, "root").select("fingerprint", "component_id")
    return marked.join(of_print, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def kept_documents(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component: that with the smallest id, then fingerprint, then hash of the text.

    An id that repeats with texts of different components has a row in each it is the
    smallest of. Rows with a null id have no place in an order; they stay.
    """
    text_key = F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit(""))
    marked = written(fingerprints(docs, shingle, text_key), "fingerprints")
    roots = _roots(marked, distance)
    row = F.struct("doc_id", "fingerprint", "text_key")
    keep = marked.where("doc_id is not null").join(roots, "fingerprint").groupBy("root").agg(F.min(row).alias("row")).select(
        F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key"))
    whole = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("_id"), text_key.alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    # Rows equal in id and text may differ elsewhere; which of them stays follows from their contents.
    once = whole.join(keep, ["_id", "_key"]).groupBy("_id", "_key").agg(
        F.min_by("_row", F.sha2(F.to_json("_row").cast("binary"), 256)).alias("_row"))
    return once.select("_row.*").unionByName(docs.where(F.col("doc_id").isNull()))


def _roots(marked: DataFrame, distance: int, segments: int = 2) -> DataFrame:
    return written(near_fingerprints(marked.select("fingerprint").distinct(), distance, segments), "roots")


def _bounds(segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _cut(first: int, width: int) -> int:
    return _signed(((1 << width) - 1) << first)


def _balls(segments: int, radius: int, whole: bool = False) -> Column:
    """Values of every segment within ``radius`` bits of the fingerprint's own, as an array.

    Of two values that differ, one has 0 where they first differ; only that one
    reaches out, so each pair is asked for once. ``whole`` keeps the rest of the
    fingerprint around the segment's value.
    """
    own, values = F.col("fingerprint"), []
    for first, width in _bounds(segments):
        kept = own if whole else own.bitwiseAND(F.lit(_cut(first, width)))
        values.append(kept)
        for r in range(1, radius + 1):
            for bits in combinations(range(first, first + width), r):
                flipped = kept.bitwiseXOR(F.lit(_signed(sum(1 << b for b in bits))))
                values.append(F.when(own.bitwiseAND(F.lit(_signed(1 << bits[0]))) == 0, flipped))
    return F.array_compact(F.array(*values))
