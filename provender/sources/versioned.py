"""Tables of Parquet folders behind a manifest: atomic switches and hash-bucketed current rows.

A table is a folder with ``data/<piece>`` folders and ``versions/<number>.json`` manifests.
A manifest names the pieces that are the table. Writers first write a new piece, which no
reader sees, and then create the next manifest; creating it is the switch. Two writers
cannot create the same number, so the later one fails and nothing is lost. A writer that
dies before the switch leaves the old version as it is; one that dies while it writes the
manifest leaves a file that does not parse, which readers skip.

A *bucketed* table keeps one current row per key. Rows lie in buckets by the hash of the
key; a batch reads only the buckets of its own keys and adds a piece to each. A bucket
with too many pieces is written anew with its current rows alone, so what a batch reads
stays in proportion to the rows that are current, however long the history.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provender.functions.text import named

BUCKETS, CHAIN = 64, 8
BUCKET, ORDER = "_bucket", "_piece"


class Conflict(RuntimeError):
    """Another writer made this version first."""


@dataclass(frozen=True)
class Manifest:
    """One version: its pieces, or for a bucketed table the pieces of each bucket, oldest first."""

    number: int
    schema: T.StructType
    pieces: list[str] = field(default_factory=list)
    buckets: dict[int, list[str]] = field(default_factory=dict)
    count: int = 0
    batch: int = -1

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(), "pieces": self.pieces,
                           "buckets": {str(b): p for b, p in self.buckets.items()}, "count": self.count, "batch": self.batch})

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["number"], T.StructType.fromJson(raw["schema"]), raw["pieces"],
                        {int(b): p for b, p in raw["buckets"].items()}, raw["count"], raw["batch"])


def _file_system(spark: SparkSession, path: str):
    """Hadoop's view of a path: whatever store Spark reads, with Spark's credentials."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def current(spark: SparkSession, table: str) -> Manifest | None:
    """The newest whole manifest, None for a table that has none."""
    system, folder = _file_system(spark, f"{table}/versions")
    if not system.exists(folder):
        return None
    names = sorted((s.getPath().getName() for s in system.listStatus(folder)), reverse=True)
    for name in names:
        stream = system.open(_file_system(spark, f"{table}/versions/{name}")[1])
        try:
            return Manifest.from_json(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:  # its writer died
            continue
        finally:
            stream.close()
    return None


def commit(spark: SparkSession, table: str, manifest: Manifest) -> None:
    """Make a manifest the current one; fails if its number is taken."""
    system, at = _file_system(spark, f"{table}/versions/{manifest.number:012d}.json")
    try:
        stream = system.create(at, False)
    except Exception as error:  # the gateway wraps every error of the file system alike
        if system.exists(at):
            raise Conflict(f"version {manifest.number} of {table} exists") from error
        raise
    stream.write(bytearray(manifest.to_json().encode()))
    stream.close()


def _next_number(spark: SparkSession, table: str) -> int:
    system, folder = _file_system(spark, f"{table}/versions")
    if not system.exists(folder):
        return 1
    return 1 + max((int(s.getPath().getName().removesuffix(".json")) for s in system.listStatus(folder)), default=0)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The current version of a table that is replaced as a whole."""
    now = current(spark, table)
    if now is None:
        raise FileNotFoundError(f"{table} has no version")
    if not now.pieces:
        return spark.createDataFrame([], now.schema)
    return spark.read.schema(now.schema).parquet(*[f"{table}/data/{p}" for p in now.pieces])


def replace_table(spark: SparkSession, table: str, rows: DataFrame, number: int | None = None) -> Manifest:
    """Write ``rows`` as the next version. They may be read from the current one.

    ``number`` is the version that the rows were made for; a writer that read version n
    passes n + 1, and fails if somebody else made it meanwhile.
    """
    piece = f"whole-{uuid.uuid4().hex}"
    number = _next_number(spark, table) if number is None else number
    rows.write.parquet(f"{table}/data/{piece}")
    made = Manifest(number, rows.schema, [piece])
    commit(spark, table, made)
    return made


def bucket_of(keys: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*[named(k) for k in keys]), F.lit(count)).cast("int")


def bucket_paths(spark: SparkSession, table: str, only: Sequence[int] | None = None) -> list[str]:
    """Folders that hold the rows of these buckets, of all without."""
    now = current(spark, table)
    return [] if now is None else _paths(table, now, only)


def _paths(table: str, now: Manifest, only: Sequence[int] | None) -> list[str]:
    chosen = sorted(now.buckets) if only is None else [b for b in only if b in now.buckets]
    return [f"{table}/data/{piece}/{BUCKET}={b}" for b in chosen for piece in now.buckets[b]]


def read_current(spark: SparkSession, table: str, keys: Sequence[str], only: Sequence[int] | None = None,
                 columns: Sequence[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The current row of each key, of some buckets and with some columns if asked for.

    ``schema`` is that of a table which has no version yet.
    """
    now = current(spark, table)
    if now is None and schema is None:
        raise FileNotFoundError(f"{table} has no version")
    names = list(columns) if columns is not None else [f.name for f in (now.schema if now else schema) if f.name != ORDER]
    paths = _paths(table, now, only) if now else []
    if not paths:
        wanted = T.StructType([f for n in names for f in (now.schema if now else schema) if f.name == n])
        return spark.createDataFrame([], wanted)
    rows = spark.read.schema(now.schema).parquet(*paths)
    return _latest(rows, keys, names)


def _latest(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    row = F.max_by(F.struct(*[named(n) for n in names]), ORDER)
    return rows.groupBy(*[named(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(row.alias("_row")).select("_row.*")


def put_rows(spark: SparkSession, table: str, rows: DataFrame, keys: Sequence[str], batch: int,
             count: int = BUCKETS, chain: int = CHAIN) -> Manifest:
    """Make ``rows``, one per key, the current rows of their keys.

    ``batch`` numbers the writes of a stream: one that is not after the last is a repeat
    after a failure and changes nothing. ``count`` buckets are made with the first write
    and kept. A bucket with more than ``chain`` pieces is compacted on the way.
    """
    now = current(spark, table)
    if now is None:
        now = Manifest(0, T.StructType([*rows.schema.fields, T.StructField(ORDER, T.LongType())]), count=count)
    if batch <= now.batch:
        return now
    piece = f"batch-{batch:012d}-{uuid.uuid4().hex}"
    path = f"{table}/data/{piece}"
    _write_buckets(rows.withColumn(ORDER, F.lit(batch).cast("bigint")), keys, now.count, path)
    touched = _folders(spark, path)
    buckets = {b: list(p) for b, p in now.buckets.items()}
    for b in touched:
        buckets.setdefault(b, []).append(piece)
    full = [b for b in touched if len(buckets[b]) > chain]
    if full:
        whole = f"compact-{batch:012d}-{uuid.uuid4().hex}"
        held = spark.read.schema(now.schema).parquet(*_paths(table, replace(now, buckets=buckets), full))
        _write_buckets(_latest(held, keys, [f.name for f in now.schema]), keys, now.count, f"{table}/data/{whole}")
        for b in full:
            buckets[b] = [whole]
    made = replace(now, number=_next_number(spark, table), buckets=buckets, batch=batch)
    commit(spark, table, made)
    return made


def _write_buckets(rows: DataFrame, keys: Sequence[str], count: int, path: str) -> None:
    dealt = rows.withColumn(BUCKET, bucket_of(keys, count))
    dealt.repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Buckets that a piece has, from its folder names."""
    system, at = _file_system(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(at)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))


def buckets_of(rows: DataFrame, keys: Sequence[str], spark: SparkSession, table: str, count: int = BUCKETS) -> list[int]:
    """Buckets that the keys of ``rows`` lie in: at most as many numbers as there are buckets."""
    now = current(spark, table)
    return sorted(r[0] for r in rows.select(bucket_of(keys, now.count if now else count)).distinct().collect())


__all__ = ["BUCKETS", "CHAIN", "Conflict", "Manifest", "bucket_paths", "buckets_of", "commit", "current",
           "put_rows", "read_current", "read_table", "replace_table"]
