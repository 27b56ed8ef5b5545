"""Landed incident CSV files: header sets, positional read, snapshots."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provender.functions.text import named, strip
from provender.operators.headers import cell_counts, positional, union_by_header_set
from provender.operators.rows import conform
from provender.registry import Registry
from provender.session import written

def _open(line: Column) -> Column:
    """Whether a line breaks off inside quotes."""
    return F.regexp_count(line, F.lit('"')) % 2 == 1


def _first_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, line``: the first line of every file, read by Spark wherever the files lie.

    The lines of a file's first block are one task's, in order; each task keeps one per file.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))
    return lines.where("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("line"))


def _first_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First records of files whose header row has line breaks inside quotes."""
    seen: dict[str, str] = {}
    done: set[str] = set()
    for batch in batches:
        for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if file in done:
                continue
            seen[file] = f"{seen[file]}\n{value}" if file in seen else value
            if seen[file].count('"') % 2 == 0:
                done.add(file)
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([seen.pop(file)])], names=["file", "line"])


def header_sets(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """Group files by header row: (headers, paths).

    Files are grouped in a table; the driver gets one row per distinct header row, with
    the paths that are read together by it.
    """
    first = written(_first_lines(spark, path), "headers")
    whole = first.where(~_open(F.col("line")))
    cut = [r.file for r in first.where(_open(F.col("line"))).select("file").collect()]  # rare, and no more than the listing
    if cut:
        lines = spark.read.text([unquote(f) for f in cut]).select(
            F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("block"))
        whole = whole.unionByName(lines.where("block = 0").drop("block").mapInArrow(_first_records, "file string, line string"))
    groups = whole.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found: dict[tuple, list[str]] = {}
    for row in groups.collect():
        headers = tuple(next(csv.reader(io.StringIO(row.line.removeprefix("\ufeff"))), []))
        found.setdefault(headers, []).extend(unquote(f) for f in row.files)
    return [(list(h), sorted(p)) for h, p in sorted(found.items()) if h]


def read_window_files(spark: SparkSession, paths: Sequence[str], headers: Sequence[str],
                      multi_line: bool = True) -> DataFrame:
    """Files of one header set, read by position and named by that header row.

    ``multi_line`` allows line breaks inside cells but makes a file one task;
    switch it off for files that have none.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(headers))])
    raw = spark.read.csv(list(paths), schema=schema, header=True, enforceSchema=True, multiLine=multi_line,
                         quote='"', escape='"', mode="PERMISSIVE")
    raw = raw.select("*", F.col("_metadata.file_path").alias("_meta_file"))
    blank_as_empty = raw.select("_meta_file", *[F.coalesce(F.col(f"c{i}"), F.lit("")).alias(f"c{i}")
                                                for i in range(len(headers))])
    return positional(blank_as_empty, headers)


def read_incidents(spark: SparkSession, path: str | Sequence[str], registry: Registry,
                   overrides: Sequence[tuple[str, str]] = (), multi_line: bool = True,
                   renames: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """All landed files below ``path`` as typed incident rows; ``renames`` as in ``union_by_header_set``."""
    parts = [(h, read_window_files(spark, p, h, multi_line)) for h, p in header_sets(spark, path)]
    if not parts:
        return conform(spark.createDataFrame([], T.StructType([])).select(
            *[F.lit(None).cast("string").alias(n) for n in registry.active_names()]), registry)
    return conform(union_by_header_set(parts, registry, overrides, renames), registry)


def corpus_counts(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> tuple[DataFrame, list[str]]:
    """Rows and filled cells per (file, header) of a landed corpus, and all headers seen."""
    parts, seen = [], []
    for headers, paths in header_sets(spark, path):
        df = read_window_files(spark, paths, headers, multi_line)
        names = [c for c in df.columns if c != "_meta_file"]
        seen += [n for n in names if n not in seen]
        parts.append(cell_counts(df, F.col("_meta_file"), names))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, seen


def read_snapshot(spark: SparkSession, path: str, key: str, columns: Sequence[str]) -> DataFrame:
    """A table export for a dry run: the word NULL is null, blank text stays blank."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', nullValue="\u0000", emptyValue="")
    return raw.where(strip(named(key)) != "").select(strip(named(key)).alias(key), *[snapshot_text(F.coalesce(named(c), F.lit(""))).alias(c) for c in columns])


def snapshot_text(c: Column) -> Column:
    text = strip(c)
    return F.when(F.upper(text) != "NULL", text)


def whitelist_header(spark: SparkSession, path: str) -> list[str] | None:
    """Header of an export that limits the target columns; None if it is missing."""
    try:
        found = header_sets(spark, path)
    except Exception as error:  # a missing file means no whitelist
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return found[0][0] if found else None


__all__ = ["corpus_counts", "header_sets", "read_incidents", "read_snapshot", "read_window_files",
           "snapshot_text", "whitelist_header"]
