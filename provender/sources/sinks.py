"""Writers: tables, day partitions, ordered files, CSV and JSON reports."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.functions.text import drop_commas, named
from provender.operators.merge import evolve, merge_incidents
from provender.registry import Registry
from provender.sources import versioned

# Where incidents go when nothing is configured.
DEFAULT_SCHEMA, DEFAULT_TABLE = "dbo", "incidents"


def table_name(raw: str | None) -> tuple[str, str]:
    """(schema, table) of a configured name; brackets around the parts are dropped."""
    text = (raw or "").strip()
    if text.lower() in ("", "null", "undefined"):
        return DEFAULT_SCHEMA, DEFAULT_TABLE
    parts = [re.sub(r"^\[|\]$", "", p) for p in text.split(".")]
    if len(parts) == 1:
        return DEFAULT_SCHEMA, parts[0]
    return parts[0] or DEFAULT_SCHEMA, parts[-1] or DEFAULT_TABLE


def ensure_table(spark: SparkSession, table: str, registry: Registry) -> DataFrame:
    """The stored table, created empty if absent, with any missing columns added."""
    if versioned.current(spark, table) is None:
        versioned.replace_table(spark, table, spark.createDataFrame([], registry.schema()), number=1)
    return evolve(versioned.read_table(spark, table), registry)


def upsert_table(spark: SparkSession, source: DataFrame, table: str, registry: Registry, key: str, order: list[str]) -> DataFrame:
    """Merge a window into the stored table and switch to the result at once.

    Readers see the old version until the new one is whole. A run that dies before the
    switch changes nothing and can be repeated; one that merged into a version which is
    no longer the last fails instead of losing the other's rows.
    """
    stored = ensure_table(spark, table, registry)
    number = versioned.current(spark, table).number
    merged = merge_incidents(stored, source, registry, key, order)
    versioned.replace_table(spark, table, merged, number + 1)
    return versioned.read_table(spark, table)


def append_mirror(rows: DataFrame, path: str) -> None:
    """Changed items, filed by type."""
    rows.write.mode("append").partitionBy("type").parquet(path)


def append_jobs(jobs: DataFrame, path: str) -> None:
    jobs.write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, strip_commas: bool = False, quote_all: bool = False, order: Sequence[str] = ()) -> None:
    """Report CSV; ``strip_commas`` removes commas from text values.

    With ``order`` the rows are sorted as a whole: by range into files whose names, in
    alphabetical order, are the order of their rows.
    """
    df = df.orderBy(*[named(c) for c in order]) if order else df
    if strip_commas:
        text = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
        df = df.select(*[drop_commas(named(c)).alias(c) if c in text else named(c) for c in df.columns])
    df.write.mode("overwrite").csv(path, header=True, quoteAll=quote_all, escape='"', emptyValue="")


def day_partition(df: DataFrame, ts: str, path: str) -> None:
    """Report rows by day, so a rolling report reads only the days it needs.

    The days that ``df`` has are replaced, others stay: a report that runs again for a day
    writes it anew.
    """
    df.withColumn("day", named(ts).cast("date")).repartition("day").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Days of a report; missing days are simply absent."""
    return spark.read.parquet(path).where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
