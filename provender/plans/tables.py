"""The shared input tables of the query catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from provender.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
