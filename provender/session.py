"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "provender", master: str | None = None, **conf: str) -> SparkSession:
    """A session for local runs; on a cluster use the session the cluster gives."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Every date rule here is stated in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def constant_table(spark: SparkSession, rows: Iterable[Sequence], columns: Sequence[str]) -> DataFrame:
    """A table of fixed values, known to the optimizer with its size."""
    def cell(value: object) -> str:
        if value is None or isinstance(value, bool):
            return {True: "true", False: "false", None: "null"}[value]
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    values = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names that folder. Only where it is unset (a local
    run, a test) does a temporary folder of this machine stand in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="provender-")
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, "provender", f"{purpose}-{uuid.uuid4().hex}")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage through a table in the shared folder; survives executor loss."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
