"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "sunledger", **overrides: str) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE on).

    ``overrides`` use ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables and stream checkpoints that must outlive an executor.

    It lies in the shared location that the cluster names in
    ``spark.checkpoint.dir``.  Without the setting only a local session, whose
    driver is its only executor, gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sunledger-")


def materialise(df: DataFrame, purpose: str = "table") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, computed once.

    For a small result that several branches of a plan read; unlike a cache it
    is still there when executors are lost, and readers get only the columns
    they need.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
