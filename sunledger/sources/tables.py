"""Table scans and sinks: Parquet by default, CSV, JSON and JDBC at the edges."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions.clock import PARTITION_COLUMN
from sunledger.schemas import SITE_WEATHER_CSV


def read_table(spark: SparkSession, location: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a given schema saves the footer read and fixes the types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(location)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: object,
    upper: object,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Partitioned scan of a table in an external database (driver jar on the classpath)."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )


def read_site_weather_csv(
    spark: SparkSession, location: str, schema: T.StructType = SITE_WEATHER_CSV
) -> DataFrame:
    """Site weather file with a header; types are declared, not inferred.

    ``enforceSchema`` is off, so a file with other columns fails instead of
    being read by position.
    """
    return spark.read.schema(schema).csv(location, header=True, enforceSchema=False)


def append_table(df: DataFrame, location: str, ts: str | None = "timestamp") -> None:
    """Append to a table, partitioned by event date when ``ts`` is given."""
    _dated(df, ts).write.mode("append").partitionBy(*_partition(ts)).parquet(location)


def refresh_table(df: DataFrame, location: str, ts: str | None = None) -> None:
    """Full refresh: the new content replaces the whole table once it is complete.

    It is written beside the table and takes its place by renaming, so a job that fails leaves the old
    table as it was, and no reader meets a half-written one.
    """
    made = f"{location.rstrip('/')}.next-{uuid.uuid4().hex}"
    _dated(df, ts).write.partitionBy(*_partition(ts)).parquet(made)
    swap(df.sparkSession, made, location)


def swap(spark: SparkSession, made: str, location: str) -> None:
    """Put the finished folder ``made`` in the place of ``location``."""
    path, old = spark._jvm.org.apache.hadoop.fs.Path(location), f"{location.rstrip('/')}.old-{uuid.uuid4().hex}"
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    if files.exists(path) and not files.rename(path, as_path(old)):
        raise OSError(f"cannot move {location} away")
    if not files.rename(as_path(made), path):
        raise OSError(f"cannot move {made} to {location}")
    files.delete(as_path(old), True)


def refresh_days(
    df: DataFrame, location: str, ts: str = "timestamp", days: Sequence[date] = ()
) -> None:
    """Incremental refresh: the event dates that occur in ``df`` are replaced.

    Those of ``days`` for which ``df`` has no rows are emptied; which days were written is observed
    while they are written.
    """
    written = Observation()
    dated = _dated(df, ts).observe(written, F.collect_set(PARTITION_COLUMN).alias("days"))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*_partition(ts)).parquet(location)
    for day in set(days) - set(written.get["days"] or ()):
        delete(df.sparkSession, f"{location}/{PARTITION_COLUMN}={day.isoformat()}")


def exists(spark: SparkSession, location: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def make_folder(spark: SparkSession, location: str) -> None:
    """An empty folder; an existing one stays as it is, also when several writers make it at once."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def folder_names(spark: SparkSession, location: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


def delete(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_csv(df: DataFrame, location: str) -> None:
    """CSV with a header; moments keep their microseconds."""
    precise = {f"timestamp{kind}Format": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for kind in ("", "NTZ")}
    df.write.mode("overwrite").options(**precise).csv(location, header=True)


def write_json(df: DataFrame, location: str) -> None:
    """One JSON document per row; nested structs and arrays stay nested."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(location)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def _dated(df: DataFrame, ts: str | None) -> DataFrame:
    """Rows clustered by event date for the writer.

    The rebalance hint lets AQE merge small days and cut a big day into several
    tasks, so there is neither a file per task and day nor one task per big day.
    """
    if ts is None:
        return df
    return df.withColumn(PARTITION_COLUMN, F.to_date(ts)).hint("rebalance", PARTITION_COLUMN)


def _partition(ts: str | None) -> list[str]:
    return [] if ts is None else [PARTITION_COLUMN]
