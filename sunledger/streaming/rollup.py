"""Live aggregates over a stream of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BATCH = "rollup_batch"
PANEL_HOURS = T.StructType(
    [
        T.StructField("hour", T.TimestampType()),
        T.StructField("panel_id", T.StringType()),
        T.StructField("readings", T.LongType()),
        T.StructField("total_production_kw", T.DecimalType(18, 3)),
        T.StructField("peak_production_kw", T.DecimalType(8, 3)),
        T.StructField("valid_readings", T.LongType()),
        T.StructField(BATCH, T.LongType()),
    ]
)


def panel_hours(readings: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Readings of each panel and hour; the state of an hour goes ``lateness`` after its end."""
    return (
        readings.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", "1 hour"), "panel_id")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.sum("production_kw").cast("decimal(18,3)").alias("total_production_kw"),
            F.max("production_kw").cast("decimal(8,3)").alias("peak_production_kw"),
            F.count_if(F.col("is_valid")).alias("valid_readings"),
        )
        .selectExpr("window.start AS hour", "* EXCEPT (window)")
    )


def start_rollup(readings: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the hours up to date: each trigger writes the panel hours that changed, and only those.

    A batch replaces its own sub-folder as a whole, so it may run again.  Closed
    hours leave the state; what comes later than the watermark is not counted.
    """
    spark = readings.sparkSession
    spark.createDataFrame([], PANEL_HOURS).write.mode("ignore").partitionBy(BATCH).parquet(folder)

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch}")

    return (
        panel_hours(readings)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def hourly_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The fleet per hour from the latest state of every panel hour; panels are counted exactly."""
    latest = F.max_by(F.struct(*PANEL_HOURS.names[2:-1]), BATCH).alias("s")
    states = spark.read.schema(PANEL_HOURS).parquet(folder).groupBy("hour", "panel_id").agg(latest)
    return states.groupBy("hour").agg(
        F.sum("s.readings").alias("readings"),
        F.count("panel_id").alias("active_panels"),
        F.sum("s.total_production_kw").alias("total_production_kw"),
        F.max("s.peak_production_kw").alias("peak_production_kw"),
        F.sum("s.valid_readings").alias("valid_readings"),
    )


def live_windows(
    readings: DataFrame, length: str = "30 minutes", step: str = "5 minutes", lateness: str = "1 hour"
) -> DataFrame:
    """Sliding windows of the last minutes for a dashboard.

    One aggregation, for the complete and update modes, which show open windows.  There a stream cannot
    count distinct values exactly: ``active_panels`` is a sketch.  Over a table it is exact.
    :func:`closed_windows` counts exactly in a stream.
    """
    return (
        readings.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", length, step))
        .agg(
            F.count(F.lit(1)).alias("readings"),
            _panels(readings).alias("active_panels"),
            F.sum("production_kw").alias("total_production_kw"),
            F.max("production_kw").alias("peak_production_kw"),
            F.count_if(F.col("is_valid")).alias("valid_readings"),
        )
        .selectExpr("window.start AS window_start", "window.end AS window_end", "* EXCEPT (window)")
    )


def _panels(readings: DataFrame) -> Column:
    if readings.isStreaming:
        return F.approx_count_distinct("panel_id")
    return F.count_distinct("panel_id")


def closed_windows(
    readings: DataFrame, length: str = "30 minutes", step: str = "5 minutes", lateness: str = "1 hour"
) -> DataFrame:
    """The windows of :func:`live_windows`, each once, with the panels counted exactly.

    Panels are counted exactly, also over a stream: readings are first added up per window and panel,
    then per window.  On a stream these are two chained stateful aggregations under one watermark, for the
    append mode: a window appears once, when the watermark has passed its end; the state of a window is one
    row per panel until then.  Readings without a panel count as readings.
    """
    per_panel = (
        readings.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", length, step), "panel_id")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.sum("production_kw").alias("total_production_kw"),
            F.max("production_kw").alias("peak_production_kw"),
            F.count_if(F.col("is_valid")).alias("valid_readings"),
        )
    )
    return (
        per_panel.groupBy("window")
        .agg(
            F.sum("readings").alias("readings"),
            F.count("panel_id").alias("active_panels"),
            F.sum("total_production_kw").alias("total_production_kw"),
            F.max("peak_production_kw").alias("peak_production_kw"),
            F.sum("valid_readings").alias("valid_readings"),
        )
        .selectExpr("window.start AS window_start", "window.end AS window_end", "* EXCEPT (window)")
    )


def start_closed_windows(readings: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None, **how) -> StreamingQuery:
    """Append each window of :func:`closed_windows` to the table ``folder``, once."""
    return (
        closed_windows(readings, **how)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
