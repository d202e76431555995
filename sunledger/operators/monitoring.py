"""Pipeline monitoring: freshness, volume, health scores, alert decision, live numbers."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.constants import AlertThresholds
from sunledger.functions.clock import hours_between, on_day, recent, visible
from sunledger.functions.semantics import (
    decimal_mean,
    exact_mean,
    exact_sum,
    one_row,
    percentage,
    present,
)
from sunledger.operators.anomalies import CRITICAL, MISSING, OPEN, WARNING
from sunledger.operators.quality import _has_rows, _per_table, _rows, latest_rows

# Limits and points of the two health scores
FRESH_POINTS = ((1, 30), (6, 20), (24, 10))
ANOMALY_POINTS, CRITICAL_COST, WARNING_COST = 40, 5, 2
QUALITY_POINTS = ((98, 30), (95, 25), (90, 20), (80, 10))
HEALTH_LEVELS = ((90, "EXCELLENT"), (70, "GOOD"), (50, "FAIR"))
SCORE_LOWEST, DEDUCTION_LOWEST = "CRITICAL", "POOR"
STALE_HOURS, DELAYED_HOURS = 24, 6
LOW_VOLUME_PER_HOUR = 100

# Texts of the deductions and of the alert
STALE_DEDUCTION = "Stale data: -30 (%.1f hours)"
DELAY_DEDUCTION = "Data delay: -10 (%.1f hours)"
ANOMALY_DEDUCTION = "Anomalies: -%d (%d critical real, %d missing, %d warning)"
POOR_DEDUCTION = "Poor data quality: -20 (%.1f%%)"
FAIR_DEDUCTION = "Fair data quality: -10 (%.1f%%)"
EMPTY_DEDUCTION = "Missing tables: -%d (%d tables empty)"
CRITICAL_REASON = "%d critical anomalies"
WARNING_REASON = "%d warnings"
DELAY_REASON = "Data delayed by %.1f hours"
QUALITY_REASON = "Low data quality: %.1f%%"
ALERT_HEADLINE, QUIET_HEADLINE = "Alert triggered: ", "No action needed - all systems normal"
ALERT_SUMMARY = "Summary: %d critical, %d warnings, %.1fh delay, %.1f%% quality"


def _moment(as_of: datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def _age_hours(as_of: datetime, ts: Column) -> Column:
    return hours_between(_moment(as_of), ts)


def freshness(tables: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Hours since the last record of each table; an empty table is stale."""
    age = F.col("hours")
    return (
        _per_table(
            {name: visible(df, as_of) for name, df in tables.items()},
            F.max("timestamp").alias("last_record"),
        )
        .withColumn("hours", _age_hours(as_of, F.col("last_record")))
        .orderBy(age.asc_nulls_last(), "table_name")
        .select(
            "table_name",
            "last_record",
            F.round(age, 2).alias("hours_since_last_record"),
            F.when(age < 1, "Real-time")
            .when(age < 6, "Slight delay")
            .when(age < 24, "Batch mode")
            .otherwise("Stale data")
            .alias("status"),
        )
    )


def volume(tables: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Records of the last 24 hours per table."""
    count = F.col("records_last_24h")
    per_hour = count.cast("decimal(18,0)") / F.lit(24)
    return (
        _per_table(
            {n: recent(df, as_of, timedelta(hours=24)) for n, df in tables.items()},
            _rows().alias("records_last_24h"),
        )
        .select(
            "table_name",
            "records_last_24h",
            F.round(per_hour, 0).cast("bigint").alias("avg_per_hour"),
            F.when(count == 0, "No data")
            .when(per_hour < LOW_VOLUME_PER_HOUR, "Low volume")
            .otherwise("Normal")
            .alias("status"),
        )
        .orderBy(count.desc(), "table_name")
    )


def panel_health(readings: DataFrame, as_of: datetime) -> DataFrame:
    """Online, intermittent and offline panels, the healthy ones first."""
    age = _age_hours(as_of, F.col("last_seen"))
    status = F.when(age < 1, "Online").when(age < 6, "Intermittent").otherwise("Offline")
    rank = F.when(age < 1, 1).when(age < 6, 2).otherwise(3)
    return (
        visible(readings, as_of)
        .groupBy("panel_id")
        .agg(
            _rows().alias("total_readings"),
            F.round(decimal_mean(F.col("production_kw")), 2).alias("avg_production_kw"),
            F.max("timestamp").alias("last_seen"),
        )
        .withColumn("status", status)
        .orderBy(rank, F.col("panel_id").asc_nulls_last())
    )


def quality_by_day(daily_panel: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    valid, invalid = F.col("total_valid"), F.col("total_invalid")
    return (
        _since_day(daily_panel, as_of, days)
        .groupBy("date")
        .agg(
            exact_mean(F.col("data_quality_pct")).alias("avg_quality"),
            F.sum("valid_readings").alias("total_valid"),
            F.sum("invalid_readings").alias("total_invalid"),
        )
        .withColumn("overall_quality", percentage(valid, valid + invalid))
        .orderBy(F.col("date").desc())
    )


def pipeline_lag(
    readings: DataFrame, silver_solar: DataFrame, daily_panel: DataFrame, as_of: datetime
) -> DataFrame:
    """How far silver trails bronze (minutes) and how old the gold day is (hours)."""
    return (
        visible(readings, as_of)
        .agg(F.max("timestamp").alias("bronze_latest"))
        .withColumn("silver_latest", visible(silver_solar, as_of).agg(F.max("timestamp")).scalar())
        .withColumn("gold_latest", daily_panel.agg(F.max("date")).scalar())
        .withColumns(
            {
                "bronze_to_silver_minutes": hours_between(
                    F.col("silver_latest"), F.col("bronze_latest")
                )
                * 60,
                "gold_freshness_hours": _age_hours(
                    as_of, F.col("gold_latest").cast("timestamp_ntz")
                ),
            }
        )
    )


def _open_counts(anomalies: DataFrame) -> DataFrame:
    critical = F.col("severity") == CRITICAL
    missing = F.col("anomaly_type") == MISSING
    return anomalies.where(F.col("resolution_status") == OPEN).agg(
        F.count_if(critical).alias("critical"),
        F.count_if(critical & ~missing).alias("critical_real"),
        F.count_if(critical & missing).alias("critical_missing"),
        F.count_if(F.col("severity") == WARNING).alias("warning"),
    )


def _vitals(
    readings: DataFrame,
    anomalies: DataFrame,
    daily_panel: DataFrame,
    as_of: datetime,
    quality_days: int,
) -> DataFrame:
    """One row: hours since the last reading, open anomaly counts, mean quality."""
    quality = _since_day(daily_panel, as_of, quality_days).agg(
        exact_mean(F.col("data_quality_pct"))
    )
    return (
        visible(readings, as_of)
        .agg(F.max("timestamp").alias("last_reading"))
        .select(
            _age_hours(as_of, F.col("last_reading")).alias("hours"),
            one_row(_open_counts(anomalies)).alias("open"),
            quality.scalar().alias("quality"),
        )
    )


def _level(score: Column, lowest: str) -> Column:
    chain = F.when(F.lit(False), "")
    for limit, name in HEALTH_LEVELS:
        chain = chain.when(score >= limit, name)
    return chain.otherwise(lowest)


def health_score(
    readings: DataFrame, anomalies: DataFrame, daily_panel: DataFrame, as_of: datetime
) -> DataFrame:
    """Points form: freshness 30 + anomalies 40 + quality 30.

    No reading at all gives no freshness points, no quality data no quality points.
    """
    fresh = F.when(F.lit(False), 0)
    for limit, points in FRESH_POINTS:
        fresh = fresh.when(F.col("hours") < limit, points)
    good = F.when(F.lit(False), 0)
    for limit, points in QUALITY_POINTS:
        good = good.when(F.coalesce("quality", F.lit(0.0)) > limit, points)
    cost = F.col("open.critical") * CRITICAL_COST + F.col("open.warning") * WARNING_COST
    total = F.col("freshness_score") + F.col("anomaly_score") + F.col("quality_score")
    return (
        _vitals(readings, anomalies, daily_panel, as_of, quality_days=7)
        .select(
            fresh.otherwise(0).alias("freshness_score"),
            F.greatest(F.lit(0), F.lit(ANOMALY_POINTS) - cost).alias("anomaly_score"),
            good.otherwise(0).alias("quality_score"),
        )
        .withColumn("total_score", total)
        .withColumn("health_status", _level(F.col("total_score"), SCORE_LOWEST))
    )


def health_score_deductions(
    readings: DataFrame,
    anomalies: DataFrame,
    daily_panel: DataFrame,
    tables: Mapping[str, DataFrame],
    as_of: datetime,
) -> DataFrame:
    """Deduction form: 100 minus penalties, floored at 0; ``failed`` below 50.

    An empty table of readings counts as fresh here; emptiness costs 5 points
    per table instead.
    """
    hours = F.coalesce("hours", F.lit(0.0))
    counts = F.col("open")
    empty = sum(
        (F.when(_has_rows(df), 0).otherwise(1) for df in tables.values()), start=F.lit(0)
    )
    scored = (
        _vitals(readings, anomalies, daily_panel, as_of, quality_days=7)
        .withColumn("empty_tables", empty)
        .select(
            hours.alias("hours"),
            "open",
            "quality",
            "empty_tables",
            F.when(hours > STALE_HOURS, 30).when(hours > DELAYED_HOURS, 10).otherwise(0)
            .alias("freshness_penalty"),
            F.least(
                F.lit(40),
                counts["critical_real"] * 5 + counts["critical_missing"] + counts["warning"],
            ).alias("anomaly_penalty"),
            F.when(F.col("quality") < 80, 20).when(F.col("quality") < 90, 10).otherwise(0)
            .alias("quality_penalty"),
            (F.col("empty_tables") * 5).alias("empty_penalty"),
        )
    )
    penalties = [
        F.col(f"{name}_penalty") for name in ("freshness", "anomaly", "quality", "empty")
    ]
    fresh, anomaly, quality, missing = penalties
    deductions = present(
        [
            F.when(fresh == 30, F.format_string(STALE_DEDUCTION, "hours")).when(
                fresh == 10, F.format_string(DELAY_DEDUCTION, "hours")
            ),
            F.when(
                anomaly > 0,
                F.format_string(
                    ANOMALY_DEDUCTION,
                    anomaly,
                    counts["critical_real"],
                    counts["critical_missing"],
                    counts["warning"],
                ),
            ),
            F.when(quality == 20, F.format_string(POOR_DEDUCTION, "quality")).when(
                quality == 10, F.format_string(FAIR_DEDUCTION, "quality")
            ),
            F.when(
                missing > 0,
                F.format_string(EMPTY_DEDUCTION, missing, "empty_tables"),
            ),
        ]
    )
    return (
        scored.withColumn(
            "health_score", F.greatest(F.lit(0), F.lit(100) - sum(penalties, start=F.lit(0)))
        )
        .withColumn("deductions", deductions)
        .withColumn("health_status", _level(F.col("health_score"), DEDUCTION_LOWEST))
        .select(
            "health_score",
            "health_status",
            (F.col("health_score") < 50).alias("failed"),
            "freshness_penalty",
            "anomaly_penalty",
            "quality_penalty",
            "empty_penalty",
            "deductions",
        )
    )


def alert_decision(
    readings: DataFrame,
    anomalies: DataFrame,
    daily_panel: DataFrame,
    as_of: datetime,
    limits: AlertThresholds = AlertThresholds(),
) -> DataFrame:
    """One row: severity, exit code (2 critical, 1 warning, 0 none), reasons and message.

    No reading counts as no delay; no quality data, or a mean of exactly 0, as 100 %.
    """
    vitals = _vitals(readings, anomalies, daily_panel, as_of, limits.quality_days).select(
        F.col("open.critical").alias("critical_count"),
        F.col("open.warning").alias("warning_count"),
        F.coalesce("hours", F.lit(0.0)).alias("hours_delayed"),
        F.coalesce(F.nullif(F.col("quality"), F.lit(0.0)), F.lit(100.0)).alias("avg_quality"),
    )
    critical, warning = F.col("critical_count"), F.col("warning_count")
    delay, quality = F.col("hours_delayed"), F.col("avg_quality")
    is_critical = critical >= limits.critical_anomalies
    reasons = present(
        [
            F.when(is_critical, F.format_string(CRITICAL_REASON, critical)),
            F.when(
                warning >= limits.warning_anomalies, F.format_string(WARNING_REASON, warning)
            ),
            F.when(
                delay > limits.data_delay_hours,
                F.format_string(DELAY_REASON, delay),
            ),
            F.when(
                quality < limits.quality_pct,
                F.format_string(QUALITY_REASON, quality),
            ),
        ]
    )
    headline = F.when(
        F.size("reasons") > 0,
        F.concat(F.lit(ALERT_HEADLINE), F.array_join("reasons", ", ")),
    ).otherwise(QUIET_HEADLINE)
    summary = F.format_string(
        ALERT_SUMMARY,
        critical, warning, delay, quality,
    )
    return (
        vitals.withColumn("reasons", reasons)
        .withColumn(
            "severity",
            F.when(is_critical, "CRITICAL").when(F.size("reasons") > 0, "WARNING").otherwise("INFO"),
        )
        .withColumn(
            "exit_code",
            F.when(F.col("severity") == "CRITICAL", 2)
            .when(F.col("severity") == "WARNING", 1)
            .otherwise(0),
        )
        .withColumn("message", F.concat(headline, F.lit("\n"), summary))
    )


def ingest_recency(
    tables: Mapping[str, DataFrame], as_of: datetime, span: timedelta = timedelta(minutes=15)
) -> DataFrame:
    """Rows and newest timestamp of the last minutes, per table."""
    return _per_table(
        {name: recent(df, as_of, span) for name, df in tables.items()},
        _rows().alias("count"),
        F.max("timestamp").alias("latest"),
    )


def ingest_alive(
    tables: Mapping[str, DataFrame], as_of: datetime, span: timedelta = timedelta(hours=1)
) -> DataFrame:
    """One row: does at least one table have rows of the last hour?"""
    return ingest_recency(tables, as_of, span).agg(
        F.sum("count").alias("recent_rows"), (F.max("count") > 0).alias("alive")
    )


def daily_summary(readings: DataFrame, as_of: datetime) -> DataFrame:
    """Today: readings, mean and total production, mean temperature (no row without readings)."""
    return (
        on_day(readings, as_of.date(), as_of)
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            _rows().alias("readings"),
            exact_mean(F.col("production_kw")).alias("avg_production"),
            exact_sum(F.col("production_kw")).alias("total_production"),
            exact_mean(F.col("temperature_c")).alias("avg_temp"),
        )
    )


def live_numbers(
    readings: DataFrame, as_of: datetime, span: timedelta = timedelta(minutes=5)
) -> DataFrame:
    """One row: mean production, active panels and mean temperature of the last minutes."""
    return recent(readings, as_of, span).agg(
        exact_mean(F.col("production_kw")).alias("avg_production"),
        F.count_distinct("panel_id").alias("active_panels"),
        exact_mean(F.col("temperature_c")).alias("avg_temperature"),
    )


def recent_series(
    readings: DataFrame, as_of: datetime, span: timedelta = timedelta(minutes=30)
) -> DataFrame:
    """Readings of the last minutes: the per-panel series of a live chart."""
    return recent(readings, as_of, span).select(
        "timestamp", "panel_id", "production_kw", "temperature_c"
    )


def latest_readings(readings: DataFrame, as_of: datetime, k: int = 10) -> DataFrame:
    shown = visible(readings, as_of).select(
        "event_id", "timestamp", "panel_id", "production_kw", "temperature_c"
    )
    return latest_rows(shown, k, tie="event_id")


def _since_day(daily_panel: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return daily_panel.where(F.col("date") >= F.lit(as_of.date() - timedelta(days=days)))
