"""Anomaly detection, incremental against the anomalies already raised.

The three per-panel detectors share one aggregate over the last seven days
(:func:`panel_profile`).  Whatever can be decided per panel (already raised,
no reading low enough, not seen) is decided there, before any reading is
joined.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.clock import in_day, moment_like, on_day, recent, visible
from sunledger.functions.semantics import exact_mean, one_row, stored_mean
from sunledger.schemas import GOLD_ANOMALIES

# Names and limits of the anomaly classes
LOW = "Low Production"
CRITICAL_LOW = "Critical Low Production"
HIGH_TEMPERATURE = "High Temperature"
MISSING = "Missing Data"
DROP = "Sudden Production Drop"
CRITICAL, WARNING = "Critical", "Warning"
OPEN, RESOLVED = "Open", "Resolved"
LOOK_BACK = timedelta(days=7)
SILENCE = timedelta(hours=1)
WARNING_Z, CRITICAL_Z = 2.0, 3.0
DROP_RATIO, CRITICAL_DROP_PCT = 0.5, 70.0
RETENTION = timedelta(days=30)
RESOLVE_AFTER_DAYS = 30


def panel_profile(silver_solar: DataFrame, as_of: datetime) -> DataFrame:
    """One row per panel of the last seven days: everything the detectors need.

    One scan and one shuffle with a map-side combine, whatever a panel's share
    of the readings.
    """
    today, yesterday = as_of.date(), as_of.date() - timedelta(days=1)
    is_today = in_day(silver_solar, today)
    is_yesterday = in_day(silver_solar, yesterday)
    production = F.col("production_kw")
    valid = F.col("is_valid")
    return (
        recent(silver_solar, as_of, LOOK_BACK)
        .groupBy("panel_id")
        .agg(
            exact_mean(production, valid).alias("avg_production"),
            stored_mean(production, 8, 3, valid).alias("avg_stored"),
            F.stddev_samp(F.when(valid, production.cast("double"))).alias("stddev_production"),
            F.count_if(is_today).alias("readings_today"),
            F.min(F.when(is_today, production)).alias("min_today"),
            exact_mean(production, is_today).alias("today_avg"),
            exact_mean(production, is_yesterday).alias("yesterday_avg"),
            stored_mean(production, 8, 3, is_today).alias("today_stored"),
            stored_mean(production, 8, 3, is_yesterday).alias("yesterday_stored"),
            F.max("timestamp").alias("last_seen"),
            F.count(F.when(valid, F.col("temperature_c"))).alias("temp_n"),
            F.sum(F.when(valid, F.col("temperature_c"))).alias("temp_sum"),
            # valid temperatures have two digits before the point
            F.sum(F.when(valid, F.expr("CAST(temperature_c * temperature_c AS DECIMAL(8,2))")))
            .alias("temp_squares"),
        )
    )


def panel_stats(silver_solar: DataFrame, as_of: datetime) -> DataFrame:
    """Seven-day mean and sample deviation of the valid production of each panel."""
    return (
        recent(silver_solar, as_of, LOOK_BACK)
        .where("is_valid")
        .groupBy("panel_id")
        .agg(
            exact_mean(F.col("production_kw")).alias("avg_production"),
            F.stddev_samp(F.col("production_kw").cast("double")).alias("stddev_production"),
        )
    )


def detect_low_production(
    silver_solar: DataFrame,
    as_of: datetime,
    existing: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Readings of today (valid or not) more than two deviations below their panel's mean."""
    profile = panel_profile(silver_solar, as_of) if profile is None else profile
    # z grows with the reading: a panel has a low reading exactly if its lowest is one
    candidates = profile.where(_z(F.col("min_today")) < -WARNING_Z)
    if existing is not None:
        candidates = candidates.join(
            _raised(existing, F.col("anomaly_type").contains(LOW), as_of), "panel_id", "left_anti"
        )
    readings = on_day(silver_solar, as_of.date(), as_of).select(
        "event_id", "timestamp", "panel_id", "production_kw"
    )
    # one row per panel on the right: broadcast while it fits, else a busy panel's partition is split
    statistics = candidates.select("panel_id", "avg_production", "avg_stored", "stddev_production")
    scored = readings.join(statistics, "panel_id").withColumn("z", _z(F.col("production_kw")))
    return _as_anomalies(
        scored.where(F.col("z") < -WARNING_Z),
        as_of,
        anomaly_type=f"IF(z < -{CRITICAL_Z}D, '{CRITICAL_LOW}', '{LOW}')",
        severity=f"IF(z < -{CRITICAL_Z}D, '{CRITICAL}', '{WARNING}')",
        expected="avg_stored",
        actual="production_kw",
        deviation="try_divide(100D * (avg_production - CAST(production_kw AS DOUBLE)), avg_production)",
        identity="event_id, CAST(timestamp AS STRING)",
    )


def fleet_temperature_stats(profile: DataFrame) -> DataFrame:
    """One row: mean and sample deviation of the fleet's valid temperatures.

    From the exact sums of the panels, so the readings are not scanned again.
    """
    summed = profile.selectExpr(
        "CAST(sum(temp_n) AS DECIMAL(13,0)) AS n",
        "CAST(sum(temp_sum) AS DECIMAL(17,1)) AS s",
        "CAST(sum(temp_squares) AS DECIMAL(19,2)) AS q",
    )
    return summed.selectExpr(
        "CAST(s AS DOUBLE) / nullif(n, 0) AS avg_temp",
        "CAST(CAST(s AS DECIMAL(28,6)) / nullif(n, 0) AS DECIMAL(8,3)) AS avg_stored",
        "sqrt(CAST(n * q - s * s AS DOUBLE) / nullif(CAST(n AS DOUBLE) * CAST(n - 1 AS DOUBLE), 0)) "
        "AS stddev_temp",
    )


def detect_high_temperature(
    silver_solar: DataFrame,
    as_of: datetime,
    existing: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Readings of today more than two deviations above the fleet's mean temperature."""
    profile = panel_profile(silver_solar, as_of) if profile is None else profile
    scored = (
        on_day(silver_solar, as_of.date(), as_of)
        .select("event_id", "timestamp", "panel_id", "temperature_c")
        .withColumn("fleet", one_row(fleet_temperature_stats(profile)))
        .withColumn(
            "z",
            F.expr("try_divide(CAST(temperature_c AS DOUBLE) - fleet.avg_temp, fleet.stddev_temp)"),
        )
        .where(F.col("z") > WARNING_Z)
    )
    if existing is not None:
        raised = _raised(existing, F.col("anomaly_type") == HIGH_TEMPERATURE, as_of)
        scored = scored.join(raised, "panel_id", "left_anti")
    return _as_anomalies(
        scored,
        as_of,
        anomaly_type=f"'{HIGH_TEMPERATURE}'",
        severity=f"IF(z > {CRITICAL_Z}D, '{CRITICAL}', '{WARNING}')",
        expected="fleet.avg_stored",
        actual="temperature_c",
        deviation="try_divide(100D * (CAST(temperature_c AS DOUBLE) - fleet.avg_temp), fleet.avg_temp)",
        identity="event_id, CAST(timestamp AS STRING)",
    )


def detect_missing_data(
    silver_solar: DataFrame,
    as_of: datetime,
    existing: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Panels seen in seven days but not in the last hour; seen today -> Warning.

    Readings without a panel id can never be matched and stay Critical.
    """
    profile = panel_profile(silver_solar, as_of) if profile is None else profile
    unknown = F.col("panel_id").isNull()
    silent = profile.where(
        unknown | (F.col("last_seen") <= moment_like(profile, "last_seen", as_of - SILENCE))
    )
    if existing is not None:
        still_open = existing.where(
            (F.col("anomaly_type") == MISSING) & (F.col("resolution_status") == OPEN)
        )
        silent = silent.join(still_open.select("panel_id").distinct(), "panel_id", "left_anti")
    return _as_anomalies(
        silent,
        as_of,
        anomaly_type=f"'{MISSING}'",
        severity=f"IF(panel_id IS NOT NULL AND readings_today > 0, '{WARNING}', '{CRITICAL}')",
    )


def detect_missing_simple(silver_solar: DataFrame, as_of: datetime) -> DataFrame:
    """Variant: every panel ever seen that has no reading today."""
    last_seen = (
        visible(silver_solar, as_of).groupBy("panel_id").agg(F.max("timestamp").alias("last_seen"))
    )
    midnight = datetime.combine(as_of.date(), datetime.min.time())
    absent = last_seen.where(
        F.col("panel_id").isNull()
        | (F.col("last_seen") < moment_like(last_seen, "last_seen", midnight))
    )
    return _as_anomalies(
        absent, as_of, anomaly_type=f"'{MISSING}'", severity=f"'{CRITICAL}'"
    )


def detect_sudden_drop(
    silver_solar: DataFrame,
    as_of: datetime,
    existing: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Panels whose mean of today is below half of yesterday's."""
    profile = panel_profile(silver_solar, as_of) if profile is None else profile
    before, now = F.col("yesterday_avg"), F.col("today_avg")
    drops = (
        profile.where(F.col("panel_id").isNotNull() & (now < before * DROP_RATIO))
        .withColumn("drop_pct", F.try_divide(before - now, before) * 100)
    )
    if existing is not None:
        drops = drops.join(
            _raised(existing, F.col("anomaly_type") == DROP, as_of), "panel_id", "left_anti"
        )
    return _as_anomalies(
        drops,
        as_of,
        anomaly_type=f"'{DROP}'",
        severity=f"IF(drop_pct > {CRITICAL_DROP_PCT}D, '{CRITICAL}', '{WARNING}')",
        expected="yesterday_stored",
        actual="today_stored",
        deviation="drop_pct",
    )


def detect_anomalies(
    silver_solar: DataFrame,
    as_of: datetime,
    existing: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """New anomalies of one run: all four classes minus what ``existing`` already holds.

    ``existing`` is the table as it was before the run.  The classes have
    different names, so checking all of them against this one snapshot equals
    inserting them one after the other.

    All detectors read ``profile``.  Pass a written or checkpointed one (see
    :func:`sunledger.session.materialise`) to scan the seven days only once.
    """
    profile = panel_profile(silver_solar, as_of) if profile is None else profile
    classes = [
        detect_low_production(silver_solar, as_of, existing, profile),
        detect_high_temperature(silver_solar, as_of, existing, profile),
        detect_missing_data(silver_solar, as_of, existing, profile),
        detect_sudden_drop(silver_solar, as_of, existing, profile),
    ]
    return reduce(DataFrame.unionByName, classes)


def today_summary(anomalies: DataFrame, as_of: datetime) -> DataFrame:
    """One row: all, critical and warning anomalies of today."""
    return anomalies.where(F.col("anomaly_date") == F.lit(as_of.date())).agg(
        F.lit("ANOMALY SUMMARY").alias("title"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("severity") == CRITICAL).alias("critical"),
        F.count_if(F.col("severity") == WARNING).alias("warning"),
    )


def today_by_type(anomalies: DataFrame, as_of: datetime) -> DataFrame:
    return (
        anomalies.where(F.col("anomaly_date") == F.lit(as_of.date()))
        .groupBy("anomaly_type", "severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("severity", F.col("count").desc(), "anomaly_type")
    )


def open_rollup(anomalies: DataFrame) -> DataFrame:
    """Open anomalies by type and severity: count, first and last day, number of affected panels.

    :func:`open_panels` lists the panels.
    """
    return (
        open_panels(anomalies)
        .groupBy("anomaly_type", "severity")
        .agg(
            F.sum("count").alias("count"),
            F.min("oldest").alias("oldest"),
            F.max("latest").alias("latest"),
            F.count("panel_id").alias("panels"),
        )
        .orderBy(severity_rank(), F.col("count").desc(), "anomaly_type")
    )


def open_panels(anomalies: DataFrame) -> DataFrame:
    """The affected panels of every type and severity, one row each, with their open anomalies."""
    return (
        anomalies.where(F.col("resolution_status") == OPEN)
        .groupBy("anomaly_type", "severity", "panel_id")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("anomaly_date").alias("oldest"),
            F.max("anomaly_date").alias("latest"),
        )
    )


def severity_rank() -> Column:
    severity = F.col("severity")
    return F.when(severity == CRITICAL, 1).when(severity == WARNING, 2).otherwise(3)


def purge(anomalies: DataFrame, as_of: datetime, keep: timedelta = RETENTION) -> DataFrame:
    """The table without anomalies detected more than ``keep`` ago."""
    return anomalies.where(F.col("detection_time").isNull() | ~_expired(anomalies, as_of, keep))


def auto_resolve(
    anomalies: DataFrame, as_of: datetime, after_days: int = RESOLVE_AFTER_DAYS
) -> DataFrame:
    """The table with open anomalies older than ``after_days`` marked as resolved."""
    return anomalies.withColumn(
        "resolution_status",
        F.when(_stale(as_of, after_days), RESOLVED).otherwise(F.col("resolution_status")),
    )


def overdue(
    anomalies: DataFrame,
    as_of: datetime,
    keep: timedelta = RETENTION,
    after_days: int = RESOLVE_AFTER_DAYS,
) -> Column:
    """Condition of the rows that :func:`purge` or :func:`auto_resolve` would change."""
    return F.coalesce(_expired(anomalies, as_of, keep), F.lit(False)) | F.coalesce(
        _stale(as_of, after_days), F.lit(False)
    )


def _expired(anomalies: DataFrame, as_of: datetime, keep: timedelta) -> Column:
    return F.col("detection_time") < moment_like(anomalies, "detection_time", as_of - keep)


def _stale(as_of: datetime, after_days: int) -> Column:
    limit = F.lit(as_of.date() - timedelta(days=after_days))
    return (F.col("resolution_status") == OPEN) & (F.col("anomaly_date") < limit)


def _z(value: Column) -> Column:
    return F.try_divide(
        value.cast("double") - F.col("avg_production"), F.col("stddev_production")
    )


def _raised(existing: DataFrame, of_class: Column, as_of: datetime) -> DataFrame:
    """Panels that already have an anomaly of this class today."""
    today = F.col("anomaly_date") == F.lit(as_of.date())
    return existing.where(of_class & today).select("panel_id").distinct()


def _as_anomalies(
    found: DataFrame,
    as_of: datetime,
    *,
    anomaly_type: str,
    severity: str,
    expected: str = "NULL",
    actual: str = "NULL",
    deviation: str = "NULL",
    identity: str = "NULL",
) -> DataFrame:
    """Rows of gold_anomalies; the arguments are SQL expressions over ``found``."""
    day = f"DATE '{as_of.date()}'"
    columns = {
        # the same anomaly gets the same id in every run and on every executor
        "anomaly_id": f"xxhash64({day}, panel_id, {anomaly_type}, {identity})",
        "detection_time": f"TIMESTAMP_NTZ '{as_of.isoformat(sep=' ', timespec='microseconds')}'",
        "anomaly_date": day,
        "panel_id": "panel_id",
        "anomaly_type": anomaly_type,
        "severity": severity,
        "expected_value": expected,
        "actual_value": actual,
        "deviation_percentage": f"round({deviation}, 2)",
        "weather_conditions": "NULL",
        "resolution_status": f"'{OPEN}'",
        "resolution_notes": "NULL",
        "resolved_time": "NULL",
    }
    return found.selectExpr(
        *(
            f"CAST({columns[field.name]} AS {field.dataType.simpleString()}) AS {field.name}"
            for field in GOLD_ANOMALIES.fields
        )
    )
