"""Reports on empty tables and at their limits."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest

from sunledger.operators import monitoring as M
from sunledger.operators import quality as Q
from sunledger.schemas import GOLD_ANOMALIES

NOW = datetime(2024, 5, 10, 18, 0)
READINGS = "timestamp TIMESTAMP_NTZ, panel_id STRING, production_kw DECIMAL(8,3), temperature_c DECIMAL(5,1)"
DAILY = "date DATE, panel_id STRING, data_quality_pct DECIMAL(5,2), valid_readings BIGINT, invalid_readings BIGINT"
FLAGGED = "timestamp TIMESTAMP_NTZ, is_valid BOOLEAN"


@pytest.fixture
def frames(spark):
    def build(age_hours=None, quality=None, critical=0, warning=0, missing=0):
        last = [] if age_hours is None else [(NOW - timedelta(hours=age_hours), "P", D("1"), D("1"))]
        daily = [] if quality is None else [(NOW.date(), "P", D(str(quality)), 1, 0)]
        kinds = [("Critical", "X")] * critical + [("Warning", "X")] * warning
        kinds += [("Critical", "Missing Data")] * missing
        base = {name: None for name in GOLD_ANOMALIES.names}
        raised = [
            tuple({**base, "severity": s, "anomaly_type": t, "resolution_status": "Open"}.values())
            for s, t in kinds
        ]
        return (
            spark.createDataFrame(last, READINGS),
            spark.createDataFrame(raised, GOLD_ANOMALIES),
            spark.createDataFrame(daily, DAILY),
        )

    return build


def test_health_score_full_and_empty(frames):
    full = M.health_score(*frames(0.5, 99), NOW).first()
    assert (full.total_score, full.health_status) == (100, "EXCELLENT")
    empty = M.health_score(*frames(), NOW).first()
    assert (empty.freshness_score, empty.anomaly_score, empty.quality_score) == (0, 40, 0)
    assert empty.health_status == "CRITICAL"


def test_health_score_floors_the_anomaly_points(frames):
    row = M.health_score(*frames(2, 96, critical=20), NOW).first()
    assert (row.freshness_score, row.anomaly_score, row.quality_score) == (20, 0, 25)


def test_deductions(frames, spark):
    readings, raised, daily = frames(30, 85, critical=2, warning=1, missing=3)
    tables = {"a": readings, "b": readings.limit(0)}
    row = M.health_score_deductions(readings, raised, daily, tables, NOW).first()
    # 30 stale, 2 * 5 + 3 + 1 anomalies, 10 quality, 5 for the empty table
    assert row.health_score == 100 - 30 - 14 - 10 - 5
    assert row.failed and row.health_status == "POOR"
    assert row.deductions == [
        "Stale data: -30 (30.0 hours)",
        "Anomalies: -14 (2 critical real, 3 missing, 1 warning)",
        "Fair data quality: -10 (85.0%)",
        "Missing tables: -5 (1 tables empty)",
    ]


def test_deductions_take_no_data_as_fresh(frames):
    readings, raised, daily = frames()
    row = M.health_score_deductions(readings, raised, daily, {}, NOW).first()
    assert (row.health_score, row.health_status, row.failed) == (100, "EXCELLENT", False)


@pytest.mark.parametrize(
    ("given", "severity", "code", "reasons"),
    [
        ({}, "INFO", 0, []),
        ({"age_hours": 1, "quality": 95}, "INFO", 0, []),
        ({"age_hours": 2.5, "quality": 95}, "WARNING", 1, ["Data delayed by 2.5 hours"]),
        ({"age_hours": 1, "quality": 89.9}, "WARNING", 1, ["Low data quality: 89.9%"]),
        ({"age_hours": 1, "quality": 0}, "INFO", 0, []),
        ({"age_hours": 1, "quality": 95, "warning": 5}, "WARNING", 1, ["5 warnings"]),
        (
            {"age_hours": 9, "quality": 95, "critical": 1},
            "CRITICAL",
            2,
            ["1 critical anomalies", "Data delayed by 9.0 hours"],
        ),
    ],
)
def test_alert_decision(frames, given, severity, code, reasons):
    row = M.alert_decision(*frames(**given), NOW).first()
    assert (row.severity, row.exit_code, row.reasons) == (severity, code, reasons)


def test_freshness_and_volume(spark, frames):
    fresh, _, _ = frames(0.5)
    stale, _, _ = frames(30)
    empty, _, _ = frames()
    tables = {"fresh": fresh, "stale": stale, "empty": empty}
    assert [(r.table_name, r.status) for r in M.freshness(tables, NOW).collect()] == [
        ("fresh", "Real-time"),
        ("stale", "Stale data"),
        ("empty", "Stale data"),
    ]
    volumes = {r.table_name: r.status for r in M.volume(tables, NOW).collect()}
    assert volumes == {"fresh": "Low volume", "stale": "No data", "empty": "No data"}


def test_rows_after_as_of_are_invisible(spark, frames):
    later, _, _ = frames(-1)
    assert M.ingest_alive({"t": later}, NOW).first().alive is False


@pytest.mark.parametrize(
    ("valid", "verdict"),
    [((96, 100), "EXCELLENT"), ((95, 100), "GOOD"), ((81, 100), "GOOD"), ((80, 100), "POOR")],
)
def test_silver_verdict_limits(spark, valid, verdict):
    hit, total = valid
    df = spark.createDataFrame([(NOW, i < hit) for i in range(total)], FLAGGED)
    assert verdict in Q.silver_verdict(df, df).first().data_quality_verdict


def test_empty_layers(spark):
    empty = spark.createDataFrame([], FLAGGED)
    full = spark.createDataFrame([(NOW, True)], FLAGGED)
    gate = {r.layer: r.ready for r in Q.layer_gate({"a": empty, "b": full}, {"a": empty, "b": full}).collect()}
    assert gate == {"bronze": True, "silver": False}
    assert "FAIL" in Q.bronze_verdict(empty, full).first().data_presence_check
    assert "POOR" in Q.silver_verdict(empty, full).first().data_quality_verdict
    assert Q.invalid_share(empty.limit(0)).first().percentage is None


def test_duplicates_count_rows_with_missing_parts(spark):
    weather = spark.createDataFrame(
        [(NOW, "A"), (NOW, "A"), (NOW, None), (NOW, None), (None, None)],
        "timestamp TIMESTAMP_NTZ, city STRING",
    )
    readings = spark.createDataFrame([("a",), ("a",), (None,)], "event_id STRING")
    found = {r.table_name: r.potential_duplicates for r in Q.duplicate_check(weather, readings).collect()}
    # a missing event id is counted as a row but not as a value
    assert found == {"weather_data": 2, "solar_panel_readings": 2}
