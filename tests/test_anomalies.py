from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sunledger.operators import anomalies as A
from sunledger.schemas import GOLD_ANOMALIES

NOW = datetime(2024, 5, 10, 18, 0)
SILVER = (
    "event_id STRING, timestamp TIMESTAMP_NTZ, panel_id STRING, production_kw DECIMAL(8,3), "
    "temperature_c DECIMAL(5,1), is_valid BOOLEAN"
)


def rows(panel, values, start=NOW - timedelta(days=3), step=timedelta(minutes=10), temp="20.0"):
    return [
        (f"{panel}-{start}-{i}", start + i * step, panel, D(str(v)), D(temp), True)
        for i, v in enumerate(values)
    ]


def silver(spark, *parts):
    return spark.createDataFrame([r for part in parts for r in part], SILVER)


def test_low_production_levels_and_single_reading_panel(spark):
    usual = [10 + (i % 3) for i in range(60)]
    today = NOW - timedelta(hours=3)
    df = silver(
        spark,
        rows("P1", usual),
        rows("P1", [8.4, 2.0], start=today),
        rows("ALONE", [0.0], start=today),
    )
    found = {float(r.actual_value): r for r in A.detect_low_production(df, NOW).collect()}
    assert set(found) == {2.0} or set(found) == {2.0, 8.4}
    assert found[2.0].severity == "Critical"
    assert found[2.0].anomaly_type == "Critical Low Production"
    assert found[2.0].resolution_status == "Open"
    assert all(r.panel_id == "P1" for r in found.values())


def test_invalid_readings_of_today_are_judged_too(spark):
    bad = [("x", NOW - timedelta(hours=1), "P1", D("-50"), D("20.0"), False)]
    df = silver(spark, rows("P1", [10 + (i % 3) for i in range(40)]), bad)
    (row,) = A.detect_low_production(df, NOW).collect()
    assert float(row.actual_value) == -50


def test_high_temperature(spark):
    hot = rows("P2", [10], start=NOW - timedelta(hours=2), temp="45.0")
    df = silver(
        spark,
        rows("P1", [10] * 50, temp="20.0"),
        rows("P1", [10] * 50, temp="22.0", start=NOW - timedelta(days=2)),
        hot,
    )
    (row,) = A.detect_high_temperature(df, NOW).collect()
    assert (row.panel_id, row.severity, row.anomaly_type) == ("P2", "Critical", "High Temperature")


def test_missing_data_severity_and_unknown_panel(spark):
    df = silver(
        spark,
        rows("RECENT", [1], start=NOW - timedelta(minutes=30)),
        rows("EDGE", [1], start=NOW - timedelta(hours=1)),
        rows("TODAY", [1], start=NOW - timedelta(hours=5)),
        rows("OLD", [1], start=NOW - timedelta(days=2)),
        rows("GONE", [1], start=NOW - timedelta(days=8)),
        rows(None, [1], start=NOW - timedelta(minutes=1)),
    )
    found = {r.panel_id: r.severity for r in A.detect_missing_data(df, NOW).collect()}
    assert found == {"EDGE": "Warning", "TODAY": "Warning", "OLD": "Critical", None: "Critical"}
    simple = {r.panel_id for r in A.detect_missing_simple(df, NOW).collect()}
    assert simple == {"OLD", "GONE", None}


def test_sudden_drop_limits(spark):
    yesterday, today = NOW - timedelta(days=1, hours=2), NOW - timedelta(hours=2)

    def pair(panel, before, after):
        return rows(panel, [before], start=yesterday) + rows(panel, [after], start=today)

    df = silver(
        spark,
        pair("HALF", 10, 5),
        pair("WARN", 10, 4),
        pair("SEVENTY", 10, 3),
        pair("CRIT", 10, 1),
        pair("ZERO", 0, 0),
        rows("NEW", [1], start=today),
    )
    found = {r.panel_id: (r.severity, float(r.deviation_percentage)) for r in A.detect_sudden_drop(df, NOW).collect()}
    assert found == {"WARN": ("Warning", 60.0), "SEVENTY": ("Warning", 70.0), "CRIT": ("Critical", 90.0)}


def test_second_run_adds_nothing_and_first_run_adds_every_reading(spark):
    df = silver(
        spark,
        rows("P1", [10 + (i % 3) for i in range(60)]),
        rows("P1", [0.1, 0.2], start=NOW - timedelta(hours=3)),
    )
    first = A.detect_anomalies(df, NOW)
    low = first.where(F.col("anomaly_type").contains("Low Production"))
    assert low.count() == 2
    assert low.select("anomaly_id").distinct().count() == 2
    again = A.detect_anomalies(df, NOW + timedelta(minutes=1), existing=first)
    assert again.count() == 0


def test_missing_data_is_raised_again_after_it_was_resolved(spark):
    df = silver(spark, rows("P1", [1], start=NOW - timedelta(days=2)))
    first = A.detect_missing_data(df, NOW)
    assert A.detect_missing_data(df, NOW, existing=first).count() == 0
    resolved = first.withColumn("resolution_status", F.lit("Resolved"))
    assert A.detect_missing_data(df, NOW, existing=resolved).count() == 1


def table(spark, *entries):
    base = {name: None for name in GOLD_ANOMALIES.names}
    return spark.createDataFrame(
        [tuple({**base, **e}.values()) for e in entries], GOLD_ANOMALIES
    )


def test_rollup_and_its_panels(spark):
    entries = [
        {
            "panel_id": f"P{i:03}",
            "anomaly_type": "Missing Data",
            "severity": "Warning",
            "anomaly_date": NOW.date(),
            "resolution_status": "Open",
        }
        for i in range(100)
    ]
    (whole,) = A.open_rollup(table(spark, *entries, *entries[:7])).collect()
    assert (whole["count"], whole.panels) == (107, 100)
    listed = A.open_panels(table(spark, *entries, *entries[:7])).collect()
    assert sorted(r.panel_id for r in listed) == [e["panel_id"] for e in entries]
    assert sum(r["count"] for r in listed) == 107


def test_purge_and_resolve(spark):
    entries = [
        {"detection_time": NOW - timedelta(days=age), "anomaly_date": (NOW - timedelta(days=age)).date(),
         "resolution_status": "Open", "panel_id": str(age)}
        for age in (1, 30, 31)
    ]
    stored = table(spark, *entries)
    assert {r.panel_id for r in A.purge(stored, NOW).collect()} == {"1", "30"}
    status = {r.panel_id: r.resolution_status for r in A.auto_resolve(stored, NOW).collect()}
    assert status == {"1": "Open", "30": "Open", "31": "Resolved"}
