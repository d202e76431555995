"""The scheduled jobs over written tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sunledger.plans import refresh
from sunledger.plans.catalog import AS_OF, NOON
from sunledger.plans.fleet import Fleet
from sunledger.schemas import GOLD_ANOMALIES
from sunledger.sources.tables import append_table, refresh_table
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    fleet = Fleet(spark, SMALL, AS_OF)
    lake = refresh.Lake(spark, str(tmp_path_factory.mktemp("lake")))
    refresh_table(fleet.weather, lake.location("bronze", "weather_data"), ts="timestamp")
    refresh_table(fleet.readings, lake.location("bronze", "solar_panel_readings"), ts="timestamp")
    refresh.refresh_silver(lake, AS_OF)
    refresh.refresh_gold(lake, AS_OF)
    return lake


def test_layers_reconcile(lake):
    assert lake.silver_solar.count() == lake.readings.count() == 1000
    counts = {r.table_name: r.row_count for r in refresh.layer_report(lake).collect()}
    assert counts["silver_weather"] == counts["weather_data"] == counts["gold_weather_impact"]


def test_day_predicate_prunes_partitions(lake):
    from sunledger.functions.clock import on_day

    plan = on_day(lake.silver_solar, AS_OF.date(), AS_OF)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(timestamp)" in plan


def test_incremental_refresh_touches_only_its_days(lake, spark):
    before = lake.silver_solar.count()
    refresh.refresh_silver(lake, datetime(2024, 2, 1), days=[date(2024, 1, 30)])
    stamped = lake.silver_solar.groupBy("event_date").agg(F.max("silver_ingestion_time").alias("t"))
    times = {r.event_date: r.t for r in stamped.collect()}
    assert lake.silver_solar.count() == before
    assert times[date(2024, 1, 30)] == datetime(2024, 2, 1)
    assert times[date(2024, 1, 29)] == AS_OF


def test_detection_runs_and_maintenance(lake, spark):
    assert lake.anomalies().count() == 0
    refresh.run_detection(lake, NOON)
    noon = lake.anomalies().count()
    refresh.run_detection(lake, AS_OF)
    evening = lake.anomalies().count()
    assert 0 < noon < evening
    refresh.run_detection(lake, AS_OF)
    assert lake.anomalies().count() == evening
    refresh.maintain_anomalies(lake, datetime(2024, 3, 15))
    assert lake.anomalies().count() == 0
    assert lake.generation() == 1


def test_health_job_raises_when_unhealthy(lake, spark):
    # no anomalies any more, no quality data in the last week: only stale
    assert refresh.check_health(lake, datetime(2024, 6, 1)).first().health_score == 70
    lake.replace_anomalies(Fleet(spark, SMALL, AS_OF).anomalies)
    with pytest.raises(refresh.PipelineUnhealthy, match="Stale data"):
        refresh.check_health(lake, datetime(2024, 2, 2))


def test_gate_refuses_empty_input(spark, tmp_path):
    lake = refresh.Lake(spark, str(tmp_path))
    fleet = Fleet(spark, SMALL, AS_OF)
    refresh_table(fleet.weather.limit(0), lake.location("bronze", "weather_data"))
    refresh_table(fleet.readings.limit(0), lake.location("bronze", "solar_panel_readings"))
    with pytest.raises(refresh.LayerNotReady):
        refresh.refresh_silver(lake, AS_OF)


def test_append_adds(spark, tmp_path):
    fleet = Fleet(spark, SMALL, AS_OF)
    for _ in range(2):
        append_table(fleet.weather.limit(3), f"{tmp_path}/w")
    assert spark.read.parquet(f"{tmp_path}/w").count() == 6


def test_incremental_gold_changes_only_its_days(spark, tmp_path):
    fleet = Fleet(spark, SMALL, AS_OF)
    lake = refresh.Lake(spark, str(tmp_path))
    refresh_table(fleet.weather, lake.location("bronze", "weather_data"), ts="timestamp")
    refresh_table(fleet.readings, lake.location("bronze", "solar_panel_readings"), ts="timestamp")
    refresh.refresh_silver(lake, AS_OF)
    refresh.refresh_gold(lake, AS_OF)
    later = datetime(2024, 2, 5)
    # the readings of one day turn out to be void, those of another one stay
    kept = fleet.readings.where("to_date(timestamp) <> DATE '2024-01-20'")
    refresh_table(kept, lake.location("bronze", "solar_panel_readings"), ts="timestamp")
    days = [date(2024, 1, 20), date(2024, 1, 21)]
    refresh.refresh_silver(lake, later, days=days)
    refresh.refresh_gold(lake, later, days=days)
    stamps = lake.daily_panel.groupBy("date").agg(F.max("gold_ingestion_time").alias("t")).collect()
    by_day = {r.date: r.t for r in stamps}
    assert date(2024, 1, 20) not in by_day and by_day[date(2024, 1, 21)] == later
    assert by_day[date(2024, 1, 19)] == AS_OF
    solar = lake.silver_solar.count()
    assert solar == kept.count()
    assert lake.daily_panel.agg(F.sum("readings_count")).first()[0] == solar
    assert lake.read("gold", "gold_hourly_system").where("to_date(hour) = DATE '2024-01-20'").isEmpty()
    assert lake.read("gold", "gold_monthly_kpis").agg(F.sum("valid_readings")).first()[0] == (
        lake.silver_solar.where("is_valid").count()
    )


def test_weather_job_appends(spark, tmp_path):
    from sunledger.sources import messages

    fleet = Fleet(spark, SMALL, AS_OF)
    lake = refresh.Lake(spark, str(tmp_path))
    payloads = messages.weather_payloads(fleet.weather)
    refresh.ingest_weather(lake, payloads, datetime(2024, 1, 31, 10))
    once = lake.weather.count()
    refresh.ingest_weather(lake, payloads, datetime(2024, 1, 31, 11))
    assert 0 < once and lake.weather.count() == 2 * once


def files_of_days(lake):
    """Data files per anomaly day that the table's folders hold, with their generation."""
    root = Path(lake.location("gold", "gold_anomalies"))
    return {(p.parent.parent.name, p.parent.name, p.name) for p in root.rglob("*.parquet")}


def test_maintenance_rewrites_only_the_days_that_change(spark, tmp_path):
    lake = refresh.Lake(spark, str(tmp_path))
    base = dict.fromkeys(GOLD_ANOMALIES.names)
    now = datetime(2024, 3, 1)
    rows = [
        # an expired day, a day with one stale and one resolved row, a fresh day, a row without a day
        (70, "Open"), (35, "Open"), (35, "Resolved"), (1, "Open"),
    ]
    entries = [
        {**base, "panel_id": f"{age}-{status}", "resolution_status": status,
         "detection_time": now - timedelta(days=age), "anomaly_date": (now - timedelta(days=age)).date()}
        for age, status in rows
    ] + [{**base, "panel_id": "undated", "resolution_status": "Open", "detection_time": now - timedelta(days=90)}]
    lake.append_anomalies(spark.createDataFrame([tuple(e.values()) for e in entries], GOLD_ANOMALIES))
    before = files_of_days(lake)
    changed = refresh.maintain_anomalies(lake, now, keep=timedelta(days=60))
    assert changed == [(now - timedelta(days=70)).date(), (now - timedelta(days=35)).date(), None]
    held = {r.panel_id: r.resolution_status for r in lake.anomalies().collect()}
    assert held == {"35-Open": "Resolved", "35-Resolved": "Resolved", "1-Open": "Open"}
    after = files_of_days(lake)
    assert before <= after  # nothing a reader may still use is gone
    assert {day for _, day, _ in after - before} == {"anomaly_date=2024-01-26"}
    # a second run finds nothing to do and writes nothing
    assert refresh.maintain_anomalies(lake, now, keep=timedelta(days=60)) == []
    assert lake.generation() == 1 and files_of_days(lake) == after
    # later anomalies of a rewritten day and of an untouched one are seen
    again = [{**e, "panel_id": "new"} for e in entries[1:4:2]]
    lake.append_anomalies(spark.createDataFrame([tuple(e.values()) for e in again], GOLD_ANOMALIES))
    assert lake.anomalies().where("panel_id = 'new'").count() == 2
    rows_held = lake.anomalies().count()
    assert refresh.vacuum_anomalies(lake) == 3
    assert lake.anomalies().count() == rows_held
    fresh = {f for f in before if f[1] == "anomaly_date=2024-02-29"}
    assert fresh <= files_of_days(lake)
    assert refresh.vacuum_anomalies(lake) == 0


def test_failed_maintenance_leaves_no_trace(spark, tmp_path):
    lake = refresh.Lake(spark, str(tmp_path))
    base = dict.fromkeys(GOLD_ANOMALIES.names)
    now = datetime(2024, 3, 1)
    entries = [
        {**base, "panel_id": str(age), "resolution_status": "Open", "detection_time": now - timedelta(days=age),
         "anomaly_date": (now - timedelta(days=age)).date()}
        for age in (1, 40)
    ]
    lake.append_anomalies(spark.createDataFrame([tuple(e.values()) for e in entries], GOLD_ANOMALIES))
    # rows of the next generation without a marker: a run that was lost before its end
    left = lake.location("gold", "gold_anomalies") + f"/{refresh.GENERATION}=1"
    lake.anomalies().write.partitionBy("anomaly_date").parquet(left)
    assert lake.anomalies().count() == 2
    refresh.maintain_anomalies(lake, now, keep=timedelta(days=60))
    assert {r.panel_id: r.resolution_status for r in lake.anomalies().collect()} == {"1": "Open", "40": "Resolved"}
