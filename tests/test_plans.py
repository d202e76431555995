"""What the physical plans must and must not contain."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sunledger.operators import gold
from sunledger.plans.catalog import AS_OF, QUERIES, publish
from sunledger.plans.fleet import Fleet
from sunledger.schemas import EVENTS
from tests.conftest import SMALL

STREAMS = {name for name in QUERIES if name.startswith("stream_")} | {"ingest_counters"}
FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not [operator for operator in FORBIDDEN if operator in plan]


@pytest.mark.parametrize("name", ["anomaly_low_production", "live_dashboard", "live_daily_summary"])
def test_time_windows_reach_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "GreaterThan" in plan.split("PushedFilters: ")[1].split("]")[0]


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["panel_summary"](spark, SMALL))
    assert "props" not in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_silver_is_narrow(spark):
    for name in ("silver_solar", "silver_weather", "pv_yield", "simple_production"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        if name != "pv_yield":  # looks its site parameters up
            assert "Exchange" not in plan


def scans(plan):
    return plan.count("FileScan parquet")


@pytest.mark.parametrize(
    ("name", "most_scans", "most_exchanges"),
    [
        ("silver_solar", 1, 0),
        ("gold_daily_panel", 1, 1),
        ("load_profile", 1, 2),
        ("energy_balance", 1, 4),
        ("scenario_metrics", 1, 7),
    ],
)
def test_hours_and_events_are_read_once(spark, name, most_scans, most_exchanges):
    plan = plan_of(QUERIES[name](spark, SMALL)).split("== Initial Plan ==")[0]
    assert scans(plan) <= most_scans
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") <= most_exchanges


@pytest.mark.parametrize(("name", "most_scans"), [("layer_counts", 9), ("health_score_deductions", 8)])
def test_reports_over_all_tables_scan_each_once(spark, name, most_scans):
    """Nine tables in the one; in the other five watched ones, and readings, days and anomalies for its points."""
    plan = plan_of(QUERIES[name](spark, SMALL)).split("== Initial Plan ==")[0]
    assert scans(plan) <= most_scans


def test_combined_view_casts_before_the_pairs(spark, tmp_path):
    """A cast above the join would run once for every pair of a reading and a weather row."""
    times = [datetime(2024, 1, 1, 8, 59, 59), datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9, 30), datetime(2024, 1, 1, 11), None]
    rows = [
        (i, times[i % 5], i % 7, "view" if i % 3 == 0 and i % 5 != 3 else "click", [1.25, None, 130.5][i % 4 % 3], [f'{{"k": {i % 90}}}', "{}", None][i % 11 % 3])
        for i in range(60)
    ]
    rows += [rows[6], rows[21], (None, times[1], 3, "view", 7.5, '{"k": 4}'), (498, times[1], None, "error", 1.0, '{"k": 99}')]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["combined_solar_weather"](spark, str(tmp_path))
    fleet = Fleet(spark, str(tmp_path), AS_OF)
    plain = publish(gold.combined_solar_weather(fleet.readings, fleet.weather))
    assert found.dtypes == plain.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    above_the_join = plan_of(found).split("== Initial Plan ==")[0].split("Join [")[0]
    assert "Project" in above_the_join and "cast(" not in above_the_join.lower()


def test_combined_view_is_dealt_by_its_own_size(spark, tmp_path):
    """9,000 rows make 13,500,000; by the size of the input alone, one task would make them all."""
    spark.range(9000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, int(id % 6), 0, id / 9000) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "double(id % 90) AS value", "'{\"k\": 4}' AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["combined_solar_weather"](spark, str(tmp_path))
    tasks = [n for _, n in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 6 * 1500 * 1500
    assert max(tasks) < 0.6 * sum(tasks)
    above_the_join = plan_of(found).split("Join [")[0]
    assert "Generate inline" in above_the_join


def test_combined_view_by_city(spark):
    fleet = Fleet(spark, SMALL, AS_OF)
    readings = fleet.readings.withColumn("city", F.when(F.col("id") % 5 > 0, F.element_at(F.array(*map(F.lit, ["Turin", "Milan", "Oslo"])), (F.col("id") % 3 + 1).cast("int"))))
    found = gold.combined_solar_weather(readings, fleet.weather, same_city=True)
    hour = F.date_trunc("hour", "timestamp")
    left = readings.select("city", hour.alias("h"), "timestamp", "panel_id", "production_kw", F.col("temperature_c").alias("panel_temperature"))
    right = fleet.weather.select("city", hour.alias("h"), F.col("temperature").alias("ambient_temperature"), *found.columns[5:])
    plain = left.join(right, ["city", "h"], "left").select(*found.columns)
    assert found.dtypes == plain.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
