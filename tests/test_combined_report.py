"""Reports over the combined view, which is never built for them."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sunledger.operators import gold
from sunledger.plans.catalog import AS_OF
from sunledger.plans.fleet import Fleet
from tests.conftest import SMALL
from tests.test_plans import plan_of, scans


def tables(spark):
    t = [datetime(2024, 1, 1, h, m) for h, m in ((8, 0), (8, 59), (9, 0), (10, 30))]
    readings = [
        (1, t[0], "A", D("1.500"), D("20.0")),
        (2, t[1], "A", None, D("30.0")),
        (3, t[1], "B", D("2.500"), None),
        (4, t[2], "A", D("4.000"), D("10.0")),  # no weather in this hour
        (5, None, "A", D("8.000"), D("0.0")),
        (6, t[3], "C", D("3.000"), D("5.0")),
    ]
    weather = [
        (1, t[0], D("5.00"), 10, 1, 0),
        (2, t[1], None, 20, 1, 50),
        (3, t[1], D("8.00"), 30, 1, None),
        (4, None, D("99.00"), 40, 1, 99),
        (5, t[3], None, 50, 1, 70),
    ]
    weather = [(i, ts, temp, hum, wind, cloud, D("1.0")) for i, ts, temp, hum, wind, cloud in weather]
    return (
        spark.createDataFrame(
            readings,
            "event_id long, timestamp timestamp_ntz, panel_id string, production_kw decimal(8,3), temperature_c decimal(5,1)",
        ),
        spark.createDataFrame(
            weather,
            "id long, timestamp timestamp_ntz, temperature decimal(5,2), humidity int, wind_speed int, "
            "cloud_cover int, uv_index decimal(3,1)",
        ),
    )


def from_view(readings, weather, by):
    view = gold.combined_solar_weather(readings, weather)
    key = F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour") if by == "hour" else F.col(by)
    return view.groupBy(key).agg(
        F.count(F.lit(1)).alias("view_rows"),
        F.avg(F.col("production_kw").cast("double")).alias("avg_production_kw"),
        F.avg(F.col("panel_temperature").cast("double")).alias("avg_panel_temperature"),
        F.avg(F.col("ambient_temperature").cast("double")).alias("avg_ambient_temperature"),
        F.avg("cloud_cover").alias("avg_cloud_cover"),
        F.covar_pop("production_kw", "ambient_temperature").alias("production_temperature_covariance"),
    )


def listed(df):
    return {r[0]: [x if x is None else pytest.approx(float(x), abs=1e-6) for x in r[1:]] for r in df.collect()}


@pytest.mark.parametrize("by", ["hour", "panel_id"])
@pytest.mark.parametrize("source", ["odd", "fleet", "no weather", "no readings"])
def test_report_equals_the_view(spark, by, source):
    if source == "fleet":
        fleet = Fleet(spark, SMALL, AS_OF)
        readings, weather = fleet.readings, fleet.weather
    else:
        readings, weather = tables(spark)
        readings = readings.limit(0) if source == "no readings" else readings
        weather = weather.limit(0) if source == "no weather" else weather
    ours = {r[0]: list(r[1:]) for r in gold.combined_report(readings, weather, by).collect()}
    assert ours == listed(from_view(readings, weather, by))
    assert bool(ours) == (source != "no readings")


def test_large_sums_stay_exact(spark):
    """A million rows on either side of one hour: the view would have 10**12."""
    hour = "TIMESTAMP_NTZ '2024-01-01 08:00:00'"
    readings = spark.range(1_000_000).selectExpr(
        "id AS event_id", f"{hour} AS timestamp", "'A' AS panel_id",
        "CAST(99999.999 AS DECIMAL(8,3)) AS production_kw", "CAST(1 AS DECIMAL(5,1)) AS temperature_c",
    )
    weather = spark.range(1_000_000).selectExpr(
        f"{hour} AS timestamp", "CAST(40.01 AS DECIMAL(5,2)) AS temperature", "7 AS cloud_cover"
    )
    (row,) = gold.combined_report(readings, weather).collect()
    assert row.view_rows == 10**12
    assert row.avg_production_kw == pytest.approx(99999.999, abs=1e-9)
    assert row.avg_ambient_temperature == pytest.approx(40.01, abs=1e-9)
    assert abs(row.production_temperature_covariance) < 1e-6


def test_plan_has_two_scans_and_no_fan_out(spark):
    fleet = Fleet(spark, SMALL, AS_OF)
    plan = plan_of(gold.combined_report(fleet.readings, fleet.weather, "panel_id")).split("== Initial Plan ==")[0]
    assert scans(plan) == 2 and "Generate" not in plan


def test_other_groups_are_refused(spark):
    with pytest.raises(ValueError, match="by hour or by panel_id"):
        gold.combined_report(*tables(spark), by="city")
