from __future__ import annotations

from datetime import datetime
from decimal import Decimal as D

import pytest

from sunledger.operators import gold, silver

T0 = datetime(2024, 1, 7, 12, 30)  # a Sunday

READING = (
    "event_id STRING, timestamp TIMESTAMP_NTZ, panel_id STRING, panel_type STRING, "
    "panel_power_kw DECIMAL(5,2), production_kw DECIMAL(8,3), temperature_c DECIMAL(5,1), "
    "cloud_factor DECIMAL(3,2), temp_efficiency DECIMAL(4,3)"
)


def reading(**changes):
    row = {
        "event_id": "e",
        "timestamp": T0,
        "panel_id": "P1",
        "panel_type": "Mono",
        "panel_power_kw": D("3.00"),
        "production_kw": D("2.400"),
        "temperature_c": D("20.0"),
        "cloud_factor": D("0.50"),
        "temp_efficiency": D("1.000"),
    }
    return tuple({**row, **changes}.values())


def silver_rows(spark, *rows):
    return silver.build_silver_solar(spark.createDataFrame(list(rows), READING)).collect()


def test_calendar_parts_count_sunday_as_zero(spark):
    (row,) = silver_rows(spark, reading())
    assert (row.year, row.month, row.day, row.hour, row.day_of_week) == (2024, 1, 7, 12, 0)


@pytest.mark.parametrize(
    ("production", "power", "category", "ratio"),
    [
        ("2.400", "3.00", "Good", "0.800"),  # exactly 0.8 is not above 0.8
        ("2.401", "3.00", "Excellent", "0.800"),  # category from the unrounded ratio
        ("1.500", "3.00", "Fair", "0.500"),
        ("0.600", "3.00", "Poor", "0.200"),
        ("2.000", "0.00", "Poor", None),
        (None, "3.00", "Poor", None),
    ],
)
def test_performance_category(spark, production, power, category, ratio):
    value = None if production is None else D(production)
    (row,) = silver_rows(spark, reading(production_kw=value, panel_power_kw=D(power)))
    assert row.performance_category == category
    assert row.efficiency_ratio == (None if ratio is None else D(ratio))


@pytest.mark.parametrize(
    ("changes", "valid"),
    [
        ({}, True),
        ({"production_kw": D("0.000")}, True),
        ({"production_kw": D("-0.001")}, False),
        ({"production_kw": None}, False),
        ({"temperature_c": D("-30.0")}, True),
        ({"temperature_c": D("60.0")}, True),
        ({"temperature_c": D("60.1")}, False),
        ({"cloud_factor": D("1.00")}, True),
        ({"cloud_factor": D("1.01")}, False),
        ({"temp_efficiency": D("0.500")}, True),
        ({"temp_efficiency": D("0.499")}, False),
        ({"temp_efficiency": None}, False),
    ],
)
def test_reading_validity(spark, changes, valid):
    (row,) = silver_rows(spark, reading(**changes))
    assert row.is_valid is valid


def test_a_huge_ratio_is_kept(spark):
    (row,) = silver_rows(spark, reading(production_kw=D("10.000"), panel_power_kw=D("0.05")))
    assert float(row.efficiency_ratio) > 100 and row.performance_category == "Excellent"


WEATHER = (
    "id BIGINT, city STRING, timestamp TIMESTAMP_NTZ, temperature DECIMAL(5,2), humidity INT, "
    "wind_speed DECIMAL(5,2), cloud_cover INT, uv_index DECIMAL(3,1)"
)


def test_weather_categories_and_nulls(spark):
    rows = [
        (1, "A", T0, D("0.00"), 50, D("0.00"), 20, D("3.0")),
        (2, "A", T0, D("29.99"), 100, D("1.00"), 19, D("7.9")),
        (3, "A", T0, None, 50, D("1.00"), None, None),
    ]
    out = silver.build_silver_weather(spark.createDataFrame(rows, WEATHER)).orderBy("id").collect()
    assert [r.temperature_category for r in out] == ["Cold", "Warm", "Hot"]
    assert [r.sky_condition for r in out] == ["Partly Cloudy", "Clear", "Cloudy"]
    assert [r.uv_category for r in out] == ["Moderate", "High", "Very High"]
    assert [r.is_valid for r in out] == [True, True, False]


def test_audit_column_is_the_given_moment(spark):
    df = silver.build_silver_solar(spark.createDataFrame([reading()], READING), as_of=T0)
    assert df.first().silver_ingestion_time == T0


def test_gold_layers_agree(spark):
    rows = [
        reading(event_id=str(i), panel_id=f"P{i % 3}", production_kw=D(i) / 7, timestamp=datetime(2024, 1, 1 + i % 5, i % 24))
        for i in range(60)
    ]
    rows = [tuple(D(str(v)).quantize(D("0.001")) if j == 5 else v for j, v in enumerate(r)) for r in rows]
    solar = silver.build_silver_solar(spark.createDataFrame(rows, READING))
    daily, hourly = gold.daily_panel(solar).collect(), gold.hourly_system(solar).collect()
    (monthly,) = gold.monthly_kpis(solar).collect()
    assert sum(r.readings_count for r in daily) == 60
    assert all(r.valid_readings + r.invalid_readings == r.readings_count for r in daily)
    assert sum(r.valid_readings for r in hourly) == monthly.valid_readings
    assert monthly.total_panels == 3
    total = float(sum(r[5] for r in rows))
    assert sum(float(r.total_production_kwh) for r in daily) == pytest.approx(total, abs=0.1)
    assert float(monthly.total_production_kwh) == pytest.approx(total, abs=0.01)


def test_combined_view_fans_out_and_keeps_readings_without_weather(spark):
    readings = spark.createDataFrame(
        [reading(event_id="a"), reading(event_id="b", timestamp=datetime(2024, 1, 8, 1))], READING
    )
    weather = spark.createDataFrame(
        [(i, "A", datetime(2024, 1, 7, 12, 5 * i), D("1.00"), 1, D("1.00"), 1, D("1.0")) for i in range(3)],
        WEATHER,
    )
    out = gold.combined_solar_weather(readings, weather).collect()
    assert len(out) == 4
    assert sum(r.ambient_temperature is None for r in out) == 1
