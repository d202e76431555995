"""Solar view of a generic ``events`` table (event_id, ts, user_id, event_type, value, props).

A pure projection: each event becomes one panel reading, and each ``view``
event also one weather observation.  The literals are chosen so that every
category, validity rule and anomaly class of the engine gets rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.schemas import EVENTS
from sunledger.sources.tables import read_table

_K = "CAST(get_json_object(props, '$.k') AS INT)"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/events.parquet", EVENTS)


def readings_view(events: DataFrame) -> DataFrame:
    """``events`` as bronze panel readings."""
    return events.withColumn("k", F.expr(_K)).selectExpr(
        "event_id AS id",
        "event_id",
        "ts AS timestamp",
        "'PV-' || lpad(CAST(user_id AS STRING), 5, '0') AS panel_id",
        "CASE user_id % 3 WHEN 0 THEN 'Monocrystalline' WHEN 1 THEN 'Polycrystalline' "
        "ELSE 'Thin-film' END AS panel_type",
        "CAST(CASE WHEN user_id % 10 = 9 THEN 0 ELSE 120 END AS DECIMAL(5,2)) AS panel_power_kw",
        "CAST(CASE WHEN event_id % 499 = 498 THEN NULL ELSE 120 - value END AS DECIMAL(8,3)) "
        "AS production_kw",
        "CAST(CASE WHEN k < 2 THEN -40 ELSE 15 + CAST(60 AS DOUBLE) * k * k * k * k "
        "/ CAST(1e8 AS DOUBLE) END AS DECIMAL(5,1)) AS temperature_c",
        "CAST(k / CAST(88 AS DOUBLE) AS DECIMAL(3,2)) AS cloud_factor",
        "CAST(CAST(0.45 AS DOUBLE) + k / CAST(100 AS DOUBLE) AS DECIMAL(4,3)) AS temp_efficiency",
        "event_type AS status",
        "'Turin' AS city",
    )


def weather_view(events: DataFrame) -> DataFrame:
    """The ``view`` events as bronze weather observations of three cities."""
    return (
        events.where("event_type = 'view'")
        .withColumn("k", F.expr(_K))
        .selectExpr(
            "event_id AS id",
            "CASE user_id % 3 WHEN 0 THEN 'Turin' WHEN 1 THEN 'Milan' ELSE 'Rome' END AS city",
            "ts AS timestamp",
            "CAST(k * CAST(0.9 AS DOUBLE) - 25 AS DECIMAL(5,2)) AS temperature",
            "(k * 7) % 106 AS humidity",
            "CAST(value - 1 AS DECIMAL(5,2)) AS wind_speed",
            "CAST(NULL AS STRING) AS wind_direction",
            "CAST(1000 + k AS DECIMAL(7,2)) AS pressure",
            "CAST(0 AS DECIMAL(5,2)) AS precipitation",
            "(k * 13) % 104 AS cloud_cover",
            "CAST(k / CAST(10 AS DOUBLE) AS DECIMAL(3,1)) AS uv_index",
            "100 + k AS weather_code",
            "CAST(NULL AS STRING) AS weather_description",
            "hour(ts) BETWEEN 6 AND 18 AS is_day",
        )
    )


def site_hours_view(events: DataFrame) -> DataFrame:
    """Hourly production and weather per site; fifteen neighbouring panels make one site.

    Columns: site_id, ts_local (hour), hourly_production_kwh, temperature,
    cloudcover, ghi_wm2.  Readings without a production count for the weather only; an
    hour without any production has a NULL one.
    """
    hourly = (
        events.withColumn("k", F.expr(_K))
        .selectExpr(
            "'SITE-' || lpad(CAST(user_id DIV 15 AS STRING), 4, '0') AS site_id",
            "date_trunc('hour', ts) AS hour",
            "CASE WHEN event_id % 499 <> 498 THEN CAST(greatest(120 - value, 0) AS DECIMAL(8,3)) END AS kw",
            "k",
            "(k * 13) % 104 AS cloud",
        )
        .groupBy("site_id", "hour")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.nullif(F.count("kw"), F.lit(0)).alias("metered"),
            F.sum("kw").alias("kw"),
            F.sum("k").alias("k"),
            F.sum("cloud").alias("cloud"),
        )
    )
    return hourly.selectExpr(
        "site_id",
        "CAST(hour AS TIMESTAMP_NTZ) AS ts_local",
        "CAST(kw AS DOUBLE) / metered / 37 AS hourly_production_kwh",
        "CAST(k AS DOUBLE) / n - 25 AS temperature",
        "CAST(cloud AS DOUBLE) / n AS cloudcover",
        "CAST(kw AS DOUBLE) / metered * 7 AS ghi_wm2",
    )


def site_weather_view(weather: DataFrame) -> DataFrame:
    """Weather rows with the factor columns of a site weather file.

    ``cloud_factor`` and ``uv_factor`` are absent on part of the rows, so that
    the fallbacks of the production model are used as well.
    """
    return weather.selectExpr(
        "id",
        "city",
        "timestamp AS observation_time",
        "CAST(timestamp AS DATE) AS date",
        "hour(timestamp) AS hour",
        "month(timestamp) AS month",
        "CAST(temperature AS DOUBLE) AS temperature",
        "humidity",
        "CAST(wind_speed AS DOUBLE) AS wind_speed",
        "cloud_cover AS cloudcover",
        "CAST(uv_index AS DOUBLE) AS uv_index",
        "round(greatest(CAST(0 AS DOUBLE), sin(pi() * (hour(timestamp) - 6) / 12)), 4) "
        "AS solar_angle",
        "CASE WHEN id % 2 = 0 THEN (1000 - 9 * cloud_cover) / CAST(1000 AS DOUBLE) END "
        "AS cloud_factor",
        "CAST(1 AS DOUBLE) AS temp_efficiency",
        "CASE WHEN id % 3 <> 0 THEN CAST(uv_index AS DOUBLE) / 10 END AS uv_factor",
    ).withColumn(
        "solar_potential",
        F.expr("round(solar_angle * greatest(0, 100 - cloudcover) / CAST(100 AS DOUBLE), 6)"),
    )
