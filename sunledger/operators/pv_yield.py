"""PV production models as pure column expressions (no UDF, one codegen span)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.functions.semantics import exact_mean, stable_mean
from sunledger.functions.sun import IRRADIANCE_STEPS, PANEL_STEPS, POSITION_STEPS

SITE_COLUMNS = tuple(name for name in asdict(C.Site()) if name not in ("city", "timezone"))


def simple_production(
    weather: DataFrame, panel: C.Panel = C.Panel(), losses: C.Losses = C.Losses()
) -> DataFrame:
    """Adds ``hourly_kwh`` from sun angle, cloud, temperature and UV factors.

    ``cloud_factor`` and ``uv_factor`` are used where present; otherwise they
    follow from ``cloudcover`` (clipped to 0.1..1) and ``uv_index``.
    """
    cloud = _given(weather, "cloud_factor", "greatest(0.1D, least(1D, 1D - cloudcover / 100D))")
    uv = _given(weather, "uv_factor", "least(1D, uv_index / 10D)")
    warm = F.expr(
        f"CASE WHEN temperature > 25 THEN 1D - (temperature - 25D) * {panel.temp_loss_coeff}D "
        "ELSE 1D END"
    )
    factor = F.col("solar_angle") * cloud * warm * uv * losses.derating_factor
    kwh = panel.power_kw * factor * panel.efficiency * (1 - losses.system_losses)
    return weather.withColumn("hourly_kwh", F.greatest(F.lit(0.0), kwh))


def _given(df: DataFrame, column: str, fallback: str) -> Column:
    derived = F.expr(fallback)
    return F.coalesce(F.col(column), derived) if column in df.columns else derived


def with_site(weather: DataFrame, site: C.Site = C.Site()) -> DataFrame:
    """Parameters of one site as literal columns."""
    parameters = asdict(site)
    return weather.withColumns({name: F.lit(parameters[name]) for name in SITE_COLUMNS})


def with_sites(weather: DataFrame, sites: DataFrame) -> DataFrame:
    """Parameters of many sites, looked up by city: broadcast while they fit, else Spark splits a
    busy city's partition."""
    return weather.join(sites.select("city", *SITE_COLUMNS), "city")


def pv_yield(weather: DataFrame) -> DataFrame:
    """Hourly production of a PV system under given weather.

    Input: city, ts_local (local wall clock, no zone), utc_offset_hours,
    temperature, humidity, wind_speed, cloudcover and the site columns of
    :func:`with_site` or :func:`with_sites`.  The offset is an input so that a
    summer-time day keeps 24 wall-clock hours.
    """
    df = weather.withColumn("cloud", F.col("cloudcover").cast("double"))
    for step in (*POSITION_STEPS, *IRRADIANCE_STEPS, *PANEL_STEPS):
        df = df.withColumns({name: F.expr(text) for name, text in step.items()})
    return df.selectExpr(
        *(["id"] if "id" in weather.columns else []),
        "city",
        "ts_local AS timestamp",
        "CAST(ts_local AS DATE) AS date",
        "hour(ts_local) AS hour",
        "month(ts_local) AS month",
        "day_of_year",
        "CAST(solar_factor > 0 AS INT) AS is_daylight",
        "temperature",
        "humidity",
        "wind_speed",
        "cloudcover",
        "uv AS uv_index",
        "round(elevation, 3) AS solar_elevation_deg",
        "round(azimuth, 3) AS solar_azimuth_deg",
        "round(solar_factor, 6) AS solar_angle",
        "round(transmittance, 6) AS cloud_factor",
        "round(cell_efficiency, 6) AS temp_efficiency",
        "round(greatest(0D, least(1D, uv / 10D)), 6) AS uv_factor",
        "round(clear_sky, 2) AS clear_sky_ghi_wm2",
        "round(ghi, 2) AS ghi_wm2",
        "round(poa, 2) AS poa_irradiance_wm2",
        "round(cell, 2) AS cell_temperature_c",
        "round(kw, 6) AS production_kw",
        "round(kw, 6) AS hourly_production_kwh",
        "round(kw, 6) AS solar_potential",
    )


def wall_clock_hours(sites: DataFrame, days: Sequence[date]) -> DataFrame:
    """``sites`` once per hour of the local calendar ``days``: always 24 rows a day, by the clock on the wall.

    Adds ts_local and utc_offset_hours, from the rules of the column ``timezone``.
    """
    listed = F.array(*(F.lit(day) for day in days)).cast("array<date>")
    hours = sites.withColumn("__day", F.explode(listed)).withColumn("__hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    moment = F.expr("timestampadd(HOUR, __hour, CAST(__day AS TIMESTAMP_NTZ))")
    return with_offset(hours.withColumn("ts_local", moment).drop("__day", "__hour"))


def with_offset(df: DataFrame, zone: str = "timezone", ts: str = "ts_local") -> DataFrame:
    """Adds ``utc_offset_hours`` of the wall clock ``ts`` in each row's own zone (needs a UTC session).

    A wall clock that summer time skips has the offset before the change, one that occurs twice the
    earlier occurrence's.  A NULL zone or time has no offset; an unknown zone is an error.
    """
    local = F.col(ts).cast("timestamp")
    ahead = F.unix_seconds(local) - F.unix_seconds(F.to_utc_timestamp(local, F.col(zone)))
    return df.withColumn("utc_offset_hours", ahead / F.lit(3600.0))


def monthly_normals(
    df: DataFrame, ts: str = "ts_local", normals: dict[str, tuple] = C.MONTHLY_NORMALS
) -> DataFrame:
    """Adds each normal, interpolated from its month to the next by the day of the month.

    Twelve values per variable travel as array literals: no join.
    """
    passed = f"(dayofmonth({ts}) - 1 + hour({ts}) / 24D) / dayofmonth(last_day({ts}))"

    def between(values: tuple) -> Column:
        listed = "array(" + ", ".join(f"{float(v)}D" for v in values) + ")"
        this, following = f"month({ts})", f"month({ts}) % 12 + 1"
        return F.expr(
            f"element_at({listed}, {this}) + (element_at({listed}, {following}) "
            f"- element_at({listed}, {this})) * {passed}"
        )

    return df.withColumns({name: between(values) for name, values in normals.items()})


def expected_and_actual(yields: DataFrame, readings: DataFrame) -> DataFrame:
    """Model against meter, by city and hour: both sides are reduced to one row per hour.

    An hour that only one side knows stays, without a ratio.
    """
    modelled = yields.groupBy("city", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        stable_mean(F.col("production_kw")).alias("expected_kw")
    )
    metered = readings.groupBy("city", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        exact_mean(F.col("production_kw")).alias("actual_kw")
    )
    return modelled.join(metered, ["city", "hour"], "full").withColumn(
        "ratio", F.try_divide("actual_kw", "expected_kw")
    )
