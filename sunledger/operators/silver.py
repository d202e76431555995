"""Bronze to silver: calendar parts, categories and validity flags in one projection.

Both builds are narrow: no shuffle, everything in one codegen span.
NULL measurements fall to the last category and make the row invalid.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.functions.clock import day_of_week_sunday0
from sunledger.functions.semantics import holds, ladder, within


# Unrounded production / power, NULL for a panel without rated power.
EFFICIENCY = "production_kw / nullif(panel_power_kw, 0)"


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": day_of_week_sunday0(ts),
    }


def temperature_category(value: str = "temperature") -> Column:
    return ladder(value, C.TEMPERATURE_LIMITS, C.TEMPERATURE_REST)


def sky_condition(value: str = "cloud_cover") -> Column:
    return ladder(value, C.SKY_LIMITS, C.SKY_REST)


def uv_category(value: str = "uv_index") -> Column:
    return ladder(value, C.UV_LIMITS, C.UV_REST)


def performance_category(ratio: str) -> Column:
    """From the unrounded ratio: 0.8004 is Excellent although it is stored as 0.800."""
    return ladder(ratio, C.PERFORMANCE_LIMITS, C.PERFORMANCE_REST, compare=">")


def weather_is_valid() -> Column:
    return holds(
        within("temperature", C.WEATHER_TEMPERATURE_RANGE),
        within("humidity", C.HUMIDITY_RANGE),
        "wind_speed >= 0",
        within("cloud_cover", C.CLOUD_COVER_RANGE),
    )


def reading_is_valid() -> Column:
    return holds(
        "production_kw >= 0",
        within("temperature_c", C.PANEL_TEMPERATURE_RANGE),
        within("cloud_factor", C.CLOUD_FACTOR_RANGE),
        within("temp_efficiency", C.TEMP_EFFICIENCY_RANGE),
    )


def build_silver_weather(weather: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Bronze weather -> silver_weather; ``as_of`` adds the audit column."""
    return weather.withColumns(
        {
            **calendar_parts(F.col("timestamp")),
            "temperature_category": temperature_category(),
            "sky_condition": sky_condition(),
            "uv_category": uv_category(),
            "is_valid": weather_is_valid(),
            **audit_column("silver_ingestion_time", as_of),
        }
    )


def build_silver_solar(readings: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Bronze readings -> silver_solar; ``as_of`` adds the audit column."""
    # the division is used by four expressions: computed once, below them
    return readings.withColumn("ratio", F.expr(EFFICIENCY)).withColumns(
        {
            **calendar_parts(F.col("timestamp")),
            "efficiency_ratio": F.col("ratio").cast("decimal(12,3)"),
            "performance_category": performance_category("ratio"),
            "is_valid": reading_is_valid(),
            **audit_column("silver_ingestion_time", as_of),
        }
    ).drop("ratio")


def audit_column(name: str, as_of: datetime | None) -> dict[str, Column]:
    return {} if as_of is None else {name: F.lit(as_of)}
