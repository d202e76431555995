"""Silver to gold: roll-ups and the joins of production with weather.

Each roll-up is one aggregate with a map-side combine; the distinct panel
counts are planned by Spark as (group, panel) first and group second, so a
single busy hour or month is still spread over all panels.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.semantics import percentage, stored_mean
from sunledger.functions.skew import pair_counts, pair_join, pair_tasks
from sunledger.operators.silver import audit_column


def _valid() -> Column:
    return F.count_if(F.col("is_valid"))


def daily_panel(silver_solar: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """gold_daily_panel: one row per day, panel and panel type.

    ``total_production_kwh`` adds up kW samples, as the source pipeline does.
    """
    production = F.col("production_kw")
    return (
        silver_solar.groupBy(F.to_date("timestamp").alias("date"), "panel_id", "panel_type")
        .agg(
            F.count(F.lit(1)).alias("readings_count"),
            stored_mean(production, 8, 3).alias("avg_production_kw"),
            F.sum(production).cast("decimal(20,2)").alias("total_production_kwh"),
            F.max(production).alias("peak_production_kw"),
            F.min(production).alias("min_production_kw"),
            stored_mean(F.col("efficiency_ratio"), 12, 3).alias("avg_efficiency"),
            _valid().alias("valid_readings"),
            F.count_if(~F.col("is_valid")).alias("invalid_readings"),
        )
        .withColumn("data_quality_pct", _quality(F.col("readings_count")))
        .withColumns(audit_column("gold_ingestion_time", as_of))
    )


def hourly_system(
    silver_solar: DataFrame, as_of: datetime | None = None, approximate_panels: bool = False
) -> DataFrame:
    """gold_hourly_system: the fleet per hour.

    ``approximate_panels`` trades the exact panel count for a single-pass sketch.
    """
    production = F.col("production_kw")
    panels = F.approx_count_distinct if approximate_panels else F.count_distinct
    return (
        silver_solar.groupBy(hour_of(F.col("timestamp"), silver_solar).alias("hour"))
        .agg(
            panels(F.col("panel_id")).alias("active_panels"),
            F.sum(production).cast("decimal(20,2)").alias("total_production_kw"),
            stored_mean(production, 8, 3).alias("avg_production_per_panel"),
            F.max(production).alias("peak_production_kw"),
            stored_mean(F.col("temperature_c"), 5, 1).alias("avg_temperature"),
            stored_mean(F.col("efficiency_ratio"), 12, 3).alias("avg_system_efficiency"),
            _valid().alias("valid_readings"),
        )
        .withColumns(audit_column("gold_ingestion_time", as_of))
    )


def monthly_kpis(silver_solar: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """gold_monthly_kpis, from silver: distinct panels and means do not add up from days."""
    production = F.col("production_kw")
    return (
        silver_solar.groupBy(
            F.year("timestamp").alias("year"), F.month("timestamp").alias("month")
        )
        .agg(
            F.count_distinct("panel_id").alias("total_panels"),
            F.sum(production).cast("decimal(22,2)").alias("total_production_kwh"),
            stored_mean(production, 8, 3).alias("avg_production_kw"),
            F.max(production).alias("peak_production_kw"),
            stored_mean(F.col("efficiency_ratio"), 12, 3).alias("avg_efficiency"),
            stored_mean(F.col("temperature_c"), 5, 1).alias("avg_temperature"),
            _valid().alias("valid_readings"),
            F.count(F.lit(1)).alias("readings"),
        )
        .withColumn("data_quality_pct", _quality(F.col("readings")))
        .drop("readings")
        .withColumns(audit_column("gold_ingestion_time", as_of))
    )


def weather_impact(silver_weather: DataFrame, silver_solar: DataFrame) -> DataFrame:
    """gold_weather_impact: every weather row with the fleet's production in its hour.

    Production is reduced to one row per hour first, so the join cannot fan
    out.  Hours without readings keep their weather with NULL production.
    """
    production = silver_solar.groupBy(
        hour_of(F.col("timestamp"), silver_solar).alias("hour")
    ).agg(
        stored_mean(F.col("production_kw"), 8, 3).alias("avg_solar_production"),
        F.count_distinct("panel_id").alias("reporting_panels"),
    )
    observed = silver_weather.select(
        hour_of(F.col("timestamp"), silver_weather).alias("hour"),
        *(
            "id timestamp city temperature humidity cloud_cover uv_index sky_condition".split()
        ),
    )
    joined = observed.join(production, "hour", "left")
    return joined.select(
        "timestamp",
        "city",
        "temperature",
        "humidity",
        "cloud_cover",
        "uv_index",
        "sky_condition",
        "avg_solar_production",
        F.coalesce("reporting_panels", F.lit(0)).alias("reporting_panels"),
    )


def combined_solar_weather(
    readings: DataFrame, weather: DataFrame, same_city: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """Each reading with every weather row of its hour (a reading without any keeps NULLs).

    ``same_city`` joins a reading with the weather of its own city only.

    An hour with several weather rows multiplies its readings: that is the
    content of this view.  The pairs are made after the join, from blocks of
    weather rows, see :func:`~sunledger.functions.skew.pair_join`.

    ``counts`` are the written :func:`combined_counts` of the same tables.  They are read
    at once, for the number of tasks that the size of the view asks for; without
    them nothing is run here, and Spark goes by the sizes of the two tables.
    """
    reading, observed, keys = _sides(readings, weather, same_city)
    joined = pair_join(
        reading,
        observed,
        keys,
        ["ambient_temperature", "humidity", "wind_speed", "cloud_cover", "uv_index"],
        pair_counts(reading, observed, keys) if counts is None else counts,
        None if counts is None else pair_tasks(counts),
    )
    return joined.select(
        "timestamp",
        "panel_id",
        "production_kw",
        "panel_temperature",
        "ambient_temperature",
        "humidity",
        "wind_speed",
        "cloud_cover",
        "uv_index",
    )


def combined_counts(readings: DataFrame, weather: DataFrame, same_city: bool = False) -> DataFrame:
    """Readings and weather rows per hour of :func:`combined_solar_weather`, a row for each hour."""
    return pair_counts(*_sides(readings, weather, same_city))


def _sides(readings: DataFrame, weather: DataFrame, same_city: bool) -> tuple[DataFrame, DataFrame, list[str]]:
    """Either side of the combined view with its hour, and the keys that they share."""
    place = ["city"] if same_city else []
    reading = readings.select(
        hour_of(F.col("timestamp"), readings).alias("hour"),
        *place,
        "event_id",
        "timestamp",
        "panel_id",
        "production_kw",
        F.col("temperature_c").alias("panel_temperature"),
    )
    observed = weather.select(
        hour_of(F.col("timestamp"), weather).alias("hour"),
        *place,
        "id",
        F.col("temperature").alias("ambient_temperature"),
        "humidity",
        "wind_speed",
        "cloud_cover",
        "uv_index",
    )
    return reading, observed, ["hour", *place]


def combined_report(readings: DataFrame, weather: DataFrame, by: str = "hour") -> DataFrame:
    """Rows, means and covariance of :func:`combined_solar_weather` per hour or panel, without building it.

    The view pairs every reading of an hour with every weather row of it, so its sums are products of the
    sums of either side.  Both sides are reduced to one row per hour (and panel) before they meet: the cost is
    that of reading them once, however many rows the view would have.  Readings of an hour without weather
    count once, those without a time too; NULLs do not enter a mean.
    """
    if by not in ("hour", "panel_id"):
        raise ValueError("the view is reported by hour or by panel_id")
    production, warmth = F.col("production_kw"), F.col("temperature_c")
    metered = readings.groupBy(
        hour_of(F.col("timestamp"), readings).alias("hour"), *(["panel_id"] if by == "panel_id" else [])
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(production).alias("n_kw"),
        F.sum(production).cast("decimal(18,3)").alias("kw"),
        F.count(warmth).alias("n_warm"),
        F.sum(warmth).cast("decimal(18,1)").alias("warm"),
    )
    observed = weather.groupBy(hour_of(F.col("timestamp"), weather).alias("hour")).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count("temperature").alias("n_air"),
        F.sum("temperature").cast("decimal(18,2)").alias("air"),
        F.count("cloud_cover").alias("n_cloud"),
        F.sum("cloud_cover").cast("decimal(18,0)").alias("cloud"),
    )
    paired = metered.join(observed, "hour", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))

    def total(left: str, right: str) -> Column:
        """Sum of ``left`` x ``right`` over the view as DOUBLE; a NULL sum of no values adds nothing."""
        factors = (_exact(paired, name) for name in (left, right))
        return F.sum(next(factors) * next(factors)).cast("double")

    def mean(sum_of: tuple[str, str], count_of: tuple[str, str]) -> Column:
        return total(*sum_of) / F.nullif(total(*count_of), F.lit(0.0))

    pairs = ("n_kw", "n_air")
    covariance = mean(("kw", "air"), pairs) - mean(("kw", "n_air"), pairs) * mean(("n_kw", "air"), pairs)
    return paired.groupBy(by).agg(
        F.sum(F.col("n") * F.col("copies")).alias("view_rows"),
        mean(("kw", "copies"), ("n_kw", "copies")).alias("avg_production_kw"),
        mean(("warm", "copies"), ("n_warm", "copies")).alias("avg_panel_temperature"),
        mean(("n", "air"), ("n", "n_air")).alias("avg_ambient_temperature"),
        mean(("n", "cloud"), ("n", "n_cloud")).alias("avg_cloud_cover"),
        covariance.alias("production_temperature_covariance"),
    )


def _exact(df: DataFrame, name: str) -> Column:
    """Counts as DECIMAL, so that products with sums are exact."""
    column = F.col(name)
    return column if df.schema[name].dataType.typeName() == "decimal" else column.cast("decimal(16,0)")


def hour_of(ts: Column, df: DataFrame, name: str = "timestamp") -> Column:
    """Start of the hour in the type of the column (``date_trunc`` alone returns TIMESTAMP)."""
    return F.date_trunc("hour", ts).cast(df.schema[name].dataType)


def _quality(total: Column) -> Column:
    return percentage(F.col("valid_readings"), total).cast("decimal(5,2)")
