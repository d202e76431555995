"""Data-quality and layer reports: one aggregate per input table, reshaped afterwards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.functions.clock import recent
from sunledger.functions.semantics import (
    decimal_mean,
    exact_mean,
    one_row,
    outside,
    percentage,
    share,
)
from sunledger.operators.anomalies import OPEN
from sunledger.schemas import SIMPLE_PRODUCTION_INPUT

# Verdict texts
HAS_DATA = "✅ PASS - All tables have data"
NO_DATA = "❌ FAIL - Some tables are empty"
MATCH, MISMATCH = "✅ MATCH", "❌ MISMATCH"
SILVER_EXCELLENT = "✅ EXCELLENT - Data quality >95% in both tables"
SILVER_GOOD = "⚠️ GOOD - Data quality >80% in both tables"
SILVER_POOR = "❌ POOR - Data quality below 80% in one or more tables"
GOLD_POPULATED = "✅ PASS - All gold tables populated"
GOLD_EMPTY = "❌ FAIL - Some gold tables are empty"
NO_ANOMALIES = "✅ PASS - No open anomalies"
SOME_ANOMALIES = ("⚠️ WARNING - ", " open anomalies")
MANY_ANOMALIES = ("❌ CRITICAL - ", " open anomalies require attention")
MANY_ANOMALIES_FROM = 5

# Reasons of invalid readings
NEGATIVE_PRODUCTION = "Negative production"
BAD_TEMPERATURE = "Temperature out of range"
BAD_CLOUD_FACTOR = "Invalid cloud factor"
BAD_EFFICIENCY = "Invalid efficiency"
OTHER_REASON = "Other"


def broken(column: str, bounds: tuple) -> Column:
    return F.expr(outside(column, bounds))


def _rows() -> Column:
    return F.count(F.lit(1))


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _per_table(tables: Mapping[str, DataFrame], *aggregates: Column) -> DataFrame:
    """The same aggregates over several tables, one row per table."""
    return _stack(
        [
            df.agg(*aggregates).select(F.lit(name).alias("table_name"), "*")
            for name, df in tables.items()
        ]
    )


# --------------------------------------------------------------------- bronze


def bronze_counts(weather: DataFrame, readings: DataFrame) -> DataFrame:
    return _per_table(
        {"weather_data": weather, "solar_panel_readings": readings},
        _rows().alias("row_count"),
        F.min("timestamp").alias("earliest_record"),
        F.max("timestamp").alias("latest_record"),
    )


def weather_quality(weather: DataFrame) -> DataFrame:
    temperature, humidity = F.col("temperature"), F.col("humidity")
    return weather.agg(
        _rows().alias("total_records"),
        F.count_if(temperature.isNull()).alias("null_temperature"),
        F.count_if(humidity.isNull()).alias("null_humidity"),
        F.count_if(broken("temperature", C.WEATHER_TEMPERATURE_RANGE)).alias("out_of_range_temp"),
        F.count_if(broken("humidity", C.HUMIDITY_RANGE)).alias("invalid_humidity"),
        F.count_if(broken("cloud_cover", C.CLOUD_COVER_RANGE)).alias(
            "invalid_cloud_cover"
        ),
    )


def reading_quality(readings: DataFrame) -> DataFrame:
    production = F.col("production_kw")
    return readings.agg(
        _rows().alias("total_records"),
        F.count_distinct("panel_id").alias("unique_panels"),
        F.count_if(production.isNull()).alias("null_production"),
        F.count_if(production < 0).alias("negative_production"),
        F.count_if(broken("temperature_c", C.PANEL_TEMPERATURE_RANGE)).alias(
            "out_of_range_temp"
        ),
        F.count_if(broken("cloud_factor", C.CLOUD_FACTOR_RANGE)).alias(
            "invalid_cloud_factor"
        ),
        F.count_if(broken("temp_efficiency", C.TEMP_EFFICIENCY_RANGE)).alias(
            "invalid_efficiency"
        ),
    )


def panel_summary(readings: DataFrame) -> DataFrame:
    production = F.col("production_kw")
    return (
        readings.groupBy("panel_id")
        .agg(
            _rows().alias("readings"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
            exact_mean(production).alias("avg_production"),
            F.min(production).alias("min_production"),
            F.max(production).alias("max_production"),
        )
        .orderBy(F.col("panel_id").asc_nulls_last())
    )


def city_summary(weather: DataFrame) -> DataFrame:
    temperature = F.col("temperature")
    return weather.groupBy("city").agg(
        _rows().alias("readings"),
        exact_mean(temperature).alias("avg_temp"),
        F.min(temperature).alias("min_temp"),
        F.max(temperature).alias("max_temp"),
        exact_mean(F.col("humidity")).alias("avg_humidity"),
    )


def duplicate_check(
    weather: DataFrame, readings: DataFrame, approximate: bool = False
) -> DataFrame:
    """Rows beyond the first per (timestamp, city) and per event id.

    A (timestamp, city) with a missing part is a value of its own, a missing
    event id is not.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return _stack(
        [
            df.agg((_rows() - distinct(key)).alias("potential_duplicates")).select(
                F.lit(name).alias("table_name"), "potential_duplicates"
            )
            for name, df, key in (
                ("weather_data", weather, F.struct("timestamp", "city")),
                ("solar_panel_readings", readings, F.col("event_id")),
            )
        ]
    )


def hour_distribution(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy(F.hour("timestamp").alias("hour_of_day"))
        .agg(_rows().alias("readings"), exact_mean(F.col("production_kw")).alias("avg_production"))
        .orderBy(F.col("hour_of_day").asc_nulls_last())
    )


def bronze_verdict(weather: DataFrame, readings: DataFrame) -> DataFrame:
    counts = _per_table({"w": weather, "r": readings}, _rows().alias("n"))
    return counts.agg(
        F.when(F.min("n") > 0, HAS_DATA).otherwise(NO_DATA).alias("data_presence_check"),
        F.concat_ws("", F.lit("Total records: "), F.sum("n").cast("string")).alias(
            "total_records"
        ),
    )


# --------------------------------------------------------------------- silver


def reconciliation(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and target per named pair, MATCH or MISMATCH."""
    return _stack(
        [
            source.agg(_rows().alias("bronze_count")).select(
                F.lit(name).alias("source"),
                "bronze_count",
                target.agg(_rows()).scalar().alias("silver_count"),
            )
            for name, (source, target) in pairs.items()
        ]
    ).withColumn(
        "status",
        F.when(F.col("bronze_count") == F.col("silver_count"), MATCH).otherwise(MISMATCH),
    )


def _validity() -> list[Column]:
    valid = F.count_if(F.col("is_valid"))
    return [
        _rows().alias("total_records"),
        valid.alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("invalid_records"),
        percentage(valid, _rows()).alias("quality_pct"),
    ]


def silver_weather_quality(silver_weather: DataFrame) -> DataFrame:
    """Counts and the number of categories in use (each has at most five values)."""
    return silver_weather.agg(
        *_validity(),
        F.size(F.collect_set("temperature_category")).alias("temp_categories"),
        F.size(F.collect_set("sky_condition")).alias("sky_categories"),
        F.size(F.collect_set("uv_category")).alias("uv_categories"),
    )


def silver_solar_quality(silver_solar: DataFrame) -> DataFrame:
    ratio = F.col("efficiency_ratio")
    return silver_solar.agg(
        *_validity(),
        F.size(F.collect_set("performance_category")).alias("performance_categories"),
        exact_mean(ratio).alias("avg_efficiency"),
        F.min(ratio).alias("min_efficiency"),
        F.max(ratio).alias("max_efficiency"),
    )


def category_distribution(silver_weather: DataFrame) -> DataFrame:
    """Temperature and sky categories with their share, from one pass over the rows.

    The cube of both categories has at most 15 cells; everything after it works
    on those.
    """
    cells = silver_weather.groupBy("temperature_category", "sky_condition").agg(
        _rows().alias("n")
    )
    long = cells.select(
        "n",
        F.explode(
            F.array(
                F.struct(
                    F.lit("Temperature").alias("category_type"),
                    F.col("temperature_category").alias("category"),
                ),
                F.struct(
                    F.lit("Sky Condition").alias("category_type"),
                    F.col("sky_condition").alias("category"),
                ),
            )
        ).alias("c"),
    )
    counted = long.groupBy("c.category_type", "c.category").agg(F.sum("n").alias("count"))
    whole = Window.partitionBy("category_type")
    return counted.withColumn(
        "percentage", percentage(F.col("count"), F.sum("count").over(whole))
    ).orderBy("category_type", F.col("count").desc(), "category")


def performance_distribution(silver_solar: DataFrame) -> DataFrame:
    """Performance classes in their own order; the window runs over four rows."""
    ranked = F.when(F.lit(False), 0)
    for position, (_, label) in enumerate(C.PERFORMANCE_LIMITS, start=1):
        ranked = ranked.when(F.col("performance_category") == label, position)
    ranked = ranked.when(F.col("performance_category") == C.PERFORMANCE_REST, 4).otherwise(5)
    return (
        silver_solar.groupBy("performance_category")
        .agg(
            _rows().alias("readings"),
            exact_mean(F.col("production_kw")).alias("avg_production"),
            exact_mean(F.col("efficiency_ratio")).alias("avg_efficiency"),
        )
        .withColumn(
            "percentage",
            percentage(F.col("readings"), F.sum("readings").over(Window.partitionBy())),
        )
        .orderBy(ranked)
    )


def invalid_share(silver_weather: DataFrame) -> DataFrame:
    invalid = F.count_if(~F.col("is_valid"))
    return silver_weather.agg(
        F.lit("weather").alias("source"),
        invalid.alias("count"),
        percentage(invalid, _rows()).alias("percentage"),
    )


def invalid_reasons(silver_solar: DataFrame) -> DataFrame:
    """Invalid readings by the first rule they break; Other are missing values."""
    reason = (
        F.when(F.col("production_kw") < 0, NEGATIVE_PRODUCTION)
        .when(broken("temperature_c", C.PANEL_TEMPERATURE_RANGE), BAD_TEMPERATURE)
        .when(broken("cloud_factor", C.CLOUD_FACTOR_RANGE), BAD_CLOUD_FACTOR)
        .when(broken("temp_efficiency", C.TEMP_EFFICIENCY_RANGE), BAD_EFFICIENCY)
        .otherwise(OTHER_REASON)
    )
    return (
        silver_solar.where(~F.col("is_valid"))
        .groupBy(reason.alias("reason"))
        .agg(_rows().alias("count"))
        .orderBy(F.col("count").desc(), "reason")
    )


def time_coverage(silver_weather: DataFrame, silver_solar: DataFrame) -> DataFrame:
    """First and last timestamp and the whole days between them."""
    micros = F.unix_micros(F.col("latest").cast("timestamp")) - F.unix_micros(
        F.col("earliest").cast("timestamp")
    )
    return _per_table(
        {"silver_weather": silver_weather, "silver_solar": silver_solar},
        F.min("timestamp").alias("earliest"),
        F.max("timestamp").alias("latest"),
    ).withColumn("days_covered", F.floor(micros / F.lit(86_400_000_000)))


def silver_verdict(silver_weather: DataFrame, silver_solar: DataFrame) -> DataFrame:
    def valid_and_all(df: DataFrame, prefix: str) -> DataFrame:
        return df.agg(
            F.count_if(F.col("is_valid")).alias(f"{prefix}_valid"), _rows().alias(f"{prefix}_rows")
        )

    both = valid_and_all(silver_weather, "w").select(
        "*", one_row(valid_and_all(silver_solar, "s")).alias("solar")
    ).select("w_valid", "w_rows", "solar.*")
    lowest = F.least(
        share(F.col("w_valid"), F.col("w_rows")), share(F.col("s_valid"), F.col("s_rows"))
    )
    either_empty = (F.col("w_rows") == 0) | (F.col("s_rows") == 0)

    def shown(part: str, whole: str) -> Column:
        return percentage(F.col(part), F.col(whole), 1).cast("decimal(10,1)").cast("string")

    return both.select(
        F.when(either_empty, SILVER_POOR)
        .when(lowest > 0.95, SILVER_EXCELLENT)
        .when(lowest > 0.8, SILVER_GOOD)
        .otherwise(SILVER_POOR)
        .alias("data_quality_verdict"),
        F.concat_ws(
            "",
            F.lit("Weather: "),
            shown("w_valid", "w_rows"),
            F.lit("%, Solar: "),
            shown("s_valid", "s_rows"),
            F.lit("%"),
        ).alias("quality_percentages"),
    )


# ----------------------------------------------------------------------- gold


def layer_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows of every table of every layer."""
    return _stack(
        [
            _per_table(tables, _rows().alias("row_count")).withColumn("layer", F.lit(layer))
            for layer, tables in layers.items()
        ]
    ).orderBy("layer", "table_name")


def daily_fleet(daily_panel: DataFrame, days: int = 7) -> DataFrame:
    """The latest ``days`` days of the whole fleet."""
    return (
        daily_panel.groupBy("date")
        .agg(
            F.count_distinct("panel_id").alias("panels_reporting"),
            F.round(F.sum("total_production_kwh"), 2).alias("total_production"),
            _rounded_mean("avg_efficiency", 3),
            _rounded_mean("data_quality_pct", 1, "avg_quality"),
        )
        .orderBy(F.col("date").desc_nulls_first())
        .limit(days)
    )


def panel_ranking(
    daily_panel: DataFrame, as_of: datetime, best: bool = True, k: int = 5, days: int = 7
) -> DataFrame:
    """Top or bottom ``k`` panels of the last days; ties go to the smaller panel id."""
    produced = F.col("total_7day_production")
    return (
        daily_panel.where(F.col("date") >= F.lit(as_of.date() - timedelta(days=days)))
        .groupBy("panel_id")
        .agg(
            F.sum("total_production_kwh").alias("total_7day_production"),
            _rounded_mean("avg_efficiency", 3),
            _rounded_mean("data_quality_pct", 1, "data_quality"),
        )
        .orderBy(
            produced.desc_nulls_first() if best else produced.asc_nulls_last(),
            F.col("panel_id").asc_nulls_last(),
        )
        .limit(k)
    )


def hourly_last_day(hourly_system: DataFrame, as_of: datetime) -> DataFrame:
    return (
        recent(hourly_system, as_of, timedelta(hours=24), ts="hour", inclusive=True)
        .select(
            "hour",
            "active_panels",
            F.round("total_production_kw", 2).alias("total_kw"),
            F.round("avg_production_per_panel", 3).alias("avg_per_panel"),
            F.round("avg_system_efficiency", 3).alias("efficiency"),
            "valid_readings",
        )
        .orderBy(F.col("hour").desc())
    )


def impact_by_sky(weather_impact: DataFrame) -> DataFrame:
    return (
        weather_impact.groupBy("sky_condition")
        .agg(
            _rows().alias("samples"),
            _rounded_mean("avg_solar_production", 3, "avg_production"),
            _rounded_mean("temperature", 1, "avg_temperature"),
            _rounded_mean("cloud_cover", 1, "avg_clouds"),
        )
        .orderBy(F.col("avg_production").desc_nulls_first())
    )


def monthly_listing(monthly_kpis: DataFrame) -> DataFrame:
    return monthly_kpis.select(
        "year",
        "month",
        "total_panels",
        F.round("total_production_kwh", 2).alias("total_production_kwh"),
        F.round("avg_production_kw", 3).alias("avg_production_kw"),
        F.round("avg_efficiency", 3).alias("avg_efficiency"),
        "data_quality_pct",
    ).orderBy(F.col("year").desc(), F.col("month").desc())


def completeness(daily_panel: DataFrame) -> DataFrame:
    """Calendar span against the days that have data."""
    return daily_panel.agg(
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count_distinct("date").alias("days_with_data"),
    ).select(
        F.concat_ws(
            "", F.col("first").cast("string"), F.lit(" to "), F.col("last").cast("string")
        ).alias("coverage_period"),
        (F.datediff("last", "first") + 1).alias("days_covered"),
        "days_with_data",
    )


def gold_verdict(
    daily_panel: DataFrame,
    hourly_system: DataFrame,
    monthly_kpis: DataFrame,
    anomalies: DataFrame,
) -> DataFrame:
    checks = anomalies.agg(
        F.count_if(F.col("resolution_status") == OPEN).alias("open_anomalies")
    ).select(
        "open_anomalies",
        *(
            _has_rows(df).alias(name)
            for name, df in (
                ("has_daily", daily_panel),
                ("has_hourly", hourly_system),
                ("has_monthly", monthly_kpis),
            )
        ),
    )
    count = F.col("open_anomalies").cast("string")

    def text(parts: tuple[str, str]) -> Column:
        return F.concat(F.lit(parts[0]), count, F.lit(parts[1]))

    return checks.select(
        F.when(
            F.col("has_daily") & F.col("has_hourly") & F.col("has_monthly"), GOLD_POPULATED
        )
        .otherwise(GOLD_EMPTY)
        .alias("tables_check"),
        F.when(F.col("open_anomalies") == 0, NO_ANOMALIES)
        .when(F.col("open_anomalies") < MANY_ANOMALIES_FROM, text(SOME_ANOMALIES))
        .otherwise(text(MANY_ANOMALIES))
        .alias("anomalies_check"),
    )


def layer_gate(bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """May the next layer be built?  Bronze needs one filled table, silver all of them."""
    parts = []
    for layer, tables, enough in (("bronze", bronze, F.max), ("silver", silver, F.min)):
        counts = _per_table(tables, _rows().alias("n"))
        parts.append(
            counts.agg(
                F.lit(layer).alias("layer"),
                F.sum("n").alias("row_count"),
                (enough("n") > 0).alias("ready"),
            )
        )
    return _stack(parts)


def required_columns(
    df: DataFrame, required: Sequence[str] = SIMPLE_PRODUCTION_INPUT, date: str = "date"
) -> DataFrame:
    """One row: missing columns, row count and date range of an input table."""
    missing = [name for name in required if name not in df.columns]
    return df.agg(
        F.lit(", ".join(missing)).alias("missing_columns"),
        _rows().alias("total_rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def weather_by_sky(silver_weather: DataFrame) -> DataFrame:
    return silver_weather.groupBy("sky_condition").agg(
        _rows().alias("count"), exact_mean(F.col("temperature")).alias("avg_temperature")
    )


def business_metrics(
    silver_solar: DataFrame,
    hourly_system: DataFrame,
    anomalies: DataFrame,
) -> DataFrame:
    """One row of headline numbers; each table is aggregated once."""
    fleet = silver_solar.agg(
        exact_mean(F.col("efficiency_ratio")).alias("system_efficiency"),
        F.count_if(F.col("is_valid")).alias("valid_readings"),
        _rows().alias("total_readings"),
    )
    raised = anomalies.agg(
        _rows().alias("anomalies"),
        F.count_if(F.col("resolution_status") == OPEN).alias("open_anomalies"),
    )
    peak = hourly_system.agg(F.max("total_production_kw").alias("peak_production_kw"))
    return (
        fleet.withColumn("raised", one_row(raised))
        .withColumn("peak_production_kw", peak.scalar())
        .select(
            "system_efficiency",
            share(F.col("valid_readings"), F.col("total_readings")).alias("data_quality"),
            F.col("raised.open_anomalies").alias("open_anomalies"),
            "peak_production_kw",
            share(F.col("raised.anomalies"), F.col("total_readings")).alias("anomaly_rate"),
        )
    )


def open_anomalies_per_panel(anomalies: DataFrame) -> DataFrame:
    """Panel uptime metric: open anomalies of each panel."""
    return (
        anomalies.where(F.col("resolution_status") == OPEN)
        .groupBy("panel_id")
        .agg(_rows().alias("open_anomalies"))
    )


def latest_rows(df: DataFrame, k: int, tie: str, ts: str = "timestamp") -> DataFrame:
    """The ``k`` newest rows (a top-k, never a full sort)."""
    return df.orderBy(F.col(ts).desc_nulls_first(), F.col(tie)).limit(k)


def _has_rows(df: DataFrame) -> Column:
    return df.agg((_rows() > 0).alias("has_rows")).scalar()


def _rounded_mean(column: str, scale: int, alias: str | None = None) -> Column:
    return F.round(decimal_mean(F.col(column)), scale).alias(alias or column)
