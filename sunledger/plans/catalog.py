"""Every registered query: name -> callable(spark, folder) -> DataFrame.

Each runs its operator over the whole tables of ``folder``.  ``publish`` turns
the result into plain comparable types.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger import constants as C
from sunledger.operators import (
    anomalies,
    bands,
    climate,
    daystates,
    economics,
    energy,
    gold,
    monitoring,
    pv_yield as pv,
    quality,
    silver as silver_ops,
)
from sunledger.functions.semantics import exact_mean, join_null_safe
from sunledger.plans import feasibility, refresh
from sunledger.plans.fleet import Fleet
from sunledger.session import materialise, work_folder
from sunledger.schemas import SITE_WEATHER_CSV
from sunledger.sources import messages, tables
from sunledger.sources.events import readings_view
from sunledger.streaming import decode, ingest, rollup

AS_OF = datetime(2024, 1, 30, 23, 59, 59, 999999)
NOON = datetime(2024, 1, 30, 12, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Fleet], DataFrame]) -> Callable[[Fleet], DataFrame]:
    """Register ``function`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return publish(function(Fleet(spark, folder, AS_OF)))

    QUERIES[function.__name__] = run
    return function


def publish(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, all integers as BIGINT, timestamps without zone, arrays as text."""

    def plain(field: T.StructField) -> str:
        name, dtype = f"`{field.name}`", field.dataType
        if isinstance(dtype, T.DecimalType):
            return f"CAST({name} AS DOUBLE) AS {name}"
        if isinstance(dtype, T.IntegralType):
            return f"CAST({name} AS BIGINT) AS {name}"
        if isinstance(dtype, T.TimestampType):
            return f"CAST({name} AS TIMESTAMP_NTZ) AS {name}"
        if isinstance(dtype, T.ArrayType):
            return f"array_join({name}, '; ') AS {name}"
        return name

    return df.selectExpr(*(plain(field) for field in df.schema.fields))


# ------------------------------------------------------------ silver and gold


@query
def silver_solar(f: Fleet) -> DataFrame:
    return f.silver_solar


@query
def silver_weather(f: Fleet) -> DataFrame:
    # two columns that the events cannot fill
    return f.silver_weather.drop("wind_direction", "weather_description")


@query
def gold_daily_panel(f: Fleet) -> DataFrame:
    return f.daily_panel


@query
def gold_hourly_system(f: Fleet) -> DataFrame:
    return f.hourly_system


@query
def gold_monthly_kpis(f: Fleet) -> DataFrame:
    return f.monthly_kpis


@query
def gold_monthly_from_days(f: Fleet) -> DataFrame:
    """gold_monthly_kpis from written states per day, panels counted exactly."""
    numbers = materialise(daystates.panel_numbers(f.silver_solar), "panel-numbers")
    production = materialise(daystates.production_states(f.silver_solar), "production-days")
    bitmaps = materialise(daystates.panel_bitmaps(f.silver_solar, numbers), "panel-days")
    return daystates.months_of_days(production, bitmaps)


@query
def gold_weather_impact(f: Fleet) -> DataFrame:
    return f.weather_impact


@query
def combined_solar_weather(f: Fleet) -> DataFrame:
    # plain types before the join: the view has a row per pair, and a cast of a decimal costs more than the pair
    readings, weather = publish(f.readings), publish(f.weather)
    counts = materialise(gold.combined_counts(readings, weather), "hour-counts")
    return gold.combined_solar_weather(readings, weather, counts=counts)


def _combined(f: Fleet, by: str) -> DataFrame:
    name = "production_temperature_covariance"
    return gold.combined_report(f.readings, f.weather, by).withColumn(name, F.round(name, 6))


@query
def combined_by_hour(f: Fleet) -> DataFrame:
    return _combined(f, "hour")


@query
def combined_by_panel(f: Fleet) -> DataFrame:
    return _combined(f, "panel_id")


# ------------------------------------------------------------------ anomalies


@query
def panel_stats(f: Fleet) -> DataFrame:
    return anomalies.panel_stats(f.silver_solar, AS_OF).withColumn(
        "stddev_production", F.round("stddev_production", 6)
    )


@query
def anomaly_low_production(f: Fleet) -> DataFrame:
    return _raised(anomalies.detect_low_production(f.silver_solar, AS_OF))


@query
def anomaly_high_temperature(f: Fleet) -> DataFrame:
    return _raised(anomalies.detect_high_temperature(f.silver_solar, AS_OF))


@query
def anomaly_missing_data(f: Fleet) -> DataFrame:
    return _raised(anomalies.detect_missing_data(f.silver_solar, AS_OF))


@query
def anomaly_missing_simple(f: Fleet) -> DataFrame:
    return _raised(anomalies.detect_missing_simple(f.silver_solar, AS_OF))


@query
def anomaly_sudden_drop(f: Fleet) -> DataFrame:
    return _raised(anomalies.detect_sudden_drop(f.silver_solar, AS_OF))


@query
def anomaly_incremental(f: Fleet) -> DataFrame:
    """The evening run, after a run at noon has raised its share."""
    at_noon = materialise(f.anomalies_of_first_run(NOON))
    return _raised(f.detection_run(AS_OF, existing=at_noon))


@query
def anomaly_today_summary(f: Fleet) -> DataFrame:
    return anomalies.today_summary(f.anomalies, AS_OF)


@query
def anomaly_today_by_type(f: Fleet) -> DataFrame:
    return anomalies.today_by_type(f.anomalies, AS_OF)


@query
def anomaly_open_rollup(f: Fleet) -> DataFrame:
    return anomalies.open_rollup(f.anomalies)


@query
def anomaly_open_panels(f: Fleet) -> DataFrame:
    return anomalies.open_panels(f.anomalies)


def _history(f: Fleet) -> DataFrame:
    """Two first runs, half a month apart."""
    middle = f.anomalies_of_first_run(datetime(2024, 1, 15, 23, 59, 59, 999999))
    return middle.unionByName(f.anomalies)


@query
def anomaly_purge(f: Fleet) -> DataFrame:
    return _raised(anomalies.purge(_history(f), datetime(2024, 2, 20)))


@query
def anomaly_auto_resolve(f: Fleet) -> DataFrame:
    return _raised(anomalies.auto_resolve(_history(f), datetime(2024, 2, 20)))


@query
def anomaly_maintenance(f: Fleet) -> DataFrame:
    """A written table of three runs after maintenance: one day is dropped, one resolved, one untouched."""
    lake = refresh.Lake(f.spark, work_folder(f.spark, "lake"))
    early = f.anomalies_of_first_run(datetime(2024, 1, 5, 23, 59, 59, 999999))
    lake.append_anomalies(_history(f).unionByName(early))
    refresh.maintain_anomalies(lake, datetime(2024, 2, 20), keep=timedelta(days=40))
    return _raised(lake.anomalies())


def _raised(found: DataFrame) -> DataFrame:
    return found.select(
        "detection_time",
        "anomaly_date",
        "panel_id",
        "anomaly_type",
        "severity",
        "expected_value",
        "actual_value",
        "deviation_percentage",
        "resolution_status",
    )


# -------------------------------------------------------------------- quality


def _bronze(f: Fleet) -> dict[str, DataFrame]:
    return {"weather_data": f.weather, "solar_panel_readings": f.readings}


def _silver(f: Fleet) -> dict[str, DataFrame]:
    return {"silver_weather": f.silver_weather, "silver_solar": f.silver_solar}


@query
def bronze_counts(f: Fleet) -> DataFrame:
    return quality.bronze_counts(f.weather, f.readings)


@query
def weather_dq(f: Fleet) -> DataFrame:
    return quality.weather_quality(f.weather)


@query
def reading_dq(f: Fleet) -> DataFrame:
    return quality.reading_quality(f.readings)


@query
def panel_summary(f: Fleet) -> DataFrame:
    return quality.panel_summary(f.readings)


@query
def city_summary(f: Fleet) -> DataFrame:
    return quality.city_summary(f.weather)


@query
def duplicate_check(f: Fleet) -> DataFrame:
    return quality.duplicate_check(f.weather, f.readings)


@query
def hour_distribution(f: Fleet) -> DataFrame:
    return quality.hour_distribution(f.readings)


@query
def bronze_verdict(f: Fleet) -> DataFrame:
    return quality.bronze_verdict(f.weather, f.readings)


@query
def layer_reconciliation(f: Fleet) -> DataFrame:
    return quality.reconciliation(
        {
            "weather_data": (f.weather, f.silver_weather),
            "solar_panel_readings": (f.readings, f.silver_solar),
        }
    )


@query
def silver_weather_quality(f: Fleet) -> DataFrame:
    return quality.silver_weather_quality(f.silver_weather)


@query
def silver_solar_quality(f: Fleet) -> DataFrame:
    return quality.silver_solar_quality(f.silver_solar)


@query
def category_distribution(f: Fleet) -> DataFrame:
    return quality.category_distribution(f.silver_weather)


@query
def performance_distribution(f: Fleet) -> DataFrame:
    return quality.performance_distribution(f.silver_solar)


@query
def invalid_share(f: Fleet) -> DataFrame:
    return quality.invalid_share(f.silver_weather)


@query
def invalid_reasons(f: Fleet) -> DataFrame:
    return quality.invalid_reasons(f.silver_solar)


@query
def time_coverage(f: Fleet) -> DataFrame:
    return quality.time_coverage(f.silver_weather, f.silver_solar)


@query
def silver_verdict(f: Fleet) -> DataFrame:
    return quality.silver_verdict(f.silver_weather, f.silver_solar)


@query
def layer_counts(f: Fleet) -> DataFrame:
    return quality.layer_counts(
        {
            "bronze": _bronze(f),
            "silver": _silver(f),
            "gold": {
                "gold_daily_panel": f.daily_panel,
                "gold_hourly_system": f.hourly_system,
                "gold_weather_impact": f.weather_impact,
                "gold_monthly_kpis": f.monthly_kpis,
                "gold_anomalies": materialise(f.anomalies),
            },
        }
    )


@query
def daily_fleet_7d(f: Fleet) -> DataFrame:
    return quality.daily_fleet(f.daily_panel)


@query
def top_panels_7d(f: Fleet) -> DataFrame:
    return quality.panel_ranking(f.daily_panel, AS_OF, best=True)


@query
def bottom_panels_7d(f: Fleet) -> DataFrame:
    return quality.panel_ranking(f.daily_panel, AS_OF, best=False)


@query
def hourly_24h(f: Fleet) -> DataFrame:
    return quality.hourly_last_day(f.hourly_system, AS_OF)


@query
def weather_impact_by_sky(f: Fleet) -> DataFrame:
    return quality.impact_by_sky(f.weather_impact)


@query
def monthly_kpi_listing(f: Fleet) -> DataFrame:
    return quality.monthly_listing(f.monthly_kpis)


@query
def completeness(f: Fleet) -> DataFrame:
    return quality.completeness(f.daily_panel)


@query
def gold_verdict(f: Fleet) -> DataFrame:
    return quality.gold_verdict(f.daily_panel, f.hourly_system, f.monthly_kpis, f.anomalies)


@query
def layer_gate(f: Fleet) -> DataFrame:
    return quality.layer_gate(_bronze(f), _silver(f))


@query
def required_columns(f: Fleet) -> DataFrame:
    return quality.required_columns(f.site_weather)


@query
def weather_by_sky(f: Fleet) -> DataFrame:
    return quality.weather_by_sky(f.silver_weather)


@query
def business_metrics(f: Fleet) -> DataFrame:
    return quality.business_metrics(f.silver_solar, f.hourly_system, f.anomalies)


@query
def open_anomalies_per_panel(f: Fleet) -> DataFrame:
    return quality.open_anomalies_per_panel(f.anomalies)


# ----------------------------------------------------------------- monitoring


def _watched(f: Fleet) -> dict[str, DataFrame]:
    return {**_bronze(f), "silver_solar": f.silver_solar}


@query
def freshness(f: Fleet) -> DataFrame:
    return monitoring.freshness(_watched(f), AS_OF)


@query
def volume_24h(f: Fleet) -> DataFrame:
    return monitoring.volume(_watched(f), AS_OF)


@query
def panel_health(f: Fleet) -> DataFrame:
    return monitoring.panel_health(f.readings, AS_OF)


@query
def quality_7d(f: Fleet) -> DataFrame:
    return monitoring.quality_by_day(f.daily_panel, AS_OF)


@query
def pipeline_lag(f: Fleet) -> DataFrame:
    return monitoring.pipeline_lag(f.readings, f.silver_solar, f.daily_panel, AS_OF)


@query
def health_score(f: Fleet) -> DataFrame:
    return monitoring.health_score(f.readings, f.anomalies, f.daily_panel, AS_OF)


@query
def health_score_deductions(f: Fleet) -> DataFrame:
    # written gold tables, as a deployment has them: each is computed once, however often the report reads it
    daily, anomalies = materialise(f.daily_panel), materialise(f.anomalies)
    watched = {**_bronze(f), **_silver(f), "gold_daily_panel": daily}
    return monitoring.health_score_deductions(f.readings, anomalies, daily, watched, AS_OF)


@query
def alert_decision(f: Fleet) -> DataFrame:
    return monitoring.alert_decision(f.readings, f.anomalies, f.daily_panel, AS_OF)


@query
def ingest_recency(f: Fleet) -> DataFrame:
    return monitoring.ingest_recency(_bronze(f), AS_OF)


@query
def ingest_alive(f: Fleet) -> DataFrame:
    return monitoring.ingest_alive(_bronze(f), AS_OF)


@query
def live_dashboard(f: Fleet) -> DataFrame:
    return monitoring.live_numbers(f.readings, AS_OF)


@query
def live_daily_summary(f: Fleet) -> DataFrame:
    return monitoring.daily_summary(f.readings, AS_OF)


@query
def live_series(f: Fleet) -> DataFrame:
    return monitoring.recent_series(f.readings, AS_OF)


@query
def latest_readings(f: Fleet) -> DataFrame:
    return monitoring.latest_readings(f.readings, AS_OF)


# -------------------------------------------------------- climate, production


def _rounded(df: DataFrame, scale: int = 6) -> DataFrame:
    """Doubles from sums, deviations or trigonometry differ in the last digits between engines."""
    return df.selectExpr(
        *(
            f"round(`{field.name}`, {scale}) AS `{field.name}`"
            if isinstance(field.dataType, T.DoubleType)
            else f"`{field.name}`"
            for field in df.schema.fields
        )
    )


@query
def climate_summary(f: Fleet) -> DataFrame:
    return _rounded(climate.variable_summary(f.site_weather))


@query
def climate_from_days(f: Fleet) -> DataFrame:
    """Exact moments and sketched quantiles from states per day; whether each quantile keeps its rank error."""
    weather = f.site_weather
    states = materialise(daystates.variable_states(weather, "city", F.to_date("date")), "climate-days")
    found = materialise(daystates.state_summary(daystates.merged_days(states, "city")), "climate-merged")
    values = climate.long_form(weather, "city").where("value IS NOT NULL AND NOT isnan(value)")
    shares = join_null_safe(values, found.select("city", "variable", "p10", "p50", "p90"), ["city", "variable"])
    kept = []
    for p in (10, 50, 90):
        below, upto = (F.count_if(F.col("value") < F.col(f"p{p}")), F.count_if(F.col("value") <= F.col(f"p{p}")))
        n, error = F.count(F.lit(1)), daystates.RANK_ERROR
        kept.append(((below <= n * (p / 100 + error)) & (upto >= n * (p / 100 - error))).alias(f"p{p}_within"))
    ranks = shares.groupBy("city", "variable").agg(*kept)
    joined = join_null_safe(found.drop("p10", "p50", "p90"), ranks, ["city", "variable"])
    return _rounded(joined)


@query
def climate_percentiles(f: Fleet) -> DataFrame:
    return _rounded(climate.variable_percentiles(f.site_weather))


@query
def band_histogram(f: Fleet) -> DataFrame:
    return climate.band_histogram(f.site_weather)


@query
def band_matches(f: Fleet) -> DataFrame:
    return climate.band_matches(
        f.site_weather.select("id", "city", "uv_index"), "uv_index", C.UV_BANDS
    )


def _observed_bands(f: Fleet) -> DataFrame:
    """Per city, day and hour the range of its temperatures; open below at midnight, above before it."""
    hours = f.weather.withColumns({"day": F.to_date("timestamp"), "hour": F.hour("timestamp")})
    ranges = hours.groupBy("city", "day", "hour").agg(
        F.min("temperature").cast("double").alias("low"), F.max("temperature").cast("double").alias("high")
    )
    return ranges.selectExpr(
        "city",
        "concat(day, ' ', lpad(hour, 2, '0')) AS band",
        "CASE WHEN hour > 0 THEN low END AS band_min",
        "CASE WHEN hour < 23 THEN high END AS band_max",
    )


@query
def band_table_counts(f: Fleet) -> DataFrame:
    """Rows of each city in every band of a table with thousands of overlapping bands."""
    return bands.band_counts(f.weather, _observed_bands(f), ["city"], "temperature")


@query
def band_table_matches(f: Fleet) -> DataFrame:
    """Per weather row the bounded bands of its city that contain its temperature."""
    bounded = _observed_bands(f).where("band_max - band_min BETWEEN 0 AND 5")
    rows = f.weather.select("id", "city", "temperature")
    held = bands.rows_in_bands(rows, bounded, ["city"], "temperature", ["id"])
    return held.groupBy("id").agg(
        F.count(F.lit(1)).alias("bands"), F.min("band").alias("first_band"), F.max("band").alias("last_band")
    )


@query
def predicate_share(f: Fleet) -> DataFrame:
    return climate.predicate_shares(f.site_weather)


@query
def daily_extremes(f: Fleet) -> DataFrame:
    return _rounded(climate.daily_extremes(climate.daily_totals(f.site_weather)))


@query
def daily_cloud_extremes(f: Fleet) -> DataFrame:
    daily = climate.daily_totals(f.site_weather, "cloudcover", mean=True)
    return _rounded(climate.daily_extremes(daily))


@query
def hour_profile(f: Fleet) -> DataFrame:
    return climate.hour_profile(f.site_weather, "solar_potential")


@query
def hour_extremes(f: Fleet) -> DataFrame:
    return climate.hour_extremes(f.site_weather, "solar_potential")


@query
def worst_day_conditions(f: Fleet) -> DataFrame:
    return climate.worst_conditions(f.site_weather)


@query
def battery_sizing(f: Fleet) -> DataFrame:
    return _rounded(climate.battery_sizing(climate.daily_totals(f.site_weather)))


@query
def simple_production(f: Fleet) -> DataFrame:
    produced = pv.simple_production(f.site_weather)
    return _rounded(produced.select("id", "city", "observation_time", "hourly_kwh"))


# coordinates of the three cities of the weather view
CITIES = (
    C.Site(),
    C.Site(city="Milan", latitude=45.4642, longitude=9.19, tilt_deg=30.0),
    C.Site(city="Rome", latitude=41.9028, longitude=12.4964, azimuth_from_south_deg=15.0),
)


def _yields(f: Fleet) -> DataFrame:
    """The physical model over all weather rows; wall clock is UTC + 1."""
    sites = f.spark.createDataFrame(
        [tuple(getattr(s, n) for n in ("city", *pv.SITE_COLUMNS)) for s in CITIES],
        ["city", *pv.SITE_COLUMNS],
    )
    local = f.weather.selectExpr(
        "id",
        "city",
        "timestamp + INTERVAL 1 HOUR AS ts_local",
        "1D AS utc_offset_hours",
        "CAST(temperature AS DOUBLE) AS temperature",
        "humidity",
        "CAST(wind_speed AS DOUBLE) AS wind_speed",
        "least(cloud_cover, 100) AS cloudcover",
    )
    return pv.pv_yield(pv.with_sites(local, sites))


@query
def pv_yield(f: Fleet) -> DataFrame:
    return _yields(f)


CHANGE_DAYS = tuple(
    date(2026, month, day) for month, day in ((3, 28), (3, 29), (3, 30), (10, 24), (10, 25), (10, 26))
)


@query
def zone_yield(f: Fleet) -> DataFrame:
    """The days around both clock changes under each city's mean weather, offsets from the zone's rules."""
    names = ("city", "timezone", *pv.SITE_COLUMNS)
    sites = f.spark.createDataFrame([tuple(getattr(s, n) for n in names) for s in CITIES], list(names))
    usual = f.weather.groupBy("city").agg(
        exact_mean(F.col("temperature")).alias("temperature"),
        exact_mean(F.col("humidity")).alias("humidity"),
        exact_mean(F.col("wind_speed")).alias("wind_speed"),
        exact_mean(F.least("cloud_cover", F.lit(100))).alias("cloudcover"),
    )
    hours = pv.wall_clock_hours(usual.join(sites, "city"), CHANGE_DAYS)
    offsets = hours.select("city", F.col("ts_local").alias("timestamp"), "utc_offset_hours")
    modelled = pv.pv_yield(hours).select(
        "city", "timestamp", "solar_elevation_deg", "solar_azimuth_deg", "ghi_wm2", "production_kw"
    )
    return modelled.join(offsets, ["city", "timestamp"])


@query
def monthly_normals(f: Fleet) -> DataFrame:
    rows = f.weather.select("id", F.col("timestamp").alias("ts_local"))
    return _rounded(pv.monthly_normals(rows))


@query
def expected_vs_actual(f: Fleet) -> DataFrame:
    return pv.expected_and_actual(_yields(f), f.readings)


# ---------------------------------------------------------- energy, economics


@query
def load_profile(f: Fleet) -> DataFrame:
    return energy.load_profile(f.site_hours).select("site_id", "ts_local", "load_kwh")


@query
def energy_flows(f: Fleet) -> DataFrame:
    flows = energy.energy_flows(energy.load_profile(f.site_hours))
    return flows.select(
        "site_id",
        "ts_local",
        "load_kwh",
        "system_hourly_kwh",
        "self_consumed_kwh",
        "grid_export_kwh",
        "grid_import_kwh",
    )


@query
def energy_balance(f: Fleet) -> DataFrame:
    return _rounded(energy.energy_balance(energy.load_profile(f.site_hours)))


@query
def monthly_energy(f: Fleet) -> DataFrame:
    return energy.monthly_energy(energy.energy_flows(energy.load_profile(f.site_hours)))


@query
def month_extremes(f: Fleet) -> DataFrame:
    monthly = energy.monthly_energy(energy.energy_flows(energy.load_profile(f.site_hours)))
    return energy.month_extremes(monthly)


@query
def cash_flow(f: Fleet) -> DataFrame:
    return _rounded(feasibility.cash_flows(f.site_hours))


@query
def scenario_metrics(f: Fleet) -> DataFrame:
    return _rounded(feasibility.metrics(f.site_hours))


@query
def size_sensitivity(f: Fleet) -> DataFrame:
    return economics.size_sensitivity(feasibility.metrics(f.site_hours))


@query
def optimal_size(f: Fleet) -> DataFrame:
    return _rounded(economics.optimal_size(feasibility.metrics(f.site_hours)))


@query
def recommendation_score(f: Fleet) -> DataFrame:
    scored = economics.recommendation_score(feasibility.metrics(f.site_hours))
    return scored.select(
        "site_id", "panel_size_kw", "score", "verdict", "strengths", "concerns"
    )


@query
def scenario_ranking(f: Fleet) -> DataFrame:
    return _rounded(feasibility.ranked_choices(f.site_hours))


@query
def panel_count(f: Fleet) -> DataFrame:
    sized = economics.optimal_size(feasibility.metrics(f.site_hours))
    return sized.select(
        "site_id",
        "panel_size_kw",
        energy.panel_count(F.col("panel_size_kw")).alias("panels"),
        F.lit(energy.roof_limit()).alias("roof_limit"),
    )


@query
def chart_series(f: Fleet) -> DataFrame:
    return _rounded(feasibility.trajectories(f.site_hours), 4)


@query
def season_chart(f: Fleet) -> DataFrame:
    monthly = energy.monthly_energy(energy.energy_flows(energy.load_profile(f.site_hours)))
    return _rounded(economics.season_series(monthly))


def _period(f: Fleet) -> DataFrame:
    return economics.period_totals(pv.simple_production(f.site_weather))


def _shares(f: Fleet) -> DataFrame:
    return economics.self_consumption_scenarios(_period(f))


def _seasonal(f: Fleet) -> DataFrame:
    return economics.seasonal_cash_flow(economics.best_share(_shares(f)))


@query
def self_consumption_scenarios(f: Fleet) -> DataFrame:
    return _rounded(_shares(f))


@query
def best_self_consumption(f: Fleet) -> DataFrame:
    return _rounded(economics.best_share(_shares(f)))


@query
def seasonal_cash_flow(f: Fleet) -> DataFrame:
    return _rounded(_seasonal(f), 4)


@query
def seasonal_metrics(f: Fleet) -> DataFrame:
    return _rounded(economics.seasonal_metrics(_seasonal(f)), 4)


@query
def solar_vs_grid(f: Fleet) -> DataFrame:
    return _rounded(economics.solar_vs_grid(economics.seasonal_metrics(_seasonal(f))), 4)


@query
def simple_sensitivity(f: Fleet) -> DataFrame:
    return economics.simple_sensitivity(economics.best_share(_shares(f)))


@query
def simple_score(f: Fleet) -> DataFrame:
    metrics = economics.seasonal_metrics(_seasonal(f))
    return economics.simple_score(metrics, economics.solar_vs_grid(metrics)).select(
        "site_id", "payback_years", "score", "verdict", "strengths", "concerns"
    )


# ------------------------------------------------------------ sources and sinks


@query
def csv_weather_scan(f: Fleet) -> DataFrame:
    """Site weather through a CSV file and back."""
    folder = work_folder(f.spark, "csv")
    names = SITE_WEATHER_CSV.names
    tables.write_csv(f.site_weather.selectExpr(*(_csv_column(n) for n in names)), folder)
    return _rounded(tables.read_site_weather_csv(f.spark, folder))


def _csv_column(name: str) -> str:
    return f"CAST({name} AS {SITE_WEATHER_CSV[name].dataType.simpleString()}) AS {name}"


@query
def json_export(f: Fleet) -> DataFrame:
    """Gold days through JSON lines and back."""
    folder = work_folder(f.spark, "json")
    days = f.daily_panel
    tables.write_json(days, folder)
    return f.spark.read.schema(days.schema).json(folder)


@query
def refreshed_days(f: Fleet) -> DataFrame:
    """Rows per day of a table that was written, appended to, and refreshed for its last two days."""
    location = f"{work_folder(f.spark, 'sinks')}/silver_solar"
    tables.refresh_table(f.silver_solar, location, ts="timestamp")
    tables.append_table(f.silver_solar, location)
    days = [AS_OF.date() - timedelta(days=1), AS_OF.date()]
    again = f.silver_solar.where(F.to_date("timestamp").isin(*days))
    tables.refresh_days(again, location, days=days)
    stored = tables.read_table(f.spark, location)
    return stored.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))


@query
def silver_audit(f: Fleet) -> DataFrame:
    """The audit columns of the silver tables."""
    solar = silver_ops.build_silver_solar(f.readings, AS_OF)
    weather = silver_ops.build_silver_weather(f.weather, AS_OF)
    parts = [
        df.groupBy(F.col("silver_ingestion_time").alias("stamped")).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in (("silver_solar", solar), ("silver_weather", weather))
    ]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------ ingestion


@query
def weather_payload_flatten(f: Fleet) -> DataFrame:
    return decode.flatten_weather(messages.weather_payloads(f.weather), datetime(2024, 1, 31, 10))


def _ingested(f: Fleet, dedup: str) -> str:
    """Run the whole stream over all messages of the folder; returns the sink folder."""
    base = work_folder(f.spark, "ingest")
    lines = messages.reading_messages(f.readings)
    lines.write.text(f"{base}/incoming")
    stream = ingest.file_messages(f.spark, f"{base}/incoming")
    running = ingest.start_ingest(
        stream,
        f"{base}/sink",
        f"{base}/checkpoint",
        dedup=dedup,
        state_partitions=f.spark.sparkContext.defaultParallelism,
    )
    running.awaitTermination()
    return f"{base}/sink"


def _readings_of(f: Fleet, dedup: str) -> DataFrame:
    stored = ingest.read_readings(f.spark, _ingested(f, dedup))
    # the moment of ingestion is the clock's
    return stored.drop(ingest.BATCH_COLUMN, "event_date", ingest.INGESTED)


@query
def stream_ingest(f: Fleet) -> DataFrame:
    return _readings_of(f, "sink")


@query
def stream_ingest_state(f: Fleet) -> DataFrame:
    return _readings_of(f, "state")


@query
def stream_ingest_ids(f: Fleet) -> DataFrame:
    return _readings_of(f, "ids")


@query
def stream_rejects(f: Fleet) -> DataFrame:
    rejects = ingest.read_rejects(f.spark, _ingested(f, "sink"))
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("count"))


@query
def ingest_counters(f: Fleet) -> DataFrame:
    return ingest.ingest_counters(f.spark, _ingested(f, "sink"))


@query
def stream_hourly_rollup(f: Fleet) -> DataFrame:
    """The live roll-up run to its end."""
    base = work_folder(f.spark, "rollup")
    arriving = (
        f.spark.readStream.schema(f.events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(f.folder)
    )
    stream = silver_ops.build_silver_solar(readings_view(arriving))
    stream = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rollup.start_rollup(stream, f"{base}/hours", f"{base}/checkpoint").awaitTermination()
    return rollup.hourly_totals(f.spark, f"{base}/hours")


@query
def live_windows(f: Fleet) -> DataFrame:
    """The dashboard's sliding windows over the whole table."""
    readings = f.silver_solar.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return rollup.live_windows(readings)


@query
def live_windows_stream(f: Fleet) -> DataFrame:
    """The same windows as a stream run to its end; those that the watermark has not closed are not there."""
    base = work_folder(f.spark, "windows")
    arriving = (
        f.spark.readStream.schema(f.events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(f.folder)
    )
    stream = silver_ops.build_silver_solar(readings_view(arriving))
    stream = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rollup.start_closed_windows(stream, f"{base}/windows", f"{base}/checkpoint").awaitTermination()
    return f.spark.read.parquet(f"{base}/windows")
