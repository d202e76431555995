"""Climate statistics of site weather: summaries, bands, days, hours, battery sizing.

Input: rows of :data:`sunledger.schemas.SITE_WEATHER_CSV`, any number of
sites; ``site`` names the key column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.functions.quantiles import exact_quantiles
from sunledger.functions.semantics import join_null_safe, share, stable_mean, stable_sum

VARIABLES = ("temperature", "cloudcover", "uv_index", "wind_speed", "solar_angle", "solar_potential")
BANDS = {"cloudcover": C.CLOUD_BANDS, "uv_index": C.UV_BANDS, "wind_speed": C.WIND_BANDS}


def long_form(df: DataFrame, site: str, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """One row per measured value: (site, variable, value)."""
    pairs = ", ".join(f"'{name}', CAST({name} AS DOUBLE)" for name in variables)
    return df.selectExpr(site, f"stack({len(variables)}, {pairs}) AS (variable, value)")


def variable_summary(
    df: DataFrame, site: str = "city", variables: Sequence[str] = VARIABLES
) -> DataFrame:
    """mean, min, max, sample deviation, sum and median of each variable per site."""
    values = long_form(df, site, variables)
    value = F.col("value")
    moments = values.groupBy(site, "variable").agg(
        stable_mean(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.stddev_samp(value).alias("std"),
        stable_sum(value).alias("sum"),
    )
    medians = exact_quantiles(values, [site, "variable"], value, [0.5]).select(
        site, "variable", F.col("quantiles")[0].alias("median")
    )
    return join_null_safe(moments, medians, [site, "variable"], "left")


def variable_percentiles(
    df: DataFrame,
    site: str = "city",
    variables: Sequence[str] = VARIABLES,
    probs: Sequence[float] = C.REPORT_PERCENTILES,
) -> DataFrame:
    """Exact percentiles, one column per probability (p0, p10, ... p100)."""
    values = long_form(df, site, variables)
    found = exact_quantiles(values, [site, "variable"], F.col("value"), probs)
    return found.select(
        site,
        "variable",
        *(F.col("quantiles")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)),
    )


def approximate_percentiles(
    df: DataFrame,
    site: str = "city",
    variables: Sequence[str] = VARIABLES,
    probs: Sequence[float] = C.REPORT_PERCENTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """Percentiles from a mergeable sketch: one pass, rank error 1/``accuracy``."""
    return (
        long_form(df, site, variables)
        .groupBy(site, "variable")
        .agg(F.percentile_approx("value", list(probs), accuracy).alias("percentiles"))
    )


def band_matches(df: DataFrame, value: str, bands: Sequence[tuple]) -> DataFrame:
    """Each row once per band that contains its value, both ends inclusive.

    A value on a shared edge belongs to both bands, one in a gap to none.  The
    bands travel as an array literal, so this range join needs no join.
    """
    literal = F.array(
        *(
            F.struct(
                F.lit(name).alias("band"),
                F.lit(float(low)).alias("band_min"),
                F.lit(float(high)).alias("band_max"),
                F.lit(text).alias("description"),
            )
            for name, low, high, text in bands
        )
    )
    hits = F.filter(
        literal, lambda b: F.col(value).cast("double").between(b["band_min"], b["band_max"])
    )
    return df.withColumn("hit", F.explode(hits)).select(*df.columns, "hit.*")


def band_histogram(df: DataFrame, site: str = "city", bands: dict = BANDS) -> DataFrame:
    """Rows and share of rows per band: one conditional count per band, a single pass."""
    flat = [(variable, *band) for variable, rows in bands.items() for band in rows]
    counted = df.groupBy(site).agg(
        F.count(F.lit(1)).alias("total"),
        *(
            F.expr(f"count_if({variable} BETWEEN {low} AND {high})").alias(f"b{i}")
            for i, (variable, _, low, high, _) in enumerate(flat)
        ),
    )
    rows = ", ".join(
        f"'{variable}', '{name}', CAST({low} AS DOUBLE), CAST({high} AS DOUBLE), '{text}', b{i}"
        for i, (variable, name, low, high, text) in enumerate(flat)
    )
    unpivot = f"stack({len(flat)}, {rows}) AS (variable, band, band_min, band_max, description, count)"
    return counted.selectExpr(site, "total", unpivot).select(
        site,
        "variable",
        "band",
        "band_min",
        "band_max",
        "description",
        "count",
        (share(F.col("count"), F.col("total")) * 100).alias("percentage"),
    )


def predicate_shares(df: DataFrame, site: str = "city") -> DataFrame:
    """Clear, cloudy, sunny-index and zero-potential hours with their share of all hours."""
    predicates = {
        "clear": "cloudcover <= 20",
        "cloudy": "cloudcover > 60",
        "uv_positive": "uv_index > 0",
        "zero_potential": "solar_potential = 0",
    }
    total = F.col("total_hours")
    return (
        df.groupBy(site)
        .agg(
            F.count(F.lit(1)).alias("total_hours"),
            *(F.expr(f"count_if({p})").alias(f"{n}_hours") for n, p in predicates.items()),
        )
        .withColumn("uv_zero_hours", total - F.col("uv_positive_hours"))
        .withColumns(
            {
                f"{name}_pct": share(F.col(f"{name}_hours"), total) * 100
                for name in (*predicates, "uv_zero")
            }
        )
    )


def daily_totals(
    df: DataFrame, value: str = "solar_potential", site: str = "city", mean: bool = False
) -> DataFrame:
    """(site, date, value): sum, or mean, of each day."""
    measured = stable_mean(F.col(value)) if mean else stable_sum(F.col(value))
    return df.groupBy(site, "date").agg(measured.alias("value"))


def _first_best(what: str) -> Column:
    """``what`` of the day with the highest value; the earliest of equal days."""
    return F.max_by(F.col(what), F.struct(F.col("value"), -F.unix_date("date")))


def _first_worst(what: str) -> Column:
    return F.min_by(F.col(what), F.struct(F.col("value"), F.unix_date("date")))


def daily_extremes(daily: DataFrame, site: str = "city") -> DataFrame:
    """Mean day, best and worst day, and how far they are apart.

    The ratio is undefined when the worst day has nothing; then the best day is
    compared with the mean.
    """
    best, worst, mean = F.col("best_value"), F.col("worst_value"), F.col("mean_of_days")
    return (
        daily.groupBy(site)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.avg("value").alias("mean_of_days"),
            _first_best("date").alias("best_day"),
            F.max("value").alias("best_value"),
            _first_worst("date").alias("worst_day"),
            F.min("value").alias("worst_value"),
        )
        .withColumn("best_worst_ratio", F.when(worst > 0, best / worst))
        .withColumn("best_mean_ratio", F.when((worst <= 0) & (mean > 0), best / mean))
    )


def hour_profile(df: DataFrame, value: str, site: str = "city") -> DataFrame:
    """Mean value by hour of day."""
    return df.groupBy(site, "hour").agg(stable_mean(F.col(value)).alias("mean_value"))


def hour_extremes(df: DataFrame, value: str, site: str = "city") -> DataFrame:
    """Peak and lowest hour (the first of equal ones) and the productive hours per day."""
    # one row per site, date and hour first: days and hours come from the same pass
    cells = df.groupBy(site, "date", "hour").agg(
        F.sum(F.col(value).cast("decimal(32,16)")).alias("total"),
        F.count(value).alias("n"),
        F.count_if(F.col(value) > 0).alias("productive"),
    )
    first_of_day = Window.partitionBy(site, "date").orderBy("hour")  # 24 rows at most
    cells = cells.withColumn("day", F.when(F.row_number().over(first_of_day) == 1, 1).otherwise(0))
    by_hour = cells.groupBy(site, "hour").agg(
        (F.sum("total").cast("double") / F.nullif(F.sum("n"), F.lit(0))).alias("mean_value"),
        F.sum("productive").alias("productive"),
        F.sum("day").alias("days"),
    )
    return (
        by_hour.groupBy(site)
        .agg(
            F.max_by("hour", F.struct("mean_value", -F.col("hour"))).alias("peak_hour"),
            F.max("mean_value").alias("peak_value"),
            F.min_by("hour", F.struct("mean_value", "hour")).alias("lowest_hour"),
            F.min("mean_value").alias("lowest_value"),
            F.sum("productive").alias("productive_hours"),
            F.sum("days").alias("days"),
        )
        .withColumn("productive_hours_per_day", F.col("productive_hours") / F.col("days"))
        .drop("days")
    )


def worst_conditions(df: DataFrame, site: str = "city") -> DataFrame:
    """The hour with the least potential (the earliest one) and the conditions of the worst day."""
    hour = F.struct(
        "solar_potential",
        "observation_time",
        "date",
        "hour",
        "cloudcover",
        "temperature",
        "uv_index",
        "wind_speed",
    )
    days = df.groupBy(site, "date").agg(
        stable_sum(F.col("solar_potential")).alias("value"),
        stable_mean(F.col("cloudcover")).alias("cloud"),
        stable_mean(F.col("temperature")).alias("temp"),
        F.count_if(F.col("solar_potential") > 0).alias("productive"),
        F.min(hour).alias("worst"),
    )
    return (
        days.groupBy(site)
        .agg(
            F.min("worst").alias("h"),
            _first_worst("date").alias("worst_day"),
            F.min("value").alias("worst_day_potential"),
            _first_worst("cloud").alias("worst_day_cloudcover"),
            _first_worst("temp").alias("worst_day_temperature"),
            _first_worst("productive").alias("worst_day_productive_hours"),
        )
        .select(
            site,
            F.col("h.date").alias("worst_hour_date"),
            F.col("h.hour").alias("worst_hour"),
            F.col("h.solar_potential").alias("worst_hour_potential"),
            F.col("h.cloudcover").alias("worst_hour_cloudcover"),
            F.col("h.temperature").alias("worst_hour_temperature"),
            F.col("h.uv_index").alias("worst_hour_uv_index"),
            F.col("h.wind_speed").alias("worst_hour_wind_speed"),
            "worst_day",
            "worst_day_potential",
            "worst_day_cloudcover",
            "worst_day_temperature",
            "worst_day_productive_hours",
        )
    )


def battery_sizing(
    daily: DataFrame,
    site: str = "city",
    battery: C.Battery = C.Battery(),
    annual_consumption: float = C.Economics().household_consumption,
) -> DataFrame:
    """Battery that carries each site over its worst day.

    The charge comes from up to three days before the worst one (by position:
    days without data do not count).  If the worst day is the first, the mean
    day is the reference.  A site that never produces gets no recommendation.
    The windows run over the days of a site, not over its readings.
    """
    in_order = Window.partitionBy(site).orderBy("date")
    before = in_order.rowsBetween(-battery.look_back_days, -1)
    per_day = annual_consumption / 365
    days = daily.withColumns(
        {
            "position": F.row_number().over(in_order),
            "before_days": F.count("value").over(before),
            "before_total": F.coalesce(F.sum("value").over(before), F.lit(0.0)),
        }
    )
    worst = days.groupBy(site).agg(
        F.avg("value").alias("avg_daily"),
        _first_worst("date").alias("worst_day"),
        F.min("value").alias("worst_day_kwh"),
        _first_worst("position").alias("position"),
        _first_worst("before_days").alias("days_before"),
        _first_worst("before_total").alias("total_before"),
    )
    first = F.col("position") == 1
    needed = F.greatest(F.lit(0.0), F.lit(per_day) - F.col("worst_day_kwh"))
    stored = F.col("total_before") * battery.efficiency
    enough = F.col("stored_energy") >= F.col("energy_needed")
    margin = F.when(enough, battery.margin_if_enough).otherwise(battery.margin_if_short)
    capacity = F.when(
        first, F.col("avg_daily") * battery.min_days_autonomy * battery.margin_if_short
    ).otherwise(
        F.greatest(F.col("energy_needed") * margin, F.lit(battery.min_recommended_kwh))
    )
    return (
        worst.where(F.col("avg_daily") > 0)
        .withColumn("energy_needed", F.when(~first, needed))
        .withColumn("stored_energy", F.when(~first, stored))
        .withColumn("sufficient", enough)
        .withColumn("recommended_kwh", capacity)
        .withColumn("usable_kwh", F.col("recommended_kwh") * battery.efficiency)
        .withColumn("estimated_cost", F.col("recommended_kwh") * battery.cost_per_kwh)
        .withColumn("lifetime_years", F.lit(battery.lifetime_years))
    )
