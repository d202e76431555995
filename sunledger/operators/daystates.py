"""Mergeable states per day: reports over months and years follow from them, a changed day changes only its own.

* Distinct panels add up exactly: panels have numbers, a day keeps bitmaps of the numbers it saw, and the
  bitmaps of several days are united.
* Sums and counts are exact decimals, so means and deviations of any set of days do not depend on the
  order in which days are put together.
* Quantiles come from KLL sketches; their rank error is bounded (:data:`RANK_ERROR`), the moments beside them are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.semantics import join_null_safe, percentage
from sunledger.operators.climate import VARIABLES
from sunledger.operators.silver import audit_column

DAY = "day"
SKETCH_SIZE = 800  # k of the KLL sketches
RANK_ERROR = 0.01  # of sketches of this size, on either side (99 % confidence: 0.0042)
_MEANS = {
    "avg_production_kw": ("production_kw", 8, 3),
    "avg_efficiency": ("efficiency_ratio", 12, 3),
    "avg_temperature": ("temperature_c", 5, 1),
}


# ------------------------------------------------------------------ panels and production


def panel_numbers(seen: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """panel_id and number of the panels in ``seen`` that ``known`` does not hold yet.

    Numbers are unique and dense within a task's share, which is what keeps bitmaps short; they are not
    one gapless sequence, so no single task has to deal them.
    """
    new = seen.select("panel_id").where("panel_id IS NOT NULL").distinct()
    base = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known.select("panel_id"), "panel_id", "left_anti")
        base = F.lit((known.agg(F.max("number")).first()[0] or 0) + 1).cast("long")
    return new.select("panel_id", (base + F.monotonically_increasing_id()).alias("number"))


def panel_bitmaps(silver_solar: DataFrame, numbers: DataFrame) -> DataFrame:
    """day, bucket, panels: the panels of each day as bitmaps of 32,768 numbers.

    A panel's readings of a day collapse to one row before the numbers are joined.
    """
    seen = silver_solar.select(F.to_date("timestamp").alias(DAY), "panel_id").where("panel_id IS NOT NULL").distinct()
    return (
        seen.join(numbers, "panel_id")
        .groupBy(DAY, F.expr("bitmap_bucket_number(number)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("panels"))
    )


def production_states(silver_solar: DataFrame) -> DataFrame:
    """One row per day: counts, exact sums and the peak."""
    measured = sorted({column for column, _, _ in _MEANS.values()})
    return silver_solar.groupBy(F.to_date("timestamp").alias(DAY)).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("is_valid")).alias("valid_readings"),
        F.max("production_kw").alias("peak_production_kw"),
        *[F.sum(c).cast("decimal(28,6)").alias(f"sum_{c}") for c in measured],
        *[F.count(c).alias(f"count_{c}") for c in measured],
    )


def months_of_days(production: DataFrame, bitmaps: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """gold_monthly_kpis from the states of its days."""
    month = [F.year(DAY).alias("year"), F.month(DAY).alias("month")]
    panels = (
        bitmaps.groupBy(*month, "bucket")
        .agg(F.expr("bitmap_count(bitmap_or_agg(panels))").alias("panels"))
        .groupBy("year", "month")
        .agg(F.sum("panels").alias("total_panels"))
    )

    def mean(column: str, precision: int, scale: int) -> Column:
        count = F.nullif(F.sum(f"count_{column}"), F.lit(0)).cast("decimal(16,0)")
        return (F.sum(f"sum_{column}").cast("decimal(28,6)") / count).cast(f"decimal({precision},{scale})")

    sums = production.groupBy(*month).agg(
        F.sum("sum_production_kw").cast("decimal(22,2)").alias("total_production_kwh"),
        F.max("peak_production_kw").alias("peak_production_kw"),
        *[mean(*how).alias(name) for name, how in _MEANS.items()],
        F.sum("valid_readings").alias("valid_readings"),
        F.sum("readings").alias("readings"),
    )
    joined = join_null_safe(sums, panels, ["year", "month"], "left")
    return joined.select(
        "year",
        "month",
        F.coalesce("total_panels", F.lit(0)).alias("total_panels"),
        "total_production_kwh",
        "avg_production_kw",
        "peak_production_kw",
        "avg_efficiency",
        "avg_temperature",
        "valid_readings",
        percentage(F.col("valid_readings"), F.col("readings")).alias("data_quality_pct"),
    ).withColumns(audit_column("gold_ingestion_time", as_of))


# ------------------------------------------------------------------ weather variables


def variable_states(df: DataFrame, site: str, day: Column, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """site, day, variable with count, exact sums of values and squares, extremes and a KLL sketch.

    NULL and NaN are no measurement; a day without one has no row.
    """
    values = _long(df, site, day, variables)
    value = F.col("value").cast("decimal(18,8)")
    return values.groupBy(site, DAY, "variable").agg(
        F.count("value").alias("n"),
        F.sum(value).alias("total"),
        F.sum((value * value).cast("decimal(38,16)")).alias("squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch"),
    )


def _long(df: DataFrame, site: str, day: Column, variables: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{name}', CAST({name} AS DOUBLE)" for name in variables)
    dated = df.withColumn(DAY, day)
    return dated.selectExpr(site, DAY, f"stack({len(variables)}, {pairs}) AS (variable, value)").where(
        "value IS NOT NULL AND NOT isnan(value)"
    )


def merged_days(states: DataFrame, site: str, keep: Sequence[str] = ()) -> DataFrame:
    """The states of several days put together, per site, variable and the columns ``keep``; again states."""
    return states.groupBy(site, "variable", *keep).agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.sum("squares").cast("decimal(38,16)").alias("squares"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"),
    )


def state_summary(states: DataFrame, probabilities: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """mean, sample deviation and sketched quantiles (p10, p50, ...) in place of the state columns."""
    n, total, squares = F.col("n").cast("double"), F.col("total").cast("double"), F.col("squares").cast("double")
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{round(p * 100)}") for p in probabilities]
    return states.select(
        "*", (total / n).alias("mean"), F.sqrt(F.try_divide(spread, n - 1)).alias("std"), *quantiles
    ).drop("total", "squares", "sketch")
