"""Household load, hourly energy flows, and yearly balances for every size and year."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.functions.semantics import fixed_point_sum, share

SITE, TS = "site_id", "ts_local"


def load_weight(ts: str = TS, shape: C.LoadProfile = C.LoadProfile()) -> Column:
    """Relative demand of an hour: base, three bumps, weekend midday, winter swing."""

    def bump(height: float, centre: float, width: float) -> str:
        return f"{height}D * exp(-pow(hour({ts}) - {centre}D, 2) / {2 * width**2}D)"

    bumps = " + ".join(bump(*b) for b in (shape.morning, shape.evening, shape.midday))
    first, last = shape.weekend_hours
    weekend = (
        f"CASE WHEN weekday({ts}) >= 5 AND hour({ts}) BETWEEN {first} AND {last} "
        f"THEN {shape.weekend_bias}D ELSE 0D END"
    )
    winter = (
        f"1D + {shape.winter_bias}D * cos(2 * pi() * (dayofyear({ts}) - {shape.winter_peak_day}) / 365)"
    )
    return F.expr(f"({shape.base_kw}D + {bumps} + {weekend}) * ({winter})")


def load_profile(
    hours: DataFrame,
    annual_consumption: float = C.Economics().household_consumption,
    shape: C.LoadProfile = C.LoadProfile(),
) -> DataFrame:
    """Adds ``load_kwh``: the demand shape scaled to the annual consumption per site and year.

    ``hours`` has one row per site and hour, so a window holds a year of hours
    at most, and the hours are read once.
    """
    weighted = hours.withColumns({"year": F.year(TS), "weight": load_weight(TS, shape)})
    of_year = Window.partitionBy(SITE, "year").orderBy(TS).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    load = F.round(F.col("weight") * annual_consumption / F.sum("weight").over(of_year), 6)
    return weighted.withColumn("load_kwh", load).select(*hours.columns, "load_kwh")


def energy_flows(
    hours: DataFrame, size_kw: float = C.Panel().power_kw, base_kw: float = C.Panel().power_kw
) -> DataFrame:
    """Adds what a system of ``size_kw`` produces, covers, exports and leaves to import.

    All four are NULL for an hour without a known production.
    """
    produced, load = F.col("hourly_production_kwh") * (size_kw / base_kw), F.col("load_kwh")


    def known(flow: Column) -> Column:
        return F.when(F.col("hourly_production_kwh").isNotNull(), F.round(flow, 6))

    return hours.withColumns(
        {
            "system_hourly_kwh": known(produced),
            "self_consumed_kwh": known(F.least(produced, load)),
            "grid_export_kwh": known(F.greatest(F.lit(0.0), produced - load)),
            "grid_import_kwh": known(F.greatest(F.lit(0.0), load - produced)),
        }
    )


def yearly_balances(
    hours: DataFrame,
    sizes: Sequence[float] = C.CANDIDATE_SIZES_KW,
    years: int = C.Economics().analysis_years,
    degradation: float = C.Losses().degradation_rate,
    base_kw: float = C.Panel().power_kw,
) -> DataFrame:
    """Energy balance of every site, size and year 1..``years`` in one pass over the hours.

    In year ``j + 1`` an hour produces ``p * s * d**j`` with ``s`` the size and
    ``d`` the degradation.  It only shrinks, so each hour has a first year from
    which production stays below the load: before it the load is covered, from
    it on all production is used.  The hours are added up by that year, and the
    balance of any year follows from these few sums: ``len(sizes)`` rows per
    hour instead of ``len(sizes) * years``.  Hours without a known production
    count in the load only.  The sums are fixed-point, hence the same for every
    partitioning.
    """
    keep = 1.0 - degradation
    produced = F.col("hourly_production_kwh") * F.col("size_kw") / F.lit(float(base_kw))
    load = F.col("load_kwh")
    if degradation > 0:
        later = F.ceil(F.log(load / F.col("produced")) / F.lit(math.log(keep)))
        first_below = F.when(load > 0, F.least(later, F.lit(years))).otherwise(F.lit(years))
    else:
        first_below = F.lit(years)
    cells = (
        hours.select(SITE, "hourly_production_kwh", "load_kwh")
        .withColumn("size_kw", F.explode(F.array(*(F.lit(float(s)) for s in sizes))))
        .withColumn("produced", produced)
        .withColumn(
            "below_from",
            F.when(F.col("produced").isNull() | (F.col("produced") <= load), F.lit(0))
            .otherwise(first_below)
            .cast("int"),
        )
        .groupBy(SITE, "size_kw", "below_from")
        .agg(
            _total(F.col("produced")).alias("produced"),
            _total(load).alias("load"),
            _total(F.when(F.col("produced").isNotNull(), load)).alias("known_load"),
        )
    )
    # at most (years + 1) cells per site and size from here on
    age = F.col("year") - 1
    faded = F.col("produced") * F.pow(F.lit(keep), age)
    used = F.when(F.col("below_from") <= age, faded).otherwise(F.col("known_load"))
    balances = (
        cells.withColumn("year", F.explode(F.sequence(F.lit(1), F.lit(years))))
        .groupBy(SITE, "size_kw", "year")
        .agg(
            _total(faded).alias("annual_production_kwh"),
            _total(used).alias("annual_self_consumed_kwh"),
            _total(F.col("load")).alias("annual_load_kwh"),
            _total(F.col("known_load")).alias("known_load"),
        )
    )
    self_used = F.col("annual_self_consumed_kwh")
    return balances.withColumns(
        {
            "annual_exported_kwh": F.col("annual_production_kwh") - self_used,
            "annual_imported_kwh": F.col("known_load") - self_used,
        }
    ).drop("known_load")


def _total(value: Column) -> Column:
    return F.coalesce(fixed_point_sum(value), F.lit(0.0))


def balance_percentages() -> dict[str, Column]:
    """Self-consumption, demand coverage and production coverage; 0 without a denominator."""

    def pct(part: str, whole: str) -> Column:
        ratio = share(F.col(f"annual_{part}_kwh"), F.col(f"annual_{whole}_kwh"))
        return F.coalesce(ratio * 100, F.lit(0.0))

    return {
        "self_consumption_pct": pct("self_consumed", "production"),
        "demand_coverage_pct": pct("self_consumed", "load"),
        "production_coverage_pct": pct("production", "load"),
    }


def energy_balance(
    hours: DataFrame,
    sizes: Sequence[float] = C.CANDIDATE_SIZES_KW,
    base_kw: float = C.Panel().power_kw,
) -> DataFrame:
    """First-year totals and percentages per site and size."""
    first_year = yearly_balances(hours, sizes, years=1, degradation=0.0, base_kw=base_kw)
    return first_year.drop("year").withColumns(balance_percentages())


def monthly_energy(flows: DataFrame) -> DataFrame:
    """Mean weather and energy sums of each calendar month."""

    def total(column: str) -> Column:
        return F.round(F.sum(column), 1)

    return flows.groupBy(SITE, F.month(TS).alias("month")).agg(
        F.round(F.avg("temperature"), 2).alias("avg_temperature_c"),
        F.round(F.avg("cloudcover"), 1).alias("avg_cloud_cover_pct"),
        F.round(F.avg("ghi_wm2"), 1).alias("avg_ghi_wm2"),
        total("system_hourly_kwh").alias("production_kwh"),
        total("load_kwh").alias("load_kwh"),
        total("self_consumed_kwh").alias("self_consumed_kwh"),
        total("grid_export_kwh").alias("grid_export_kwh"),
        total("grid_import_kwh").alias("grid_import_kwh"),
    )


def month_extremes(monthly: DataFrame) -> DataFrame:
    """Best and weakest month of each site; the earlier of equal months."""
    produced, month = F.col("production_kwh"), F.col("month")
    return monthly.groupBy(SITE).agg(
        F.max_by("month", F.struct(produced, -month)).alias("best_month"),
        F.max(produced).alias("best_month_kwh"),
        F.min_by("month", F.struct(produced, month)).alias("weakest_month"),
        F.min(produced).alias("weakest_month_kwh"),
    )


def panel_count(size_kw: Column, panel: C.Panel = C.Panel()) -> Column:
    """Panels needed for a size: at least one, halves rounded up."""
    return F.greatest(F.lit(1), F.floor(size_kw / panel.kw_per_panel + 0.5)).cast("int")


def roof_limit(panel: C.Panel = C.Panel()) -> int:
    """Panels that fit on the available roof area."""
    return int(panel.roof_area_m2 // panel.area_m2)
