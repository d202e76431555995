"""Cash flow, scenario metrics, sizing and scores; all keyed by site.

Two families, kept apart on purpose because their conventions differ:
the hourly study (prices escalate from year 2) and the simple study that
starts from one measured period (prices escalate from year 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.functions.semantics import present
from sunledger.operators.energy import SITE, balance_percentages

# ---------------------------------------------------------------- hourly study


def cash_flow(
    balances: DataFrame,
    econ: C.Economics = C.Economics(),
    losses: C.Losses = C.Losses(),
) -> DataFrame:
    """Cash flow per site, size and year 0..n with running and discounted values.

    ``balances`` is :func:`sunledger.operators.energy.yearly_balances`.  Year 0
    is the installation.
    """
    year = F.col("year")
    price = F.pow(F.lit(1 + econ.annual_rate_increase), year - 1)
    exchanged = F.least("annual_exported_kwh", "annual_imported_kwh")
    earned = price * (
        F.col("annual_self_consumed_kwh") * econ.electricity_rate
        + F.col("annual_exported_kwh") * econ.sell_back_rate
        + exchanged * econ.incentive_rate
    )
    replaced = F.when(
        year == losses.inverter_replacement_year, losses.inverter_replacement_cost
    ).otherwise(0.0)
    cost = F.col("size_kw") * econ.installation_cost_per_kw
    energy = [name for name in balances.columns if name.startswith("annual_")]
    running = (
        Window.partitionBy(SITE, "size_kw")
        .orderBy("year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # the first year also yields the row of year 0, so the balances are read once
    years = F.when(year == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(year))
    return (
        balances.withColumn("year", F.explode(years))
        .withColumns({name: F.when(year > 0, F.col(name)) for name in energy})
        .withColumn(
            "cash_flow",
            F.when(year == 0, -cost).otherwise(earned - econ.annual_maintenance - replaced),
        )
        .withColumns(
            {
                "cumulative": F.sum("cash_flow").over(running),
                "discounted": F.col("cash_flow") / F.pow(F.lit(1 + econ.discount_rate), year),
            }
        )
    )


def scenario_metrics(flows: DataFrame, econ: C.Economics = C.Economics()) -> DataFrame:
    """Payback, 20-year ROI and profit, NPV, grid cost and break-even rate per scenario."""
    horizon = min(20, econ.analysis_years)
    year = F.col("year")

    def first_year(column: str) -> Column:
        return F.max(F.when(year == 1, F.col(column))).alias(column)

    growth = 1 + econ.annual_rate_increase
    price_sum = sum(growth**y for y in range(horizon))
    energy = [
        f"annual_{part}_kwh"
        for part in ("production", "self_consumed", "exported", "imported", "load")
    ]
    summed = flows.groupBy(SITE, F.col("size_kw").alias("panel_size_kw")).agg(
        (-F.max(F.when(year == 0, F.col("cash_flow")))).alias("installation_cost_euro"),
        *(first_year(column) for column in energy),
        F.min(F.when((F.col("cumulative") >= 0) & (year > 0), year)).alias("payback_years"),
        F.sum(F.when((year > 0) & (year <= horizon), F.col("cash_flow"))).alias(
            "total_benefit_20_years_euro"
        ),
        F.max(F.when(year == horizon, F.col("cumulative"))).alias("net_profit_20_years_euro"),
        F.sum("discounted").alias("npv_25_years_euro"),
    )
    cost, used = F.col("installation_cost_euro"), F.col("annual_self_consumed_kwh")
    payback = F.col("payback_years").cast("string")
    carried = (
        econ.annual_maintenance
        + cost / 20
        - F.col("annual_exported_kwh") * econ.sell_back_rate
    )
    return summed.withColumns(
        {
            **balance_percentages(),
            "payback_display": F.coalesce(
                F.concat(payback, F.lit(" years")), F.lit("No payback in analysis window")
            ),
            "roi_20_years": F.coalesce(
                F.try_divide(F.col("net_profit_20_years_euro"), cost) * 100, F.lit(0.0)
            ),
            "grid_cost_20_years_euro": F.col("annual_load_kwh")
            * econ.electricity_rate
            * price_sum,
            "net_benefit_vs_grid_20_years_euro": F.col("net_profit_20_years_euro"),
            "break_even_rate_euro_per_kwh": F.when(
                used > 0, F.greatest(F.lit(0.0), carried / F.greatest(used, F.lit(1e-6)))
            ).otherwise(F.lit(float("inf"))),
        }
    )


def size_sensitivity(metrics: DataFrame, *keep: str) -> DataFrame:
    """The rounded comparison table of all sizes; ``keep`` names columns to pass on."""
    return metrics.select(
        SITE,
        *keep,
        "panel_size_kw",
        F.bround("annual_production_kwh", 1).alias("annual_production_kwh"),
        F.bround("self_consumption_pct", 1).alias("self_consumption_pct"),
        F.bround("demand_coverage_pct", 1).alias("demand_coverage_pct"),
        F.bround("installation_cost_euro", 0).alias("installation_cost_euro"),
        F.col("payback_display").alias("payback_years"),
        F.bround("npv_25_years_euro", 0).alias("npv_25_years_euro"),
    )


def optimal_size(metrics: DataFrame) -> DataFrame:
    """Best scenario per site: highest NPV, then shortest payback, then smallest size."""
    preference = F.struct(
        F.col("npv_25_years_euro"),
        F.coalesce(-F.col("payback_years"), F.lit(-999)),
        -F.col("panel_size_kw"),
    )
    others = [name for name in metrics.columns if name != SITE]
    best = metrics.groupBy(SITE).agg(F.max_by(F.struct(*others), preference).alias("best"))
    return best.select(SITE, "best.*")


# Steps of the two scores as (limit, points, text, is a strength)
PAYBACK_STEPS = (
    (7, 35, "Fast payback for a residential PV system", True),
    (10, 28, "Healthy payback within a typical asset horizon", True),
    (13, 18, "Acceptable payback", True),
    (16, 8, "Payback is on the long side", False),
)
NO_PAYBACK = "No payback within the analysis window"
ROI_STEPS = (
    (150, 25, "Strong 20-year ROI", True),
    (100, 20, "Solid 20-year ROI", True),
    (50, 14, "Positive long-term return", True),
)
LOW_ROI = (8, "ROI is positive but modest")
NEGATIVE_ROI = "Negative 20-year ROI"
COVERAGE_STEPS = (
    (70, 20, "Covers most of the household demand directly", True),
    (55, 16, "Good direct demand coverage", True),
    (40, 12, "Meaningful reduction in grid purchases", True),
    (25, 6, "Only partial demand coverage", False),
)
LOW_COVERAGE = "Low direct demand coverage"
SELF_STEPS = (
    (60, 20, "High self-consumption keeps exported energy limited", True),
    (45, 16, "Balanced self-consumption profile", True),
    (30, 10, "A notable share of production is exported", False),
)
LOW_SELF = "Low self-consumption reduces financial efficiency"
VERDICT_STEPS = ((80, "HIGHLY RECOMMENDED"), (60, "RECOMMENDED"), (40, "CONSIDER WITH CAUTION"))
VERDICT_REST = "NOT RECOMMENDED"

SIMPLE_PAYBACK_STEPS = (
    (6, 40, "EXCELLENT payback: Less than 6 years", True),
    (8, 35, "VERY GOOD payback: 6-8 years", True),
    (10, 30, "GOOD payback: 8-10 years", True),
    (12, 20, "ACCEPTABLE payback: 10-12 years", True),
    (15, 10, "MEDIOCRE payback: 12-15 years", True),
)
SIMPLE_PAYBACK_REST = "POOR payback: More than 15 years"
SIMPLE_ROI_STEPS = (
    (300, 30, "EXCELLENT ROI: >300%", True),
    (200, 25, "VERY GOOD ROI: 200-300%", True),
    (150, 20, "GOOD ROI: 150-200%", True),
    (100, 15, "ACCEPTABLE ROI: 100-150%", True),
    (50, 5, "LOW ROI: 50-100%", True),
)
SIMPLE_ROI_REST = "VERY LOW ROI: <50%"
# more than 120 % scores less than more than 80 %: oversizing is not rewarded
SIMPLE_COVERAGE_STEPS = (
    (120, 20, "EXCELLENT coverage: %.0f%% of consumption", True),
    (80, 30, "GREAT coverage: %.0f%% of consumption", True),
    (60, 25, "GOOD coverage: %.0f%% of consumption", True),
    (40, 15, "PARTIAL coverage: %.0f%% of consumption", True),
)
SIMPLE_COVERAGE_REST = "LOW coverage: %.0f%% of consumption"


def _step(conditions: Sequence[tuple[Column, int, Column, bool]]) -> Column:
    """First step that applies, as struct(points, text, strength)."""
    chain = None
    for applies, points, text, strength in conditions:
        found = F.struct(
            F.lit(points).alias("points"),
            text.alias("text"),
            F.lit(strength).alias("strength"),
        )
        chain = F.when(applies, found) if chain is None else chain.when(applies, found)
    return chain


def _steps(value: Column, steps: Sequence[tuple], compare, rest: Sequence[tuple]) -> Column:
    listed = [
        (compare(value, limit), points, F.lit(text), strength)
        for limit, points, text, strength in steps
    ]
    return _step([*listed, *((a, p, F.lit(t), False) for a, p, t in rest)])


def _scored(df: DataFrame, parts: Sequence[Column]) -> DataFrame:
    """Total of the parts, their texts split by kind, and the verdict."""
    verdict = F.when(F.lit(False), "")
    for limit, text in VERDICT_STEPS:
        verdict = verdict.when(F.col("score") >= limit, text)
    steps = F.col("steps")
    total = F.aggregate(steps, F.lit(0), lambda acc, step: acc + step["points"])
    return (
        df.withColumn("steps", F.array(*parts))
        .withColumn("score", total)
        .withColumns(
            {
                "verdict": verdict.otherwise(VERDICT_REST),
                "strengths": F.transform(F.filter(steps, lambda s: s["strength"]), lambda s: s["text"]),
                "concerns": F.transform(F.filter(steps, lambda s: ~s["strength"]), lambda s: s["text"]),
            }
        )
        .drop("steps")
    )


def _at_least(value: Column, limit: float) -> Column:
    return value >= limit


def _at_most(value: Column, limit: float) -> Column:
    return value <= limit


def _above(value: Column, limit: float) -> Column:
    return value > limit


def _below(value: Column, limit: float) -> Column:
    return value < limit


def recommendation_score(metrics: DataFrame) -> DataFrame:
    """Score 0..100, strengths, concerns and verdict of each scenario."""
    always = F.lit(True)
    roi = F.col("roi_20_years")
    return _scored(
        metrics,
        [
            _steps(F.col("payback_years"), PAYBACK_STEPS, _at_most, [(always, 0, NO_PAYBACK)]),
            _steps(roi, ROI_STEPS, _at_least, [(roi > 0, *LOW_ROI), (always, 0, NEGATIVE_ROI)]),
            _steps(
                F.col("demand_coverage_pct"), COVERAGE_STEPS, _at_least, [(always, 0, LOW_COVERAGE)]
            ),
            _steps(
                F.col("self_consumption_pct"), SELF_STEPS, _at_least, [(always, 0, LOW_SELF)]
            ),
        ],
    )


def trajectory_series(flows: DataFrame, optimal: DataFrame, current_kw: float) -> DataFrame:
    """Cumulative cash flow of the current and the optimal size, scaled to 0..1 together."""
    chosen = optimal.select(SITE, F.col("panel_size_kw").alias("optimal_kw"))
    size = F.col("size_kw")
    kinds = present(
        [
            F.when(size == current_kw, F.lit("current")),
            F.when(size == F.col("optimal_kw"), F.lit("optimal")),
        ]
    )
    shown = (
        flows.select(SITE, "size_kw", "year", "cumulative")
        .join(chosen, SITE)
        .withColumn("series", F.explode(kinds))
    )
    whole = Window.partitionBy(SITE)
    low, high = F.min("cumulative").over(whole), F.max("cumulative").over(whole)
    return shown.select(
        SITE,
        "series",
        "size_kw",
        "year",
        "cumulative",
        low.alias("low"),
        high.alias("high"),
    ).select(
        SITE,
        "series",
        "size_kw",
        "year",
        "cumulative",
        (
            (F.col("cumulative") - F.col("low"))
            / F.when(F.col("high") == F.col("low"), 1.0).otherwise(F.col("high") - F.col("low"))
        ).alias("scaled"),
    )


def season_series(monthly: DataFrame) -> DataFrame:
    """Production and load of each month in percent of the highest bar of the site."""
    whole = Window.partitionBy(SITE)
    top = F.max(F.greatest("production_kwh", "load_kwh")).over(whole)
    return monthly.select(
        SITE,
        "month",
        "production_kwh",
        "load_kwh",
        (F.try_divide(F.col("production_kwh"), top) * 100).alias("production_height_pct"),
        (F.try_divide(F.col("load_kwh"), top) * 100).alias("load_height_pct"),
    )


# ---------------------------------------------------------------- simple study


def period_totals(production: DataFrame, site: str = "city") -> DataFrame:
    """(site, total_kwh, days) of the measured period."""
    return production.groupBy(F.col(site).alias(SITE)).agg(
        F.sum("hourly_kwh").alias("total_kwh"), F.count_distinct("date").alias("days")
    )


def _benefit(produced: Column, pct: Column, eligible_kwh: float, econ: C.Economics) -> dict:
    used = produced * pct / 100
    injected = produced * (100 - pct) / 100
    return {
        "used": used,
        "injected": injected,
        "savings": used * econ.electricity_rate,
        "revenue": injected * econ.sell_back_rate,
        "incentive": F.least(injected, F.lit(eligible_kwh)) * econ.incentive_rate,
    }


def self_consumption_scenarios(
    totals: DataFrame,
    pcts: Sequence[int] = C.SELF_CONSUMPTION_PCTS,
    panel: C.Panel = C.Panel(),
    econ: C.Economics = C.Economics(),
) -> DataFrame:
    """Benefit and payback of the measured period for each self-consumption share."""
    cost = panel.power_kw * econ.installation_cost_per_kw
    pct = F.col("self_consumption_pct")
    parts = _benefit(F.col("total_kwh"), pct, econ.monthly_consumption, econ)
    period = parts["savings"] + parts["revenue"] + parts["incentive"]
    yearly = F.col("period_benefit") * 12 - econ.annual_maintenance
    payback = F.when(F.col("yearly") > 0, F.lit(cost) / F.col("yearly")).otherwise(
        F.lit(float("inf"))
    )
    return (
        totals.withColumn(
            "self_consumption_pct", F.explode(F.array(*(F.lit(int(p)) for p in pcts)))
        )
        .withColumns({"period_benefit": period})
        .withColumns({"yearly": yearly})
        .select(
            SITE,
            "total_kwh",
            "days",
            "self_consumption_pct",
            F.round(parts["used"], 1).alias("self_consumed_kwh"),
            F.round(parts["injected"], 1).alias("grid_injected_kwh"),
            F.round(parts["savings"], 2).alias("savings_euro"),
            F.round(parts["revenue"], 2).alias("revenue_euro"),
            F.round(parts["incentive"], 2).alias("incentive_euro"),
            F.round("period_benefit", 2).alias("period_benefit_euro"),
            F.round("yearly", 2).alias("annual_benefit_euro"),
            F.round(payback, 1).alias("payback_years"),
        )
    )


def best_share(scenarios: DataFrame) -> DataFrame:
    """Scenario with the lowest payback per site; the smaller share of equal ones."""
    others = [name for name in scenarios.columns if name != SITE]
    key = F.struct("payback_years", "self_consumption_pct")
    return (
        scenarios.groupBy(SITE)
        .agg(F.min_by(F.struct(*others), key).alias("best"))
        .select(SITE, "best.*")
    )


def seasonal_factor(
    factors: Sequence[float] = C.NOTEBOOK_SEASONAL_FACTORS, mode: str = "mean"
) -> float:
    """Factor from a February total to a year: the mean of the months, or their sum."""
    if mode not in ("mean", "sum"):
        raise ValueError(f"seasonal mode must be 'mean' or 'sum', not {mode!r}")
    return sum(factors) / len(factors) if mode == "mean" else sum(factors)


def seasonal_cash_flow(
    best: DataFrame,
    panel: C.Panel = C.Panel(),
    econ: C.Economics = C.Economics(),
    losses: C.Losses = C.Losses(),
    factor: float | None = None,
) -> DataFrame:
    """Cash flow per site and year from the annualised period; prices rise from year 1."""
    factor = seasonal_factor() if factor is None else factor
    produced = F.col("total_kwh") * factor
    parts = _benefit(
        F.col("annual_kwh"), F.col("self_consumption_pct"), econ.household_consumption, econ
    )
    benefit = parts["savings"] + parts["revenue"] + parts["incentive"] - econ.annual_maintenance
    year = F.col("year")
    replaced = F.when(
        year == losses.inverter_replacement_year, losses.inverter_replacement_cost
    ).otherwise(0.0)
    grown = (
        F.col("annual_benefit_euro") * F.pow(F.lit(1 + econ.annual_rate_increase), year) - replaced
    )
    cost = panel.power_kw * econ.installation_cost_per_kw
    running = (
        Window.partitionBy(SITE)
        .orderBy("year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        best.select(SITE, "total_kwh", "self_consumption_pct", produced.alias("annual_kwh"))
        .withColumn("annual_benefit_euro", benefit)
        .withColumn("year", F.explode(F.sequence(F.lit(0), F.lit(econ.analysis_years))))
        .withColumn("cash_flow", F.when(year == 0, F.lit(-cost)).otherwise(grown))
        .withColumn("cumulative", F.sum("cash_flow").over(running))
    )


def seasonal_metrics(
    flows: DataFrame, panel: C.Panel = C.Panel(), econ: C.Economics = C.Economics()
) -> DataFrame:
    """Payback (999 = never), ROI and profit after 20 years, per site."""
    cost = panel.power_kw * econ.installation_cost_per_kw
    horizon = min(20, econ.analysis_years)
    year = F.col("year")
    paid = F.min(F.when((F.col("cumulative") >= 0) & (year > 0), year))
    return flows.groupBy(SITE, "total_kwh", "annual_kwh", "annual_benefit_euro").agg(
        F.coalesce(paid, F.lit(999)).alias("payback_years"),
        (F.max(F.when(year == horizon, F.col("cumulative"))) / cost * 100).alias("roi_20_years"),
        F.max(F.when(year == horizon, F.col("cumulative"))).alias("total_profit_20_years"),
    )


def solar_vs_grid(
    metrics: DataFrame, panel: C.Panel = C.Panel(), econ: C.Economics = C.Economics()
) -> DataFrame:
    """Twenty years with and without solar, break-even rate and period coverage."""
    cost = panel.power_kw * econ.installation_cost_per_kw
    yearly = econ.household_consumption * econ.electricity_rate
    grid = yearly * sum((1 + econ.annual_rate_increase) ** y for y in range(1, 21))
    saved = F.col("total_profit_20_years") + cost
    return metrics.select(
        SITE,
        F.lit(yearly).alias("annual_grid_cost"),
        F.lit(grid).alias("grid_cost_20_years"),
        saved.alias("solar_savings_20_years"),
        (saved - grid).alias("net_benefit_vs_grid"),
        (F.try_divide(F.lit(cost), F.col("annual_kwh") * 20) + econ.sell_back_rate).alias(
            "break_even_rate"
        ),
        F.lit(econ.monthly_consumption * econ.electricity_rate).alias("period_grid_cost"),
        (F.col("total_kwh") / econ.monthly_consumption * 100).alias("coverage_percentage"),
    )


def simple_sensitivity(
    best: DataFrame,
    sizes: Sequence[float] = C.CANDIDATE_SIZES_KW,
    panel: C.Panel = C.Panel(),
    econ: C.Economics = C.Economics(),
    factor: float | None = None,
) -> DataFrame:
    """All sizes from the annualised period, the lowest payback marked per site."""
    factor = seasonal_factor() if factor is None else factor
    size = F.col("panel_size_kw")
    parts = _benefit(
        F.col("annual"), F.col("self_consumption_pct"), econ.household_consumption, econ
    )
    benefit = parts["savings"] + parts["revenue"] + parts["incentive"] - econ.annual_maintenance
    cost = size * econ.installation_cost_per_kw
    payback = F.when(F.col("benefit") > 0, cost / F.col("benefit")).otherwise(
        F.lit(float("inf"))
    )
    order = Window.partitionBy(SITE).orderBy("payback_years", "panel_size_kw")
    return (
        best.select(SITE, "total_kwh", "self_consumption_pct")
        .withColumn("panel_size_kw", F.explode(F.array(*(F.lit(float(s)) for s in sizes))))
        .withColumn("period", F.col("total_kwh") / panel.power_kw * size)
        .withColumn("annual", F.col("period") * factor)
        .withColumn("benefit", benefit)
        .select(
            SITE,
            "panel_size_kw",
            F.round("period", 1).alias("period_production_kwh"),
            F.col("annual").cast("long").alias("annual_production_kwh"),
            cost.cast("long").alias("installation_cost_euro"),
            F.col("benefit").cast("long").alias("annual_benefit_euro"),
            F.round(payback, 1).alias("payback_years"),
        )
        .withColumn("is_best", F.row_number().over(order) == 1)
    )


def simple_score(metrics: DataFrame, comparison: DataFrame) -> DataFrame:
    """Score of the simple study from payback, ROI and coverage."""
    always = F.lit(True)
    coverage = F.col("coverage_percentage")
    shown = [
        (coverage > limit, points, F.format_string(text, coverage), strength)
        for limit, points, text, strength in SIMPLE_COVERAGE_STEPS
    ]
    shown.append((always, 0, F.format_string(SIMPLE_COVERAGE_REST, coverage), False))
    joined = metrics.select(SITE, "payback_years", "roi_20_years").join(
        comparison.select(SITE, "coverage_percentage"), SITE
    )
    return _scored(
        joined,
        [
            _steps(
                F.col("payback_years"),
                SIMPLE_PAYBACK_STEPS,
                _below,
                [(always, 0, SIMPLE_PAYBACK_REST)],
            ),
            _steps(
                F.col("roi_20_years"), SIMPLE_ROI_STEPS, _above, [(always, 0, SIMPLE_ROI_REST)]
            ),
            _step(shown),
        ],
    )

