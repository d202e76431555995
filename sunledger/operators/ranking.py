"""Scenario ranking for every combination of client choices."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.operators.economics import size_sensitivity
from sunledger.operators.energy import SITE, panel_count

CRITERIA = ("payback", "value", "coverage", "self_consumption", "capex", "production")
CHOICE = ("profile", "priority", "budget", "horizon")

# Rules on top of the weighted score
NO_PAYBACK_YEARS = 99.0
LARGER_THAN_CURRENT_ON_LEAN = -0.08
HOMEOWNER_LOW_SELF = (25.0, -0.08)
HOMEOWNER_LARGE = (3.5, -0.10)
SMALL_BUSINESS_FIT = (3.0, 4.5, 0.05)
BIG_BUSINESS_LARGE = (4.5, 0.08)
COVERAGE_GAIN = 0.04
CHEAPER_THAN_CURRENT = 0.03


def choice_weights(weights: C.ChoiceWeights = C.ChoiceWeights()) -> list[dict]:
    """All combinations of choices with their criterion weights, normalised to 1."""
    rows = []
    for profile, priority, budget, horizon in product(
        weights.profile, weights.priority, weights.budget, weights.horizon
    ):
        adjusted = {
            name: weights.base[name]
            + weights.profile[profile].get(name, 0.0)
            + weights.priority[priority].get(name, 0.0)
            + weights.horizon[horizon].get(name, 0.0)
            for name in CRITERIA
        }
        total = sum(adjusted.values())
        rows.append(
            {
                "profile": profile,
                "priority": priority,
                "budget": budget,
                "horizon": horizon,
                "budget_limit": weights.budget[budget],
                **{name: value / total for name, value in adjusted.items()},
            }
        )
    return rows


def _choices(weights: C.ChoiceWeights) -> Column:
    """The combinations as an array literal: exploded next to each scenario, never joined."""
    rows = []
    for row in choice_weights(weights):
        numbers = ", ".join(f"{row[name]!r}D AS {name}" for name in CRITERIA)
        limit = "CAST(NULL AS DOUBLE)" if row["budget_limit"] is None else f"{row['budget_limit']}D"
        texts = ", ".join(f"'{row[name]}' AS {name}" for name in CHOICE)
        rows.append(f"struct({texts}, {limit} AS budget_limit, {numbers})")
    return F.expr(f"explode(array({', '.join(rows)}))")


def payback_number(years: Column) -> Column:
    """Payback years as a criterion: none at all counts as 99."""
    return F.coalesce(years.cast("double"), F.lit(NO_PAYBACK_YEARS))


def scenario_ranking(
    metrics: DataFrame,
    current_kw: float = C.Panel().power_kw,
    weights: C.ChoiceWeights = C.ChoiceWeights(),
    top_k: int | None = None,
) -> DataFrame:
    """The ``top_k`` sizes of each site for each of the 81 choices; rank 1 is recommended.

    ``metrics`` holds the candidate sizes of each site, the current one among
    them.  The criteria are scaled per site before the choices come in, so the
    windows run over the candidate sizes only.
    """
    top_k = weights.top_k if top_k is None else top_k
    per_site = Window.partitionBy(SITE)

    def of_current(column: str) -> Column:
        is_current = F.col("panel_size_kw") == current_kw
        return F.max(F.when(is_current, F.col(column))).over(per_site)

    compared = metrics.withColumns(
        {
            "payback_number": F.col("payback_years"),
            "current_coverage": of_current("demand_coverage_pct"),
            "current_cost": of_current("installation_cost_euro"),
        }
    )
    sources = {
        "payback": payback_number(F.col("payback_number")),
        "value": F.col("npv_25_years_euro"),
        "coverage": F.col("demand_coverage_pct"),
        "self_consumption": F.col("self_consumption_pct"),
        "capex": F.col("installation_cost_euro"),
        "production": F.col("annual_production_kwh"),
    }
    rated = size_sensitivity(compared, "payback_number", "current_coverage", "current_cost").withColumns(
        {f"{n}_raw": value for n, value in sources.items()}
    )
    rated = rated.withColumns(
        {f"{n}_low": F.min(f"{n}_raw").over(per_site) for n in CRITERIA}
        | {f"{n}_high": F.max(f"{n}_raw").over(per_site) for n in CRITERIA}
    )

    def scaled(name: str) -> Column:
        raw, low, high = (f"{name}_{part}" for part in ("raw", "low", "high"))
        unit = f"CASE WHEN {high} = {low} THEN 0.5D ELSE ({raw} - {low}) / ({high} - {low}) END"
        return F.expr(f"1D - {unit}" if name in ("payback", "capex") else unit)

    scored = rated.withColumns({f"{n}_score": scaled(n) for n in CRITERIA})
    chosen = scored.withColumn("choice", _choices(weights)).withColumn(
        "within_budget",
        F.coalesce(
            F.col("installation_cost_euro") <= F.col("choice.budget_limit"), F.lit(True)
        ),
    )
    weighted = F.expr(" + ".join(f"{name}_score * choice.{name}" for name in CRITERIA))
    whole = Window.partitionBy(SITE, *(f"choice.{name}" for name in CHOICE))
    order = whole.orderBy(F.col("ranking_score").desc(), "panel_size_kw")
    ranked = chosen.withColumn("ranking_score", weighted + _rules(weights, current_kw)).withColumns(
        {
            "rank": F.row_number().over(order),
            "outside_budget": F.count_if(~F.col("within_budget")).over(whole),
        }
    )
    return ranked.where(F.col("rank") <= top_k).select(
        SITE,
        *(F.col(f"choice.{name}").alias(name) for name in CHOICE),
        "rank",
        "panel_size_kw",
        panel_count(F.col("panel_size_kw")).alias("panels"),
        "ranking_score",
        "within_budget",
        "outside_budget",
        *(f"{name}_score" for name in CRITERIA),
    )


def _rules(weights: C.ChoiceWeights, current_kw: float) -> Column:
    """Penalties and bonuses that depend on the choice."""
    size = F.col("panel_size_kw")
    profile, priority = F.col("choice.profile"), F.col("choice.priority")
    low_self, low_self_points = HOMEOWNER_LOW_SELF
    large, large_points = HOMEOWNER_LARGE
    fit_from, fit_to, fit_points = SMALL_BUSINESS_FIT
    big_from, big_points = BIG_BUSINESS_LARGE
    rules = [
        (~F.col("within_budget"), weights.over_budget),
        (
            (F.col("choice.budget") == "lean") & (size > current_kw),
            LARGER_THAN_CURRENT_ON_LEAN,
        ),
        ((profile == "homeowner") & (F.col("self_consumption_pct") < low_self), low_self_points),
        ((profile == "homeowner") & (size > large), large_points),
        ((profile == "small_business") & size.between(fit_from, fit_to), fit_points),
        ((profile == "big_business") & (size >= big_from), big_points),
        (
            (priority == "coverage") & (F.col("demand_coverage_pct") > F.col("current_coverage")),
            COVERAGE_GAIN,
        ),
        (
            (priority == "payback")
            & (F.col("installation_cost_euro") < F.col("current_cost")),
            CHEAPER_THAN_CURRENT,
        ),
    ]
    return sum((F.when(applies, points).otherwise(0.0) for applies, points in rules), F.lit(0.0))
