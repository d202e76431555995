"""The feasibility study from hourly production to ranked scenarios, for many sites at once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sunledger import constants as C
from sunledger.operators import economics, energy, ranking
from sunledger.session import materialise


def cash_flows(hours: DataFrame) -> DataFrame:
    """Hourly production -> load -> yearly balances -> cash flow of every candidate size."""
    return economics.cash_flow(energy.yearly_balances(energy.load_profile(hours)))


def metrics(hours: DataFrame) -> DataFrame:
    return economics.scenario_metrics(cash_flows(hours))


def ranked_choices(hours: DataFrame) -> DataFrame:
    """Top sizes of every site for each of the client choices."""
    return ranking.scenario_ranking(metrics(hours))


def trajectories(hours: DataFrame) -> DataFrame:
    """Cumulative cash flow of the current against the optimal size.

    The flows (sites x sizes x years rows) are read by two branches: computed
    once, apart from the hours.
    """
    flows = materialise(cash_flows(hours))
    best = economics.optimal_size(economics.scenario_metrics(flows))
    return economics.trajectory_series(flows, best, C.Panel().power_kw)


def study(hours: DataFrame) -> dict[str, DataFrame]:
    """All result tables of the study; the flows behind most of them are computed once."""
    flows = materialise(cash_flows(hours))
    scenarios = economics.scenario_metrics(flows)
    best = economics.optimal_size(scenarios)
    hourly = energy.energy_flows(energy.load_profile(hours))
    return {
        "hourly_flows": hourly,
        "monthly_summary": energy.monthly_energy(hourly),
        "scenario_year": flows,
        "scenario_metrics": scenarios,
        "sensitivity": economics.size_sensitivity(scenarios),
        "optimal_system": best,
        "recommendation": economics.recommendation_score(best),
    }
