"""DuckDB SQL that recomputes every registered query from the driver's tables."""

from oracles import feasibility, ingestion, medallion  # noqa: F401  (they register their queries)
from oracles.base import ORACLES

# literals of type INTEGER in the texts; results are compared as BIGINT
_SMALL_INTEGERS = {
    "health_score": ("freshness_score", "quality_score"),
    "health_score_deductions": ("freshness_penalty", "quality_penalty", "empty_penalty"),
    "alert_decision": ("exit_code",),
    "battery_sizing": ("lifetime_years",),
    "recommendation_score": ("score",),
    "panel_count": ("roof_limit",),
    "self_consumption_scenarios": ("self_consumption_pct",),
    "best_self_consumption": ("self_consumption_pct",),
    "seasonal_cash_flow": ("self_consumption_pct",),
    "simple_score": ("score",),
}
for _name, _columns in _SMALL_INTEGERS.items():
    _casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLES[_name]})"

__all__ = ["ORACLES"]
