"""Multi-step plans: layer refresh, feasibility study, and the query catalogue."""
