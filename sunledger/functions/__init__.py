"""Column helpers: PostgreSQL-compatible semantics, clocks, skew, quantiles, sun."""
