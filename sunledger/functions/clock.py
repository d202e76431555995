"""``as_of`` windows as literal predicates, so that they reach the scan.

All bounds are computed on the driver from the ``as_of`` moment, never with
``current_timestamp()``.  A table that carries the ``event_date`` partition
column gets the matching partition predicate as well.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_COLUMN = "event_date"


def moment_text(df: DataFrame, column: str, moment: datetime) -> str:
    """``moment`` as a SQL literal of the type of ``column`` (TIMESTAMP or TIMESTAMP_NTZ)."""
    kind = df.schema[column].dataType.typeName().upper()
    return f"{kind} '{moment.isoformat(sep=' ', timespec='microseconds')}'"


def moment_like(df: DataFrame, column: str, moment: datetime) -> Column:
    return F.expr(moment_text(df, column, moment))


def _partitioned(df: DataFrame, *conditions: str) -> str:
    """The same bounds on the partition column, where the table has one."""
    if PARTITION_COLUMN not in df.columns:
        return ""
    return "".join(f" AND {PARTITION_COLUMN} {condition}" for condition in conditions)


def visible(df: DataFrame, as_of: datetime, ts: str = "timestamp") -> DataFrame:
    """Rows a live table would hold at ``as_of``."""
    end = moment_text(df, ts, as_of)
    return df.where(f"{ts} <= {end}" + _partitioned(df, f"<= DATE '{as_of.date()}'"))


def recent(
    df: DataFrame,
    as_of: datetime,
    span: timedelta,
    ts: str = "timestamp",
    inclusive: bool = False,
) -> DataFrame:
    """Rows of the last ``span`` up to ``as_of``; ``inclusive`` keeps the lower bound."""
    first = as_of - span
    start, end = moment_text(df, ts, first), moment_text(df, ts, as_of)
    days = _partitioned(df, f">= DATE '{first.date()}'", f"<= DATE '{as_of.date()}'")
    return df.where(f"{ts} {'>=' if inclusive else '>'} {start} AND {ts} <= {end}" + days)


def on_day(df: DataFrame, day: date, as_of: datetime, ts: str = "timestamp") -> DataFrame:
    """Rows of one calendar day, as a half-open range rather than a function of the column."""
    end = moment_text(df, ts, as_of)
    days = _partitioned(df, f"= DATE '{day}'")
    return df.where(f"{_day_range(df, day, ts)} AND {ts} <= {end}" + days)


def in_day(df: DataFrame, day: date, ts: str = "timestamp") -> Column:
    """Predicate form of :func:`on_day`, for conditional aggregates."""
    return F.expr(_day_range(df, day, ts))


def _day_range(df: DataFrame, day: date, ts: str) -> str:
    start = datetime.combine(day, time.min)
    bounds = (moment_text(df, ts, moment) for moment in (start, start + timedelta(days=1)))
    return "{0} >= {1} AND {0} < {2}".format(ts, *bounds)


def hours_between(later: Column, earlier: Column) -> Column:
    """Fractional hours from ``earlier`` to ``later``."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(3.6e9)


def day_of_week_sunday0(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark counts Sunday as 1)."""
    return F.dayofweek(ts) - 1
