"""Expressions that keep PostgreSQL's results on Spark.

Averages, percentages and stored values go through DECIMAL, which makes them
exact and independent of the partitioning; doubles appear only in the end.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def exact_mean(value: Column, when: Column | None = None) -> Column:
    """Mean of a DECIMAL or integer column as DOUBLE.

    The sum is exact, so there is one rounding whatever the partitioning; on
    the narrow decimals of the tables Spark adds plain longs.
    """
    picked = _picked(value, when)
    return exact_sum(picked) / F.nullif(F.count(picked), F.lit(0))


def exact_sum(value: Column) -> Column:
    """Sum of a DECIMAL or integer column as DOUBLE."""
    return F.sum(value).cast("double")


#: A double is added up as whole part and two fractions of this many bits each.
_FRACTION = 1 << 26
_COUNTABLE = float(1 << 32)


def fixed_point_sum(value: Column) -> Column:
    """Sum of a DOUBLE column that does not depend on the order of the rows.

    Every value is split into three whole numbers (fixed point with 52 bits after the point), which Spark
    adds as longs inside generated code.  Values from 2**32 on, infinities and NaN are added as plain
    doubles beside them: a NaN gives NaN, an infinity an infinity, nothing raises.
    """
    plain = F.abs(value) < F.lit(_COUNTABLE)  # false for NaN, which is above every number
    counted = F.when(plain, value)
    whole = F.floor(counted)
    first = F.floor((counted - whole) * _FRACTION)
    second = F.floor(((counted - whole) * _FRACTION - first) * _FRACTION)
    total = F.sum(whole).cast("double") + (
        F.sum(first).cast("double") + F.sum(second).cast("double") / _FRACTION
    ) / _FRACTION
    other = F.sum(F.when(~plain, value))
    return F.coalesce(total + other, total, other)


def stable_sum(value: Column) -> Column:
    """Sum of measured DOUBLE values, which have few digits after the point, as their decimal sum.

    Added up in DECIMAL with sixteen digits after the point; sums reach 1e22.  For computed values
    :func:`fixed_point_sum` is faster and takes any DOUBLE.
    """
    return F.sum(value.cast("decimal(32,16)")).cast("double")


def stable_mean(value: Column) -> Column:
    """Mean of a DOUBLE column that does not depend on the order of the rows."""
    return stable_sum(value) / F.nullif(F.count(value), F.lit(0))


def stored_mean(value: Column, precision: int, scale: int, when: Column | None = None) -> Column:
    """AVG as it is stored in a ``DECIMAL(precision, scale)`` column."""
    return decimal_mean(_picked(value, when)).cast(f"decimal({precision},{scale})")


def decimal_mean(value: Column) -> Column:
    """Mean of a DECIMAL or integer column as DECIMAL, with ten spare digits."""
    count = F.nullif(F.count(value), F.lit(0)).cast("decimal(16,0)")
    return F.sum(value).cast("decimal(28,6)") / count


def _picked(value: Column, when: Column | None) -> Column:
    return value if when is None else F.when(when, value)


def percentage(part: Column, whole: Column, scale: int = 2) -> Column:
    """``ROUND(100.0 * part / whole, scale)`` on counts; NULL when ``whole`` is 0."""
    quotient = (part.cast("decimal(16,0)") * F.lit(100)).cast("decimal(19,0)") / F.nullif(
        whole, F.lit(0)
    ).cast("decimal(16,0)")
    return F.round(quotient, scale)


def share(part: Column, whole: Column) -> Column:
    """part / whole as DOUBLE, NULL when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ladder(value: str, steps: Sequence[tuple], rest: str, compare: str = "<") -> Column:
    """First label whose limit ``value`` is below (or above); NULL falls to ``rest``."""
    cases = " ".join(f"WHEN {value} {compare} {limit} THEN '{label}'" for limit, label in steps)
    return F.expr(f"CASE {cases} ELSE '{rest}' END")


def holds(*conditions: str) -> Column:
    """All conditions as one plain flag: UNKNOWN counts as FALSE."""
    return F.expr(f"coalesce({' AND '.join(conditions)}, FALSE)")


def within(value: str, bounds: tuple) -> str:
    low, high = bounds
    return f"{value} BETWEEN {low} AND {high}"


def outside(value: str, bounds: tuple) -> str:
    low, high = bounds
    return f"({value} < {low} OR {value} > {high})"


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which NULL keys meet; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(other, same, how).drop(*(f"__{k}" for k in keys))


def present(items: Iterable[Column]) -> Column:
    """Array of the given values without the NULL ones, in order."""
    return F.filter(F.array(*items), lambda item: item.isNotNull())


def one_row(df: DataFrame) -> Column:
    """A one-row DataFrame as a struct column: an uncorrelated scalar subquery.

    Spark runs it once and hands the row to the tasks as a literal, which is
    what a report needs from another table's totals, without any join.
    """
    return df.select(F.struct(*df.columns)).scalar()
