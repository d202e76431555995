"""Exact quantiles without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from sunledger.functions.semantics import join_null_safe

# Bits kept by the coarse values: 1024 cells per power of two, then 2**16 finer ones in each.
_SPLITS = (float(2**43 + 1), float(2**27 + 1))


def _coarse(value: Column, split: float) -> Column:
    """``value`` rounded to fewer significant bits; never reverses the order of two values."""
    stretched = value * F.lit(split)
    return stretched - (stretched - value)


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: Column, probs: Sequence[float]
) -> DataFrame:
    """One row per group with ``n`` and ``quantiles`` (array in the order of ``probs``).

    Linear interpolation between neighbours, as pandas and ``percentile`` do.

    1. rows collapse to (group, value, count) with a map-side combine, so a hot
       value costs nothing;
    2. counts per coarse cell give the running rank of every cell, and only the
       cells that hold a wanted rank stay; the same again with finer cells
       inside those;
    3. the values of the finer cells are ranked one cell at a time.

    No step sorts more than the cells of a group, the finer cells of one cell or
    the distinct values of one finer cell (a part in 2**26).  NULL values are
    left out; NULL is a group of its own.
    """
    groups = list(groups)
    valued = df.select(*groups, value.cast("double").alias("v")).where("v IS NOT NULL")
    freq = valued.groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("n"))
    freq = freq.withColumns(
        {"cell": _coarse(F.col("v"), _SPLITS[0]), "fine": _coarse(F.col("v"), _SPLITS[1])}
    )

    whole = Window.partitionBy(*groups)
    wanted = F.array_distinct(
        F.flatten(F.array(*(F.array(*_neighbours(F.col("total"), p)) for p in probs)))
    )
    cells = (
        freq.groupBy(*groups, "cell")
        .agg(F.sum("n").alias("cell_n"))
        .withColumn("total", F.sum("cell_n").over(whole))
        .withColumn("start", F.sum("cell_n").over(_upto(whole, "cell")) - F.col("cell_n"))
        .withColumn("ranks", _inside(wanted, F.col("start"), F.col("start") + F.col("cell_n")))
        .where(F.size("ranks") > 0)
        .select(*groups, "cell", "start", "total", "ranks")
    )
    in_cell = Window.partitionBy(*groups, "cell")
    finer = (
        join_null_safe(freq.groupBy(*groups, "cell", "fine").agg(F.sum("n").alias("fine_n")), cells, [*groups, "cell"])
        .withColumn("start", F.col("start") + F.sum("fine_n").over(_upto(in_cell, "fine")) - F.col("fine_n"))
        .withColumn("ranks", _inside(F.col("ranks"), F.col("start"), F.col("start") + F.col("fine_n")))
        .where(F.size("ranks") > 0)
        .select(*groups, "cell", "fine", "start", "total", "ranks")
    )
    in_fine = Window.partitionBy(*groups, "cell", "fine")
    found = (
        join_null_safe(freq, finer, [*groups, "cell", "fine"])
        .withColumn("v_end", F.col("start") + F.sum("n").over(_upto(in_fine, "v")))
        .withColumn(
            "rank", F.explode(_inside(F.col("ranks"), F.col("v_end") - F.col("n"), F.col("v_end")))
        )
        # at most two ranks per probability and group
        .groupBy(*groups)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("by_rank"),
            F.max("total").alias("n"),
        )
    )
    return found.select(
        *groups,
        "n",
        F.array(*(_interpolate(F.col("by_rank"), F.col("n"), p) for p in probs)).alias(
            "quantiles"
        ),
    )


def _upto(window: WindowSpec, order: str) -> WindowSpec:
    return window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _position(n: Column, p: float) -> Column:
    return (n - 1).cast("double") * F.lit(float(p))


def _neighbours(n: Column, p: float) -> tuple[Column, Column]:
    position = _position(n, p)
    return F.floor(position).cast("long"), F.ceil(position).cast("long")


def _inside(ranks: Column, start: Column, end: Column) -> Column:
    return F.filter(ranks, lambda r: (r >= start) & (r < end))


def _interpolate(by_rank: Column, n: Column, p: float) -> Column:
    low, high = _neighbours(n, p)
    below, above = F.element_at(by_rank, low), F.element_at(by_rank, high)
    return below + (above - below) * (_position(n, p) - low)
