"""Bands that come as a table: which rows lie in which bands, for many bands per site.

A band is a row (keys, band_min, band_max, ...); both ends are inclusive and a NULL end is open.  Bands may
overlap, differ by site and number in the tens of thousands.  Each band is assigned to a grid whose cells
are about as wide as the band, so that it covers one or two cells; a row is looked up once per grid that its
keys use.  That turns the range join into an equi-join whose candidates are few besides the matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.functions.skew import ROWS_PER_TASK, skew_join

#: Cell numbers stay below 2**51, so that they are exact in a double and fit a long.
_SPAN_BITS = 50
_NOWHERE = -1000  # grid of a band that is the single point 0


def rows_in_bands(
    df: DataFrame,
    bands: DataFrame,
    keys: Sequence[str],
    value: str,
    row_id: Sequence[str],
    band_id: Sequence[str] = ("band",),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each row of ``df`` once per band of its keys that contains its value, with the columns of the band.

    A NULL or NaN value, and a NULL key, lie in no band; a band whose least value exceeds its highest holds
    nothing; infinite values lie in open bands.  Repeated rows and repeated bands match each on their own.
    ``row_id`` and ``band_id`` name columns whose hash spreads a busy cell over tasks.
    """
    keys = list(keys)
    measured = df.withColumn("__x", F.col(value).cast("double")).where("__x IS NOT NULL AND NOT isnan(__x)")
    extent = measured.groupBy(*keys).agg(
        F.min("__x").alias("__least"),
        F.max("__x").alias("__most"),
        F.coalesce(F.min(F.when(_finite("__x"), F.col("__x"))), F.lit(0.0)).alias("__low"),
        F.coalesce(F.max(F.when(_finite("__x"), F.col("__x"))), F.lit(0.0)).alias("__high"),
    )
    gridded = _gridded(bands, extent, keys)
    grids = gridded.groupBy(*keys).agg(
        F.collect_set("__grid").alias("__grids"), F.first("__low").alias("__low"), F.first("__high").alias("__high")
    )
    looked_up = (
        measured.join(grids, keys)
        .withColumn("__at", _clipped("__x"))
        .withColumn("__grid", F.explode("__grids"))
        .withColumn("__cell", _cell("__at"))
        .drop("__grids", "__low", "__high", "__at")
    )
    covering = gridded.withColumn(
        "__cell", F.explode(F.array_distinct(F.array(_cell("__from"), _cell("__to"))))
    ).drop("__from", "__to", "__low", "__high")
    met = skew_join(
        looked_up,
        covering,
        [*keys, "__grid", "__cell"],
        salt_by=row_id,
        right_salt_by=band_id,
        rows_per_task=rows_per_task,
    )
    inside = "(band_min IS NULL OR __x >= band_min) AND (band_max IS NULL OR __x <= band_max)"
    return met.where(inside).select(*df.columns, *(c for c in bands.columns if c not in keys))


def band_counts(df: DataFrame, bands: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``bands`` with ``count``, the rows of their keys in them; bands without a row count 0.

    Equal values are added up before the join, so no value is busy however many rows have it.
    """
    keys = list(keys)
    values = df.groupBy(*keys, F.col(value).cast("double").alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    # equal bands are counted once and given back to each of them
    ends = bands.select(*keys, "band_min", "band_max").distinct()
    ends = ends.withColumn("__band", F.xxhash64("band_min", "band_max"))
    held = rows_in_bands(values, ends, keys, "__value", ["__value"], ["__band"])
    counted = held.groupBy(*keys, "band_min", "band_max").agg(F.sum("__n").alias("count"))
    same = [F.col(f"b.{k}") == F.col(f"n.{k}") for k in keys]
    same += [F.col(f"b.{end}").eqNullSafe(F.col(f"n.{end}")) for end in ("band_min", "band_max")]
    joined = bands.alias("b").join(counted.alias("n"), same, "left")
    return joined.select("b.*", F.coalesce("n.count", F.lit(0)).alias("count"))


def _gridded(bands: DataFrame, extent: DataFrame, keys: list[str]) -> DataFrame:
    """``bands`` that meet the extent of their keys, with ends clipped to it and the grid of their width."""
    low, high = F.col("band_min").cast("double"), F.col("band_max").cast("double")
    met = (
        bands.join(extent, keys)
        .where(low.isNull() | high.isNull() | (low <= high))
        .where(low.isNull() | (low <= F.col("__most")))
        .where(high.isNull() | (high >= F.col("__least")))
        .withColumn("__from", F.coalesce(low, F.col("__low")))
        .withColumn("__to", F.coalesce(high, F.col("__high")))
        .withColumns({"__from": _clipped("__from"), "__to": _clipped("__to")})
    )
    width = F.ceil(F.log2(F.nullif(F.col("__to") - F.col("__from"), F.lit(0.0)))) + 1
    size = F.greatest(F.abs("__from"), F.abs("__to"))
    fineness = F.ceil(F.log2(F.nullif(size, F.lit(0.0)))) - _SPAN_BITS
    grid = F.coalesce(F.greatest(width, fineness), F.lit(_NOWHERE)).cast("int")
    return met.withColumn("__grid", grid).drop("__least", "__most")


def _finite(column: str) -> Column:
    return F.abs(column) < F.lit(float("inf"))


def _clipped(column: str) -> Column:
    """Into the finite extent of the keys: keeps the order, so a value inside a band stays inside."""
    return F.greatest(F.col("__low"), F.least(F.col("__high"), F.col(column)))


def _cell(column: str) -> Column:
    """Number of the cell; beyond the longs all values share the outermost cell."""
    return F.floor(F.col(column) / F.pow(F.lit(2.0), F.col("__grid").cast("double")))
