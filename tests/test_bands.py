"""Bands from a table against a comparison of every value with every band."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sunledger.operators.bands import band_counts, rows_in_bands
from tests.test_plans import FORBIDDEN, plan_of

VALUES = "id long, site string, x double, band string"  # a clashing column rides along
BANDS = "site string, band string, band_min double, band_max double"


def inside(x, low, high):
    if x is None or math.isnan(x):
        return False
    return (low is None or x >= low) and (high is None or x <= high)


def brute(values, bands):
    return sorted(
        (v[0], b[1]) for v in values for b in bands if v[1] is not None and v[1] == b[0] and inside(v[2], *b[2:])
    )


def found(spark, values, bands, **options):
    left = spark.createDataFrame(values, VALUES).drop("band")
    right = spark.createDataFrame(bands, BANDS)
    rows = rows_in_bands(left, right, ["site"], "x", ["id"], **options).select("id", "band").collect()
    return sorted((r.id, r.band) for r in rows)


def random_case(seed):
    rng = random.Random(seed)
    ends = [0.0, -0.0, 1.0, -1.0, 1e-300, -1e300, 1e300, 0.1, 100.0, 2.0**53, math.inf, -math.inf, None]
    number = lambda: rng.choice([*ends[:-1], rng.uniform(-50, 150), float(round(rng.uniform(0, 20)))])
    values = [
        (i, rng.choice(["a", "b", "c", None]), rng.choice([None, math.nan, number(), number(), number()]), "")
        for i in range(300)
    ]
    bands = []
    for i in range(120):
        low, high = number(), number()
        if rng.random() < 0.8 and low > high:
            low, high = high, low
        bands.append((rng.choice(["a", "b", None, "d"]), str(i), rng.choice([low, low, None]), rng.choice([high, high, low, None])))
    return values, bands + bands[:3]


@pytest.mark.parametrize("seed", range(4))
def test_matches_equal_brute_force(spark, seed):
    values, bands = random_case(seed)
    assert found(spark, values, bands) == brute(values, bands)


def test_busy_cell_is_split_without_loss(spark):
    values = [(i, "a", 20.0 if i % 3 else float(i), "") for i in range(400)]
    bands = [("a", str(i), 20.0 - i / 10, 20.0 + i / 10) for i in range(60)] + [("a", "rest", None, None)]
    assert found(spark, values, bands, rows_per_task=50) == brute(values, bands)


@pytest.mark.parametrize("empty", ["values", "bands"])
def test_empty_tables(spark, empty):
    values = [] if empty == "values" else [(1, "a", 1.0, "")]
    bands = [] if empty == "bands" else [("a", "b", 0.0, 2.0)]
    assert found(spark, values, bands) == []
    left = spark.createDataFrame(values, VALUES).drop("band")
    counted = band_counts(left, spark.createDataFrame(bands, BANDS), ["site"], "x").collect()
    assert [r["count"] for r in counted] == [0] * len(bands)


def test_counts_keep_every_band(spark):
    values, bands = random_case(9)
    left = spark.createDataFrame(values, VALUES).drop("band")
    counted = band_counts(left, spark.createDataFrame(bands, BANDS), ["site"], "x").collect()
    expected = sorted(
        (b[1], sum(1 for v in values if v[1] is not None and v[1] == b[0] and inside(v[2], *b[2:]))) for b in bands
    )
    assert sorted((r.band, r["count"]) for r in counted) == expected


def test_ten_thousand_bands_need_no_nested_loop(spark):
    bands = spark.range(10_000).selectExpr(
        "concat('s', id % 4) AS site", "CAST(id AS STRING) AS band",
        "CAST(id / 100 AS DOUBLE) AS band_min", "CAST(id / 100 + id % 7 AS DOUBLE) AS band_max",
    )
    values = spark.range(20_000).selectExpr("id", "concat('s', id % 4) AS site", "CAST(id % 1000 AS DOUBLE) / 10 AS x")
    held = rows_in_bands(values, bands, ["site"], "x", ["id"])
    assert not [operator for operator in FORBIDDEN if operator in plan_of(held)]
    per_value = held.groupBy("site", "x").agg(F.count(F.lit(1)).alias("n")).collect()
    ranges = [[(i / 100, i / 100 + i % 7) for i in range(10_000) if i % 4 == s] for s in range(4)]
    for row in per_value[::97]:
        hits = sum(1 for low, high in ranges[int(row.site[1:])] if low <= row.x <= high)
        same = 20_000 // 1000 if row.site is not None else 0
        assert row.n == hits * same
