"""States per day: merged in any order and grouping they give what the rows give."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sunledger.operators import climate, daystates, gold
from sunledger.plans import refresh
from sunledger.plans.catalog import AS_OF
from sunledger.plans.fleet import Fleet
from sunledger.sources.tables import refresh_days, refresh_table
from sunledger.streaming import rollup
from tests.conftest import SMALL


def test_distinct_panels_of_months(spark):
    rows = [
        (datetime(2024, m, d, h), f"P{(7 * d + h) % (40 + m)}", float(h), h % 3 == 0, 0.5, 20.0)
        for m in (1, 2)
        for d in range(1, 29)
        for h in (8, 12, 16)
    ] + [(datetime(2024, 3, 1), None, None, None, None, None)]
    schema = "timestamp timestamp_ntz, panel_id string, production double, is_valid boolean, e double, t double"
    solar = spark.createDataFrame(rows, schema).select(
        "timestamp",
        "panel_id",
        "is_valid",
        F.col("production").cast("decimal(8,3)").alias("production_kw"),
        F.col("e").cast("decimal(12,3)").alias("efficiency_ratio"),
        F.col("t").cast("decimal(5,1)").alias("temperature_c"),
    )
    first = daystates.panel_numbers(solar.where("timestamp < '2024-01-10'"))
    first = spark.createDataFrame(first.collect(), first.schema)
    more = daystates.panel_numbers(solar, first)
    numbers = first.unionByName(spark.createDataFrame(more.collect(), more.schema))
    assert numbers.select("number").distinct().count() == numbers.count() == solar.select("panel_id").dropna().distinct().count()
    got = daystates.months_of_days(daystates.production_states(solar), daystates.panel_bitmaps(solar, numbers))
    want = gold.monthly_kpis(solar)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert {r.month: r.total_panels for r in got.collect()}[3] == 0


def states_of(spark, values):
    rows = [("Turin", date(2024, 1, 1 + i % 20), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame([*rows, ("Turin", date(2024, 1, 2), None)], "city string, date date, temperature double")
    return df, daystates.variable_states(df, "city", F.col("date"), ["temperature"])


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_merged_moments_and_quantiles(spark, parts):
    values = [((i * 7919) % 10007) / 100 for i in range(20_000)]
    df, states = states_of(spark, values)
    # days first in `parts` groups, then the groups: any order of merging
    groups = daystates.merged_days(states.withColumn("g", F.pmod(F.hash("day"), F.lit(parts))), "city", ["g"])
    (row,) = daystates.state_summary(daystates.merged_days(groups.drop("g"), "city")).collect()
    (want,) = climate.variable_summary(df, variables=["temperature"]).collect()
    assert (row.n, row["min"], row["max"]) == (20_000, want["min"], want["max"])
    assert row["mean"] == pytest.approx(want["mean"], rel=1e-12)
    assert row["std"] == pytest.approx(want["std"], rel=1e-9)
    ordered = sorted(values)
    for p in (10, 50, 90):
        q = row[f"p{p}"]
        below = sum(v < q for v in ordered) / len(ordered)
        upto = sum(v <= q for v in ordered) / len(ordered)
        assert below - daystates.RANK_ERROR <= p / 100 <= upto + daystates.RANK_ERROR


def test_days_without_measurements_have_no_state(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), None), ("a", date(2024, 1, 1), float("nan"))], "city string, date date, temperature double")
    assert daystates.variable_states(df, "city", F.col("date"), ["temperature"]).count() == 0
    one = spark.createDataFrame([("a", date(2024, 1, 1), 2.0)], "city string, date date, temperature double")
    (row,) = daystates.state_summary(daystates.variable_states(one, "city", F.col("date"), ["temperature"])).collect()
    assert (row["mean"], row["std"], row["p50"]) == (2.0, None, 2.0)


def test_one_changed_day_reads_one_day(spark, tmp_path, monkeypatch):
    fleet = Fleet(spark, SMALL, AS_OF)
    lake = refresh.Lake(spark, str(tmp_path))
    refresh_table(fleet.weather, lake.location("bronze", "weather_data"), ts="timestamp")
    refresh_table(fleet.readings, lake.location("bronze", "solar_panel_readings"), ts="timestamp")
    refresh.refresh_silver(lake, AS_OF)
    refresh.refresh_gold(lake, AS_OF)
    day = date(2024, 1, 30)
    read = []
    build = daystates.production_states
    monkeypatch.setattr(daystates, "production_states", lambda solar: read.append(solar) or build(solar))
    refresh.refresh_gold(lake, AS_OF, [day])
    plan = read[0]._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "2024-01-30" in plan
    assert {r.d for r in read[0].select(F.to_date("timestamp").alias("d")).distinct().collect()} <= {day}
    monthly = lake.read("gold", "gold_monthly_kpis").drop("event_date", "month_start", "gold_ingestion_time")
    want = gold.monthly_kpis(lake.silver_solar).select(monthly.columns)
    assert sorted(map(tuple, monthly.collect())) == sorted(map(tuple, want.collect()))


def test_a_failed_refresh_leaves_the_table(spark, tmp_path):
    table = f"{tmp_path}/t"
    refresh_table(spark.range(3), table)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        refresh_table(broken, table)
    assert spark.read.parquet(table).count() == 3
    refresh_table(spark.read.parquet(table).where("id > 0"), table)  # reads what it replaces
    assert spark.read.parquet(table).count() == 2


def test_emptied_days_are_observed(spark, tmp_path):
    table = f"{tmp_path}/t"
    rows = spark.createDataFrame([(datetime(2024, 1, d), d) for d in (1, 2, 3)], "timestamp timestamp, v int")
    refresh_table(rows, table, ts="timestamp")
    refresh_days(rows.where("v = 2").withColumn("v", F.lit(9)), table, days=[date(2024, 1, 1), date(2024, 1, 2)])
    assert sorted(r.v for r in spark.read.parquet(table).collect()) == [3, 9]


def test_exact_panels_in_a_stream(spark, tmp_path):
    schema = "timestamp timestamp, panel_id string, production_kw double, is_valid boolean"
    rows = [(datetime(2024, 1, 1, h, m), f"p{(h * m) % 700}" if m else None, 1.0, True) for h in range(12) for m in range(60)]
    for i in range(3):
        spark.createDataFrame(rows[i * 240 : (i + 1) * 240], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    for _ in range(2):  # a restart adds nothing
        rollup.start_closed_windows(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = {r.window_start: tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    table = spark.createDataFrame(rows, schema)
    closed = rollup.live_windows(table).where("window_end <= timestamp '2024-01-01 10:59:00'")
    assert got == {r.window_start: tuple(r) for r in closed.select("window_start", "window_end", "readings", "active_panels", "total_production_kw", "peak_production_kw", "valid_readings").collect()}
    assert len(got) > 100
