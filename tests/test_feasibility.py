from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sunledger import constants as C
from sunledger.operators import climate, economics, energy, pv_yield, ranking
from sunledger.plans import feasibility
from sunledger.sources import tables


def year_of_hours(spark, year=2026):
    hours = spark.range(365 * 24).select(
        F.expr(f"timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '{year}-01-01 00:00:00')").alias("ts_local")
    )
    return hours.withColumn(
        "utc_offset_hours",
        (F.col("ts_local").cast("timestamp").cast("long") * 0 + F.when(F.month("ts_local").between(4, 10), 2).otherwise(1)).cast("double"),
    )


@pytest.fixture(scope="module")
def yields(spark):
    """A whole year under the climate normals."""
    weather = pv_yield.monthly_normals(year_of_hours(spark)).select(
        F.lit("Turin").alias("city"),
        "ts_local",
        "utc_offset_hours",
        F.col("temp_mean_c").alias("temperature"),
        F.col("humidity_pct").alias("humidity"),
        F.col("wind_speed_kmh").alias("wind_speed"),
        F.col("cloud_cover_pct").alias("cloudcover"),
    )
    return pv_yield.pv_yield(pv_yield.with_site(weather)).cache()


def at(yields, day, hour):
    return yields.where((F.col("date") == F.lit(day)) & (F.col("hour") == hour)).first()


def test_year_has_day_and_night(yields):
    winter, summer = date(2026, 1, 15), date(2026, 6, 15)
    assert yields.count() == 365 * 24
    assert at(yields, winter, 0).production_kw == 0
    assert at(yields, summer, 12).production_kw > at(yields, winter, 12).production_kw
    assert at(yields, summer, 12).solar_elevation_deg > at(yields, winter, 12).solar_elevation_deg
    annual = yields.agg(F.sum("production_kw")).first()[0]
    assert 2500 < annual < 5500


@pytest.fixture(scope="module")
def hours(spark, yields):
    return yields.select(
        F.lit("S1").alias("site_id"),
        F.col("timestamp").alias("ts_local"),
        "hourly_production_kwh",
        "temperature",
        "cloudcover",
        "ghi_wm2",
    ).cache()


def test_load_adds_up_to_the_annual_consumption(hours):
    total = energy.load_profile(hours).agg(F.sum("load_kwh")).first()[0]
    assert total == pytest.approx(2700, abs=0.01)


def test_balances_equal_the_hour_by_hour_sums(spark, hours):
    loaded = energy.load_profile(hours).cache()
    ours = {
        (r.size_kw, r.year): r
        for r in energy.yearly_balances(loaded, sizes=(2.0, 6.0), years=25).collect()
    }
    for size, year in ((2.0, 1), (6.0, 1), (2.0, 25), (6.0, 13)):
        produced = F.col("hourly_production_kwh") * size / 3 * 0.995 ** (year - 1)
        direct = loaded.agg(
            F.sum(produced).alias("p"),
            F.sum(F.least(produced, F.col("load_kwh"))).alias("s"),
            F.sum(F.greatest(F.lit(0.0), produced - F.col("load_kwh"))).alias("e"),
            F.sum(F.greatest(F.lit(0.0), F.col("load_kwh") - produced)).alias("i"),
        ).first()
        row = ours[(size, year)]
        assert row.annual_production_kwh == pytest.approx(direct.p)
        assert row.annual_self_consumed_kwh == pytest.approx(direct.s)
        assert row.annual_exported_kwh == pytest.approx(direct.e)
        assert row.annual_imported_kwh == pytest.approx(direct.i)


def test_flows_are_consistent(hours):
    flows = energy.energy_flows(energy.load_profile(hours))
    worst = flows.agg(
        F.max(F.abs(F.col("self_consumed_kwh") + F.col("grid_export_kwh") - F.col("system_hourly_kwh"))).alias("p"),
        F.max(F.abs(F.col("self_consumed_kwh") + F.col("grid_import_kwh") - F.col("load_kwh"))).alias("l"),
    ).first()
    assert worst.p < 2e-6 and worst.l < 2e-6
    assert energy.monthly_energy(flows).count() == 12


def golden_balances(spark, years=1):
    """First year of the published 3 kWp study."""
    rows = [("S", 3.0, y, 3947.809727, 1151.04628, 2699.999968, 2796.763447, 1548.953688) for y in range(1, years + 1)]
    return spark.createDataFrame(
        rows,
        "site_id STRING, size_kw DOUBLE, year INT, annual_production_kwh DOUBLE, "
        "annual_self_consumed_kwh DOUBLE, annual_load_kwh DOUBLE, annual_exported_kwh DOUBLE, "
        "annual_imported_kwh DOUBLE",
    )


def test_published_first_year(spark):
    flows = economics.cash_flow(golden_balances(spark)).orderBy("year").collect()
    assert [r.cash_flow for r in flows] == pytest.approx([-5400.0, 660.86467126])
    metrics = economics.scenario_metrics(economics.cash_flow(golden_balances(spark))).first()
    assert metrics.break_even_rate_euro_per_kwh == pytest.approx(0.12190965536)
    assert metrics.grid_cost_20_years_euro == pytest.approx(21765.003078)
    assert metrics.self_consumption_pct == pytest.approx(29.15657946)
    assert metrics.demand_coverage_pct == pytest.approx(42.63134421)
    assert metrics.payback_display == "No payback in analysis window"


# Published self-consumption (kWh) of years 1 to 25 for 3.0 kWp
PUBLISHED_SELF_CONSUMED = (
    1151.046280, 1150.111014, 1149.174468, 1148.227525, 1147.277550,
    1146.323459, 1145.363716, 1144.403443, 1143.435523, 1142.466539,
    1141.493432, 1140.515625, 1139.536529, 1138.558010, 1137.579587,
    1136.599738, 1135.613687, 1134.629365, 1133.636937, 1132.642368,
    1131.651192, 1130.657331, 1129.654713, 1128.645292, 1127.630655,
)


def test_published_study_of_the_current_system(spark):
    produced = [3947.809727 * 0.995**y for y in range(25)]
    rows = [
        ("S", 3.0, y + 1, p, s, 2699.999968, p - s, 2699.999968 - s)
        for y, (p, s) in enumerate(zip(produced, PUBLISHED_SELF_CONSUMED, strict=True))
    ]
    balances = spark.createDataFrame(rows, golden_balances(spark).schema)
    flows = economics.cash_flow(balances)
    yearly = {r.year: r.cash_flow for r in flows.collect()}
    assert yearly[2] == pytest.approx(683.0804234, abs=1e-4)
    assert yearly[12] == pytest.approx(-258.0553781, abs=1e-4)
    metrics = economics.scenario_metrics(flows).first()
    assert (metrics.payback_years, metrics.payback_display) == (8, "8 years")
    assert metrics.roi_20_years == pytest.approx(215.333810524, abs=1e-5)
    assert metrics.net_profit_20_years_euro == pytest.approx(11628.0257683, abs=1e-3)
    assert metrics.npv_25_years_euro == pytest.approx(12440.5540828, abs=1e-3)
    assert metrics.grid_cost_20_years_euro == pytest.approx(21765.0030781, abs=1e-3)
    (shown,) = economics.size_sensitivity(economics.scenario_metrics(flows)).collect()
    assert (shown.annual_production_kwh, shown.self_consumption_pct, shown.demand_coverage_pct) == (3947.8, 29.2, 42.6)
    assert (shown.installation_cost_euro, shown.payback_years, shown.npv_25_years_euro) == (5400.0, "8 years", 12441.0)


def test_inverter_year_and_monotone_payback(spark):
    flows = economics.cash_flow(golden_balances(spark, 25))
    rows = {r.year: r for r in flows.collect()}
    assert rows[12].cash_flow < rows[11].cash_flow
    metrics = economics.scenario_metrics(flows).first()
    assert rows[metrics.payback_years].cumulative >= 0 > rows[metrics.payback_years - 1].cumulative


def test_published_score(spark):
    row = spark.createDataFrame(
        [("S", 9, 152.87797949955564, 46.134784509745934, 15.776332360711107)],
        "site_id STRING, payback_years INT, roi_20_years DOUBLE, demand_coverage_pct DOUBLE, self_consumption_pct DOUBLE",
    )
    scored = economics.recommendation_score(row).first()
    assert (scored.score, scored.verdict) == (65, "RECOMMENDED")
    assert len(scored.strengths) == 3
    assert scored.concerns == ["Low self-consumption reduces financial efficiency"]


def test_no_payback_scores_nothing(spark):
    row = spark.createDataFrame(
        [("S", None, -1.0, 0.0, 0.0)],
        "site_id STRING, payback_years INT, roi_20_years DOUBLE, demand_coverage_pct DOUBLE, self_consumption_pct DOUBLE",
    )
    scored = economics.recommendation_score(row).first()
    assert (scored.score, scored.verdict, len(scored.concerns)) == (0, "NOT RECOMMENDED", 4)


def test_study_tables(hours):
    out = feasibility.study(hours)
    assert out["scenario_year"].count() == 8 * 26
    assert out["sensitivity"].count() == 8
    best = out["optimal_system"].first()
    assert best.npv_25_years_euro == max(
        r.npv_25_years_euro for r in out["scenario_metrics"].collect()
    )


def test_weights_are_normalised_and_complete():
    rows = ranking.choice_weights()
    assert len(rows) == 81
    for row in rows:
        assert sum(row[name] for name in ranking.CRITERIA) == pytest.approx(1)


def test_ranking_keeps_four_per_choice(hours):
    ranked = feasibility.ranked_choices(hours).collect()
    assert len(ranked) == 81 * 4
    lean = [r for r in ranked if r.budget == "lean" and r["rank"] == 1]
    assert all(r.outside_budget == 6 for r in lean)


@pytest.mark.parametrize(("years", "number"), [(7, 7.0), (12, 12.0), (None, 99.0)])
def test_payback_number(spark, years, number):
    df = spark.createDataFrame([(years,)], "t INT")
    assert df.select(ranking.payback_number(F.col("t"))).first()[0] == number


def test_panel_counts(spark):
    df = spark.createDataFrame([(0.1,), (3.0,), (4.5,), (0.45,)], "kw DOUBLE")
    counts = [r[0] for r in df.select(energy.panel_count(F.col("kw"))).collect()]
    assert counts == [1, 10, 15, 2]
    assert energy.roof_limit() == 11


# ----------------------------------------------------------- simple study, climate


def sample(spark):
    rows = [
        ("T", 2.0, 70, 3, 80, 0.1, datetime(2026, 2, 1, 12), date(2026, 2, 1), 12, 2, 0.4, 0.2, 1.0, 0.1, 0.08),
        ("T", 30.0, 60, 4, 20, 1.0, datetime(2026, 2, 2, 12), date(2026, 2, 2), 12, 2, 0.5, None, 1.0, None, 0.40),
        ("T", 5.0, 60, 4, 100, 0.0, datetime(2026, 2, 3, 12), date(2026, 2, 3), 12, 2, 0.5, 0.0, 1.0, 0.0, 0.0),
        ("T", 6.0, 60, 5, 21, 2.0, datetime(2026, 2, 4, 13), date(2026, 2, 4), 13, 2, 0.6, 1.0, 1.0, 2.0, 0.6),
    ]
    from sunledger.schemas import SITE_WEATHER_CSV

    return spark.createDataFrame(rows, SITE_WEATHER_CSV)


def test_simple_production_and_fallbacks(spark):
    out = {r.date.day: r.hourly_kwh for r in pv_yield.simple_production(sample(spark)).collect()}
    scale = 3.0 * 0.85 * 0.19 * 0.86
    assert out[1] == pytest.approx(0.4 * 0.2 * 0.1 * scale)
    assert out[2] == pytest.approx(0.5 * 0.8 * (1 - 5 * 0.004) * 0.1 * scale)
    assert out[3] == 0


def test_band_edges_count_twice_and_gaps_not(spark):
    rows = climate.band_histogram(sample(spark)).collect()
    uv = {r.band: r["count"] for r in rows if r.variable == "uv_index"}
    assert uv == {"low": 4, "moderate": 1, "high": 0}
    matches = climate.band_matches(sample(spark), "uv_index", C.UV_BANDS)
    assert matches.where("band = 'moderate'").count() == 1


def test_daily_extremes_without_ratio(spark):
    row = climate.daily_extremes(climate.daily_totals(sample(spark))).first()
    assert (row.best_day, row.worst_day) == (date(2026, 2, 4), date(2026, 2, 3))
    assert row.best_worst_ratio is None
    assert row.best_mean_ratio == pytest.approx(0.6 / 0.27)


@pytest.mark.parametrize(
    ("values", "kwh", "enough"),
    [
        ([5.0, 4.0, 1.0, 6.0], (2700 / 365 - 1) * 1.2, True),
        ([1.5, 1.0, 6.0], (2700 / 365 - 1) * 1.5, False),
        ([1.0, 2.0, 3.0], 2.0 * 1.5, None),  # the first day is the worst
        ([9.0, 8.0, 7.3, 8.5], 2.0, True),  # never below the smallest battery
    ],
)
def test_battery_sizing(spark, values, kwh, enough):
    days = spark.createDataFrame(
        [("T", date(2026, 2, 1) + timedelta(days=2 * i), v) for i, v in enumerate(values)],
        "city STRING, date DATE, value DOUBLE",
    )
    row = climate.battery_sizing(days).first()
    assert row.recommended_kwh == pytest.approx(kwh)
    assert row.sufficient is enough


def test_no_battery_without_production(spark):
    days = spark.createDataFrame([("T", date(2026, 2, 1), 0.0)], "city STRING, date DATE, value DOUBLE")
    assert climate.battery_sizing(days).count() == 0


def test_approximate_percentiles_are_close(spark):
    (row,) = (
        climate.approximate_percentiles(sample(spark), variables=("temperature",)).collect()
    )
    assert row.percentiles[0] == 2.0 and row.percentiles[-1] == 30.0


def test_seasonal_modes():
    assert economics.seasonal_factor() == pytest.approx(1.575)
    assert economics.seasonal_factor(mode="sum") == pytest.approx(18.9)
    with pytest.raises(ValueError, match="median"):
        economics.seasonal_factor(mode="median")


def test_best_share_takes_the_smaller_of_equal_ones(spark):
    totals = spark.createDataFrame([("S", 0.0, 28)], "site_id STRING, total_kwh DOUBLE, days INT")
    scenarios = economics.self_consumption_scenarios(totals)
    assert {r.payback_years for r in scenarios.collect()} == {float("inf")}
    assert economics.best_share(scenarios).first().self_consumption_pct == 20


def test_csv_round_trip(spark, tmp_path):
    location = f"{tmp_path}/csv"
    tables.write_csv(sample(spark), location)
    back = tables.read_site_weather_csv(spark, location)
    assert sorted(map(str, back.collect())) == sorted(map(str, sample(spark).collect()))


def test_json_result(spark, tmp_path):
    tables.write_json(spark.createDataFrame([(1, [2.5])], "a INT, b ARRAY<DOUBLE>"), f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first()[0] == '{"a":1,"b":[2.5]}'


def test_hours_without_a_known_production(spark):
    hours = spark.sql(
        "SELECT 'S' AS site_id, TIMESTAMP_NTZ '2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS ts_local, "
        "IF(id = 1, NULL, CAST(id AS DOUBLE)) AS hourly_production_kwh, 1D AS load_kwh FROM range(4)"
    )
    flows = {r.ts_local.hour: r for r in energy.energy_flows(hours).collect()}
    assert flows[1].self_consumed_kwh is None and flows[1].grid_import_kwh is None and flows[1].load_kwh == 1
    (year,) = energy.energy_balance(hours, sizes=[3.0]).collect()
    assert (year.annual_production_kwh, year.annual_self_consumed_kwh) == (5.0, 2.0)
    assert (year.annual_exported_kwh, year.annual_imported_kwh, year.annual_load_kwh) == (3.0, 1.0, 4.0)
    later = energy.yearly_balances(hours, sizes=[3.0], years=2).where("year = 2").first()
    assert later.annual_self_consumed_kwh == pytest.approx(2.0) and later.annual_load_kwh == 4.0
