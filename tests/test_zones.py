"""Wall clocks of real time zones."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from sunledger.operators import pv_yield

ZONES = ("Europe/Rome", "America/New_York", "Australia/Lord_Howe", "Asia/Kolkata", "UTC")
DAYS = [date(2026, m, d) for m, d in ((3, 8), (3, 29), (4, 5), (7, 1), (10, 4), (10, 25), (11, 1))]


@pytest.fixture(scope="module")
def hours(spark):
    sites = spark.createDataFrame([(z, z) for z in ZONES], "city string, timezone string")
    return pv_yield.wall_clock_hours(sites, DAYS).collect()


def test_every_day_has_24_hours(hours):
    per_day = {}
    for r in hours:
        per_day.setdefault((r.city, r.ts_local.date()), set()).add(r.ts_local.hour)
    assert set(per_day) == {(z, d) for z in ZONES for d in DAYS}
    assert all(found == set(range(24)) for found in per_day.values())


def test_offsets_follow_the_zone(hours):
    for r in hours:
        aware = r.ts_local.replace(tzinfo=ZoneInfo(r.timezone))
        there = aware.astimezone(timezone.utc).astimezone(aware.tzinfo).replace(tzinfo=None)
        if there == r.ts_local:  # a clock that summer time skips does not come back
            assert r.utc_offset_hours == aware.utcoffset() / timedelta(hours=1)
    rome = {r.ts_local: r.utc_offset_hours for r in hours if r.city == "Europe/Rome"}
    assert rome[datetime(2026, 3, 29, 1)] == rome[datetime(2026, 3, 29, 2)] == 1
    assert rome[datetime(2026, 3, 29, 3)] == rome[datetime(2026, 10, 25, 2)] == 2
    assert rome[datetime(2026, 10, 25, 3)] == 1


def test_missing_zone_and_no_days(spark):
    sites = spark.createDataFrame([("x", None)], "city string, timezone string")
    assert {r.utc_offset_hours for r in pv_yield.wall_clock_hours(sites, DAYS[:1]).collect()} == {None}
    assert pv_yield.wall_clock_hours(sites, []).count() == 0
