"""Oracles of climate statistics, production models, energy and economics.

The yearly balances are computed the long way round here: every hour times
every size times every year.
"""

from __future__ import annotations

from oracles.base import CTES, cte, mean, oracle

cte(
    "climate",
    "weather",
    """SELECT id, city, timestamp AS observation_time, CAST(timestamp AS DATE) AS date,
       extract(hour FROM timestamp) AS hour, CAST(temperature AS DOUBLE) AS temperature, humidity,
       CAST(wind_speed AS DOUBLE) AS wind_speed, cloud_cover AS cloudcover,
       CAST(uv_index AS DOUBLE) AS uv_index,
       round(greatest(0::DOUBLE, sin(pi() * (extract(hour FROM timestamp) - 6) / 12)), 4)
         AS solar_angle,
       CASE WHEN id % 2 = 0 THEN (1000 - 9 * cloud_cover) / 1000::DOUBLE END AS cloud_factor,
       CASE WHEN id % 3 <> 0 THEN CAST(uv_index AS DOUBLE) / 10 END AS uv_factor,
       round(round(greatest(0::DOUBLE, sin(pi() * (extract(hour FROM timestamp) - 6) / 12)), 4)
         * greatest(0, 100 - cloud_cover) / 100::DOUBLE, 6) AS solar_potential
       FROM weather""",
)
VARIABLES = ("temperature", "cloudcover", "uv_index", "wind_speed", "solar_angle", "solar_potential")
cte(
    "measured",
    "climate",
    " UNION ALL ".join(
        f"SELECT city, '{v}' AS variable, CAST({v} AS DOUBLE) AS value FROM climate"
        for v in VARIABLES
    ),
)


def dsum(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(38,12))) AS DOUBLE)"


def dmean(value: str) -> str:
    return f"({dsum(value)} / count({value}))"


oracle(
    "climate_summary",
    "measured",
    f"""SELECT city, variable, round({dmean('value')}, 6) AS mean, min(value) AS min,
    max(value) AS max, round(stddev_samp(value), 6) AS std, round({dsum('value')}, 6) AS sum,
    round(median(value), 6) AS median FROM measured GROUP BY city, variable""",
)
oracle(
    "climate_from_days",
    "measured",
    f"""SELECT city, variable, count(*) AS n, round({dmean('value')}, 6) AS mean, min(value) AS min,
    max(value) AS max, round(stddev_samp(value), 6) AS std, TRUE AS p10_within, TRUE AS p50_within,
    TRUE AS p90_within FROM measured WHERE value IS NOT NULL GROUP BY city, variable""",
)
oracle(
    "climate_percentiles",
    "measured",
    "SELECT city, variable, "
    + ", ".join(
        f"round(quantile_cont(value, {p}), 6) AS p{round(p * 100)}"
        for p in (0, 0.1, 0.25, 0.5, 0.75, 0.9, 1)
    )
    + " FROM measured GROUP BY city, variable",
)
cte(
    "bands",
    "",
    """SELECT * FROM (VALUES
    ('cloudcover', 'clear_sky', 0::DOUBLE, 20::DOUBLE, 'Minimal clouds'),
    ('cloudcover', 'partly_cloudy', 21, 60, 'Moderate clouds'),
    ('cloudcover', 'cloudy', 61, 100, 'Heavy clouds'),
    ('uv_index', 'low', 0, 2, 'Minimal radiation'),
    ('uv_index', 'moderate', 2, 5, 'Good radiation'),
    ('uv_index', 'high', 5, 15, 'Intense radiation'),
    ('wind_speed', 'calm', 0, 5, 'Minimal wind'),
    ('wind_speed', 'light', 5, 20, 'Good cooling'),
    ('wind_speed', 'moderate', 20, 40, 'Strong cooling'),
    ('wind_speed', 'strong', 40, 200, 'Structural concern'))
    AS t(variable, band, band_min, band_max, description)""",
)
oracle(
    "band_histogram",
    "measured bands",
    """SELECT c.city, b.*, count(m.value) AS count,
    CAST(count(m.value) AS DOUBLE) / any_value(c.n) * 100 AS percentage
    FROM (SELECT city, count(*) AS n FROM climate GROUP BY city) c CROSS JOIN bands b
    LEFT JOIN measured m ON m.city = c.city AND m.variable = b.variable
      AND m.value BETWEEN b.band_min AND b.band_max GROUP BY ALL""",
)
oracle(
    "band_matches",
    "climate bands",
    """SELECT id, city, uv_index, band, band_min, band_max, description FROM climate
    JOIN bands ON variable = 'uv_index' AND uv_index BETWEEN band_min AND band_max""",
)
cte(
    "observed_bands",
    "weather",
    """SELECT city, CAST(CAST(timestamp AS DATE) AS VARCHAR) || ' '
      || lpad(CAST(extract(hour FROM timestamp) AS VARCHAR), 2, '0') AS band,
    CASE WHEN extract(hour FROM timestamp) > 0 THEN min(CAST(temperature AS DOUBLE)) END AS band_min,
    CASE WHEN extract(hour FROM timestamp) < 23 THEN max(CAST(temperature AS DOUBLE)) END AS band_max
    FROM weather GROUP BY city, CAST(timestamp AS DATE), extract(hour FROM timestamp)""",
)
oracle(
    "band_table_counts",
    "weather observed_bands",
    """SELECT b.city, b.band, b.band_min, b.band_max, count(w.id) AS count FROM observed_bands b
    LEFT JOIN weather w ON w.city = b.city
      AND CAST(w.temperature AS DOUBLE) >= coalesce(b.band_min, CAST('-infinity' AS DOUBLE))
      AND CAST(w.temperature AS DOUBLE) <= coalesce(b.band_max, CAST('infinity' AS DOUBLE))
    GROUP BY ALL""",
)
oracle(
    "band_table_matches",
    "weather observed_bands",
    """SELECT w.id, count(*) AS bands, min(b.band) AS first_band, max(b.band) AS last_band
    FROM weather w JOIN observed_bands b ON b.city = w.city
      AND CAST(w.temperature AS DOUBLE) BETWEEN b.band_min AND b.band_max
    WHERE b.band_max - b.band_min BETWEEN 0 AND 5 GROUP BY w.id""",
)
oracle(
    "predicate_share",
    "climate",
    """SELECT *, n1::DOUBLE / total_hours * 100 AS clear_pct,
    n2::DOUBLE / total_hours * 100 AS cloudy_pct, n3::DOUBLE / total_hours * 100 AS uv_positive_pct,
    n4::DOUBLE / total_hours * 100 AS zero_potential_pct, n5::DOUBLE / total_hours * 100
    AS uv_zero_pct FROM (SELECT city, count(*) AS total_hours,
    count(*) FILTER (WHERE cloudcover <= 20) AS n1, count(*) FILTER (WHERE cloudcover > 60) AS n2,
    count(*) FILTER (WHERE uv_index > 0) AS n3, count(*) FILTER (WHERE solar_potential = 0) AS n4,
    count(*) - count(*) FILTER (WHERE uv_index > 0) AS n5 FROM climate GROUP BY city)""".replace(
        "SELECT *,",
        "SELECT city, total_hours, n1 AS clear_hours, n2 AS cloudy_hours, n3 AS uv_positive_hours,"
        " n4 AS zero_potential_hours, n5 AS uv_zero_hours,",
    ),
)
cte(
    "days",
    "climate",
    f"""SELECT city, date, {dsum('solar_potential')} AS value, {dmean('cloudcover')} AS cloud,
    {dmean('temperature')} AS temp, count(*) FILTER (WHERE solar_potential > 0) AS productive,
    row_number() OVER (PARTITION BY city ORDER BY date) AS position FROM climate
    GROUP BY city, date""",
)


def extremes(value: str) -> str:
    return f"""SELECT d.city, count(*) AS days, round(avg({value}), 6) AS mean_of_days,
    (SELECT date FROM days x WHERE x.city = d.city ORDER BY {value} DESC, date LIMIT 1) AS best_day,
    round(max({value}), 6) AS best_value,
    (SELECT date FROM days x WHERE x.city = d.city ORDER BY {value}, date LIMIT 1) AS worst_day,
    round(min({value}), 6) AS worst_value,
    round(CASE WHEN min({value}) > 0 THEN max({value}) / min({value}) END, 6) AS best_worst_ratio,
    round(CASE WHEN min({value}) <= 0 AND avg({value}) > 0 THEN max({value}) / avg({value}) END, 6)
      AS best_mean_ratio FROM days d GROUP BY d.city"""


oracle("daily_extremes", "days", extremes("value"))
oracle("daily_cloud_extremes", "days", extremes("cloud"))
oracle(
    "hour_profile",
    "climate",
    f"SELECT city, hour, {dmean('solar_potential')} AS mean_value FROM climate GROUP BY city, hour",
)
oracle(
    "hour_extremes",
    "climate",
    f"""SELECT city, (arg_max(hour, (v, -hour))) AS peak_hour, max(v) AS peak_value,
    arg_min(hour, (v, hour)) AS lowest_hour, min(v) AS lowest_value,
    CAST(sum(p) AS BIGINT) AS productive_hours,
    CAST(sum(p) AS DOUBLE) / any_value(n) AS productive_hours_per_day
    FROM (SELECT city, hour, {dmean('solar_potential')} AS v,
      count(*) FILTER (WHERE solar_potential > 0) AS p FROM climate GROUP BY city, hour)
    JOIN (SELECT city, count(DISTINCT date) AS n FROM climate GROUP BY city) USING (city)
    GROUP BY city""",
)
oracle(
    "worst_day_conditions",
    "climate days",
    """SELECT h.city, h.date AS worst_hour_date, h.hour AS worst_hour,
    h.solar_potential AS worst_hour_potential, CAST(h.cloudcover AS BIGINT)
      AS worst_hour_cloudcover, h.temperature AS worst_hour_temperature,
    h.uv_index AS worst_hour_uv_index, h.wind_speed AS worst_hour_wind_speed,
    d.date AS worst_day, d.value AS worst_day_potential, d.cloud AS worst_day_cloudcover,
    d.temp AS worst_day_temperature, d.productive AS worst_day_productive_hours
    FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY solar_potential,
      observation_time) AS r FROM climate) h
    JOIN (SELECT *, row_number() OVER (PARTITION BY city ORDER BY value, date) AS r FROM days) d
      ON d.city = h.city WHERE h.r = 1 AND d.r = 1""",
)
oracle(
    "battery_sizing",
    "days",
    """SELECT city, round(avg_daily, 6) AS avg_daily, date AS worst_day,
    round(value, 6) AS worst_day_kwh, position, days_before, round(total_before, 6) AS total_before,
    round(needed, 6) AS energy_needed, round(stored, 6) AS stored_energy,
    stored >= needed AS sufficient, round(kwh, 6) AS recommended_kwh,
    round(kwh * 0.9::DOUBLE, 6) AS usable_kwh, round(kwh * 450, 6) AS estimated_cost,
    10 AS lifetime_years FROM (SELECT *, CASE WHEN position = 1 THEN avg_daily * 1.5::DOUBLE ELSE
      greatest(2::DOUBLE, needed * CASE WHEN stored >= needed THEN 1.2::DOUBLE ELSE 1.5::DOUBLE END)
      END AS kwh FROM (SELECT w.city, w.date, w.value, w.position, a.avg_daily, b.days_before,
        b.total_before, CASE WHEN w.position > 1 THEN greatest(0::DOUBLE, 2700::DOUBLE / 365 - w.value)
        END AS needed, CASE WHEN w.position > 1 THEN b.total_before * 0.9::DOUBLE END AS stored
      FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY value, date) AS r FROM days) w
      JOIN (SELECT city, avg(value) AS avg_daily FROM days GROUP BY city) a ON a.city = w.city,
      LATERAL (SELECT count(*) AS days_before, coalesce(sum(p.value), 0) AS total_before FROM days p
        WHERE p.city = w.city AND p.position BETWEEN w.position - 3 AND w.position - 1) b
      WHERE w.r = 1 AND a.avg_daily > 0))""",
)
cte(
    "produced",
    "climate",
    """SELECT *, greatest(0::DOUBLE, 3.0::DOUBLE * (solar_angle
      * coalesce(cloud_factor, greatest(0.1::DOUBLE, least(1::DOUBLE, 1 - cloudcover / 100::DOUBLE)))
      * CASE WHEN temperature > 25 THEN 1 - (temperature - 25) * 0.004::DOUBLE ELSE 1 END
      * coalesce(uv_factor, least(1::DOUBLE, uv_index / 10)) * 0.85::DOUBLE)
      * 0.19::DOUBLE * (1 - 0.14::DOUBLE)) AS hourly_kwh FROM climate""",
)
oracle(
    "simple_production",
    "produced",
    "SELECT id, city, observation_time, round(hourly_kwh, 6) AS hourly_kwh FROM produced",
)

# ------------------------------------------------------------- physical model

cte(
    "sun",
    "weather",
    """SELECT w.*, s.*, timestamp + INTERVAL 1 HOUR AS t, least(cloud_cover, 100) AS cloud
    FROM weather w JOIN (VALUES ('Turin', 45.0703::DOUBLE, 7.6869::DOUBLE, 35::DOUBLE, 0::DOUBLE),
      ('Milan', 45.4642, 9.19, 30, 0), ('Rome', 41.9028, 12.4964, 35, 15))
      AS s(name, lat, lon, tilt, face) ON s.name = w.city""",
)
cte(
    "sun1",
    "sun",
    """SELECT *, dayofyear(t) AS n, radians(lat) AS la, radians(tilt) AS ti, radians(face) AS fa,
    radians(360::DOUBLE / 364 * (dayofyear(t) - 81)) AS b,
    radians(23.45::DOUBLE * sin(radians(360::DOUBLE * (284 + dayofyear(t)) / 365))) AS de,
    extract(hour FROM t) + extract(minute FROM t) / 60::DOUBLE
      + floor(extract(second FROM t)) / 3600::DOUBLE AS h FROM sun""",
)
cte(
    "sun2",
    "sun1",
    """SELECT *, sin(la) * sin(de) + cos(la) * cos(de) * cos(ha) AS cz FROM (
    SELECT *, radians(15 * (h + (4 * (lon - 15) + 9.87::DOUBLE * sin(2 * b)
      - 7.53::DOUBLE * cos(b) - 1.5::DOUBLE * sin(b)) / 60 - 12)) AS ha FROM sun1)""",
)
cte(
    "sun3",
    "sun2",
    """SELECT *, 90 - degrees(acos(cz)) AS el,
    degrees(atan2(-sin(ha) * cos(de),
      (sin(de) * cos(la) - cos(de) * sin(la) * cos(ha)) / greatest(cz, 1e-6))) + 180 AS az,
    greatest(0::DOUBLE, sin(radians(greatest(90 - degrees(acos(cz)), 0)))) AS sf FROM sun2""",
)
cte(
    "sun4",
    "sun3",
    """SELECT *, CASE WHEN sf > 0 THEN 1098 * sf * exp(-0.059::DOUBLE / sf) ELSE 0 END AS clear,
    greatest(0.16::DOUBLE, least(1, 1 - 0.72::DOUBLE * pow(cloud / 100::DOUBLE, 3.2))) AS tr,
    greatest(0.82::DOUBLE, least(1, 1 - (humidity - 55) / 230::DOUBLE)) AS hz,
    CASE WHEN sf > 0 THEN round(greatest(0, least(10.5::DOUBLE, 11 * pow(sf, 1.25)
      * (1 - 0.55::DOUBLE * pow(cloud / 100::DOUBLE, 2.2)))), 1) ELSE 0 END AS uv,
    greatest(0::DOUBLE, sin(de) * sin(la) * cos(ti) - sin(de) * cos(la) * sin(ti) * cos(fa)
      + cos(de) * cos(la) * cos(ti) * cos(ha) + cos(de) * sin(la) * sin(ti) * cos(fa) * cos(ha)
      + cos(de) * sin(ti) * sin(fa) * sin(ha)) AS ci,
    greatest(0.18::DOUBLE, least(0.72::DOUBLE, 0.22::DOUBLE + 0.42::DOUBLE * cloud / 100)) AS df
    FROM sun3""",
)
cte(
    "sun5",
    "sun4",
    """SELECT *, CASE WHEN sf > 0 AND g > 0 THEN g * (1 - df) * ci / greatest(sf, 1e-6)
      + g * df * (1 + cos(ti)) / 2 + g * 0.2::DOUBLE * (1 - cos(ti)) / 2 ELSE 0 END AS poa
    FROM (SELECT *, clear * tr * hz AS g FROM sun4)""",
)
cte(
    "sun6",
    "sun5",
    """SELECT *, 3::DOUBLE * poa / 1000 * 0.85::DOUBLE * 0.84::DOUBLE * ef AS kw FROM (
    SELECT *, CASE WHEN cell <= 25 THEN 1 ELSE greatest(0, 1 - (cell - 25) * 0.004::DOUBLE) END AS ef
    FROM (SELECT *, CAST(temperature AS DOUBLE) + 25 / 800::DOUBLE * poa AS cell FROM sun5))""",
)
oracle(
    "pv_yield",
    "sun6",
    """SELECT id, city, t AS timestamp, CAST(t AS DATE) AS date, extract(hour FROM t) AS hour,
    extract(month FROM t) AS month, n AS day_of_year, CAST(sf > 0 AS BIGINT) AS is_daylight,
    CAST(temperature AS DOUBLE) AS temperature, CAST(humidity AS BIGINT) AS humidity,
    CAST(wind_speed AS DOUBLE) AS wind_speed, CAST(cloud AS BIGINT) AS cloudcover,
    uv AS uv_index, round(el, 3) AS solar_elevation_deg, round(az - 360 * floor(az / 360), 3)
      AS solar_azimuth_deg, round(sf, 6) AS solar_angle, round(tr, 6)
      AS cloud_factor, round(ef, 6) AS temp_efficiency,
    round(least(1, uv / 10), 6) AS uv_factor, round(clear, 2) AS clear_sky_ghi_wm2,
    round(g, 2) AS ghi_wm2, round(poa, 2) AS poa_irradiance_wm2,
    round(cell, 2) AS cell_temperature_c, round(kw, 6) AS production_kw,
    round(kw, 6) AS hourly_production_kwh, round(kw, 6) AS solar_potential
    FROM sun6""",
)
# the same model by wall clock: the offset of every hour instead of the fixed one
cte(
    "zone",
    "weather",
    f"""SELECT w.*, s.*, d + h * INTERVAL 1 HOUR AS t,
    CASE WHEN d + h * INTERVAL 1 HOUR >= TIMESTAMP '2026-03-29 03:00:00'
      AND d + h * INTERVAL 1 HOUR < TIMESTAMP '2026-10-25 03:00:00' THEN 2 ELSE 1 END AS off
    FROM (SELECT city, {mean('CAST(temperature * 100 AS BIGINT)', 100)} AS temperature,
      {mean('humidity', 1)} AS humidity, {mean('least(cloud_cover, 100)', 1)} AS cloud
      FROM weather GROUP BY city) w
    JOIN (VALUES ('Turin', 45.0703::DOUBLE, 7.6869::DOUBLE, 35::DOUBLE, 0::DOUBLE),
      ('Milan', 45.4642, 9.19, 30, 0), ('Rome', 41.9028, 12.4964, 35, 15))
      AS s(name, lat, lon, tilt, face) ON s.name = w.city
    CROSS JOIN (SELECT unnest([TIMESTAMP '2026-03-28', TIMESTAMP '2026-03-29', TIMESTAMP '2026-03-30',
      TIMESTAMP '2026-10-24', TIMESTAMP '2026-10-25', TIMESTAMP '2026-10-26']) AS d)
    CROSS JOIN (SELECT unnest(range(24)) AS h)""",
)
for _i in range(1, 7):
    _body = CTES[f"sun{_i}"][1].replace("FROM sun", "FROM zone").replace("(lon - 15)", "(lon - 15 * off)")
    cte(f"zone{_i}", "zone" if _i == 1 else f"zone{_i - 1}", _body)
oracle(
    "zone_yield",
    "zone6",
    """SELECT city, t AS timestamp, CAST(off AS DOUBLE) AS utc_offset_hours, round(el, 3) AS solar_elevation_deg,
    round(az - 360 * floor(az / 360), 3) AS solar_azimuth_deg, round(g, 2) AS ghi_wm2,
    round(kw, 6) AS production_kw FROM zone6""",
)
NORMALS = {
    "temp_mean_c": "2.8, 4.7, 8.9, 12.8, 17.2, 21.1, 23.9, 23.3, 19.2, 13.7, 8.0, 3.7",
    "temp_min_c": "-0.6, 0.5, 3.8, 7.5, 11.8, 15.7, 18.4, 18.0, 14.4, 9.2, 4.0, 0.3",
    "temp_max_c": "6.3, 9.0, 14.0, 18.0, 22.7, 26.8, 29.8, 29.2, 24.2, 18.1, 11.8, 6.8",
    "humidity_pct": "80, 76, 71, 69, 70, 68, 67, 69, 74, 78, 82, 83",
    "cloud_cover_pct": "61, 56, 52, 51, 54, 46, 36, 38, 45, 54, 60, 63",
    "wind_speed_kmh": "7.8, 7.6, 8.1, 8.0, 7.2, 6.5, 6.0, 5.8, 6.1, 6.4, 6.8, 7.2",
}
oracle(
    "monthly_normals",
    "weather",
    "SELECT id, timestamp AS ts_local, "
    + ", ".join(
        f"round((1 - f) * (CAST([{v}] AS DOUBLE[]))[m] + f * (CAST([{v}] AS DOUBLE[]))[m % 12 + 1], 6)"
        f" AS {n}"
        for n, v in NORMALS.items()
    )
    + """ FROM (SELECT *, extract(month FROM timestamp) AS m, (extract(day FROM timestamp) - 1
      + extract(hour FROM timestamp) / 24::DOUBLE) / extract(day FROM last_day(timestamp)) AS f
      FROM weather)""",
)
oracle(
    "expected_vs_actual",
    "sun6 scaled",
    f"""SELECT coalesce(e.city, a.city) AS city, coalesce(e.hour, a.hour) AS hour,
    e.kw AS expected_kw, a.kw AS actual_kw, CASE WHEN e.kw <> 0 THEN a.kw / e.kw END AS ratio
    FROM (SELECT city, date_trunc('hour', t) AS hour, {dmean('round(kw, 6)')} AS kw FROM sun6
      GROUP BY ALL) e
    FULL JOIN (SELECT city, date_trunc('hour', timestamp) AS hour, {mean('p_m', 1000)} AS kw FROM scaled
      GROUP BY ALL) a ON a.city = e.city AND a.hour = e.hour""",
)

# ---------------------------------------------------------- energy, economics

cte(
    "metered_hours",
    "raw",
    """SELECT 'SITE-' || lpad(CAST(site AS VARCHAR), 4, '0') AS site_id, hour AS ts_local,
    CAST(sum(milli) AS DOUBLE) / 1000 / nullif(count(milli), 0) AS avg_kw,
    CAST(sum(k) AS DOUBLE) / count(*) - 25 AS temperature,
    CAST(sum((k * 13) % 104) AS DOUBLE) / count(*) AS cloudcover
    FROM (SELECT user_id // 15 AS site, date_trunc('hour', ts) AS hour, k,
        CASE WHEN event_id % 499 = 498 THEN NULL
             ELSE CAST(CAST(greatest(120 - value, 0) AS DECIMAL(8,3)) * 1000 AS BIGINT) END AS milli
      FROM raw) GROUP BY site, hour""",
)
cte(
    "site_hours",
    "metered_hours",
    """SELECT site_id, ts_local, avg_kw / 37 AS p,
    temperature, cloudcover, avg_kw * 7 AS ghi
    FROM metered_hours""",
)
cte(
    "loads",
    "site_hours",
    """SELECT *, round(w * 2700 / sum(w) OVER (PARTITION BY site_id, extract(year FROM ts_local)), 6)
    AS l FROM (SELECT *, (0.18::DOUBLE + 0.55::DOUBLE * exp(-pow(h - 7.5, 2) / (2 * 1.7 * 1.7))
      + 0.85::DOUBLE * exp(-pow(h - 19.5, 2) / (2 * 2.6 * 2.6))
      + 0.16::DOUBLE * exp(-pow(h - 13, 2) / (2 * 2.8 * 2.8))
      + CASE WHEN isodow(ts_local) >= 6 AND h BETWEEN 10 AND 16 THEN 0.06 ELSE 0 END)
      * (1 + 0.1::DOUBLE * cos(2 * pi() * (dayofyear(ts_local) - 15) / 365)) AS w
    FROM (SELECT *, CAST(extract(hour FROM ts_local) AS DOUBLE) AS h FROM site_hours))""",
)
oracle("load_profile", "loads", "SELECT site_id, ts_local, l AS load_kwh FROM loads")
cte(
    "flows",
    "loads",
    """SELECT *, round(p, 6) AS sys,
    CASE WHEN p IS NOT NULL THEN round(least(p, l), 6) END AS self,
    CASE WHEN p IS NOT NULL THEN round(greatest(0, p - l), 6) END AS ex,
    CASE WHEN p IS NOT NULL THEN round(greatest(0, l - p), 6) END AS im FROM loads""",
)
oracle(
    "energy_flows",
    "flows",
    """SELECT site_id, ts_local, l AS load_kwh, sys AS system_hourly_kwh, self AS self_consumed_kwh,
    ex AS grid_export_kwh, im AS grid_import_kwh FROM flows""",
)
cte("sizes", "", "SELECT unnest([2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 6.0])::DOUBLE AS size_kw")
cte(
    "balances",
    "loads sizes",
    """SELECT site_id, size_kw, y, coalesce(CAST(sum(CAST(q AS DECIMAL(38,16))) AS DOUBLE), 0) AS prod,
    coalesce(CAST(sum(CAST(least(q, l) AS DECIMAL(38,16))) FILTER (WHERE q IS NOT NULL) AS DOUBLE), 0) AS self,
    coalesce(CAST(sum(CAST(greatest(0, q - l) AS DECIMAL(38,16))) FILTER (WHERE q IS NOT NULL) AS DOUBLE), 0) AS ex,
    coalesce(CAST(sum(CAST(greatest(0, l - q) AS DECIMAL(38,16))) FILTER (WHERE q IS NOT NULL) AS DOUBLE), 0) AS im,
    CAST(sum(CAST(l AS DECIMAL(38,16))) AS DOUBLE) AS load FROM (
      SELECT site_id, size_kw, y, l, p * size_kw / 3 * pow(0.995::DOUBLE, y - 1) AS q
      FROM loads, sizes, (SELECT unnest(range(1, 26)) AS y)) GROUP BY ALL""",
)
PCTS = """CASE WHEN prod <> 0 THEN self / prod * 100 ELSE 0 END AS self_pct,
    CASE WHEN load <> 0 THEN self / load * 100 ELSE 0 END AS demand_pct,
    CASE WHEN load <> 0 THEN prod / load * 100 ELSE 0 END AS prod_pct"""
oracle(
    "energy_balance",
    "balances",
    f"""SELECT site_id, size_kw, round(prod, 6) AS annual_production_kwh,
    round(self, 6) AS annual_self_consumed_kwh, round(ex, 6) AS annual_exported_kwh,
    round(im, 6) AS annual_imported_kwh, round(load, 6) AS annual_load_kwh,
    round(self_pct, 6) AS self_consumption_pct, round(demand_pct, 6) AS demand_coverage_pct,
    round(prod_pct, 6) AS production_coverage_pct
    FROM (SELECT *, {PCTS} FROM balances WHERE y = 1)""",
)
cte(
    "months",
    "flows",
    """SELECT site_id, extract(month FROM ts_local) AS month,
    round(avg(temperature), 2) AS avg_temperature_c, round(avg(cloudcover), 1)
      AS avg_cloud_cover_pct, round(avg(ghi), 1) AS avg_ghi_wm2, round(sum(sys), 1)
      AS production_kwh, round(sum(l), 1) AS load_kwh, round(sum(self), 1) AS self_consumed_kwh,
    round(sum(ex), 1) AS grid_export_kwh, round(sum(im), 1) AS grid_import_kwh
    FROM flows GROUP BY ALL""",
)
oracle("monthly_energy", "months", "SELECT * FROM months")
oracle(
    "month_extremes",
    "months",
    """SELECT site_id, arg_max(month, (production_kwh, -month)) AS best_month,
    max(production_kwh) AS best_month_kwh, arg_min(month, (production_kwh, month)) AS weakest_month,
    min(production_kwh) AS weakest_month_kwh FROM months GROUP BY site_id""",
)
cte(
    "years",
    "balances",
    """SELECT *, sum(cf) OVER (PARTITION BY site_id, size_kw ORDER BY y) AS cum,
    cf / pow(1.02::DOUBLE, y) AS disc FROM (
      SELECT site_id, size_kw, y, prod, self, ex, im, load,
        self * 0.30::DOUBLE * pow(1.03::DOUBLE, y - 1) + ex * 0.10::DOUBLE * pow(1.03::DOUBLE, y - 1)
        + least(ex, im) * 0.12::DOUBLE * pow(1.03::DOUBLE, y - 1) - 150
        - CASE WHEN y = 12 THEN 1200 ELSE 0 END AS cf FROM balances
      UNION ALL SELECT DISTINCT site_id, size_kw, 0, NULL, NULL, NULL, NULL, NULL, -1800 * size_kw
      FROM balances)""",
)
oracle(
    "cash_flow",
    "years",
    """SELECT site_id, size_kw, y AS year, round(prod, 6) AS annual_production_kwh,
    round(self, 6) AS annual_self_consumed_kwh, round(ex, 6) AS annual_exported_kwh,
    round(im, 6) AS annual_imported_kwh, round(load, 6) AS annual_load_kwh,
    round(cf, 6) AS cash_flow, round(cum, 6) AS cumulative, round(disc, 6) AS discounted
    FROM years""",
)
cte(
    "scenarios",
    "years",
    f"""SELECT *, {PCTS}, profit / cost * 100 AS roi,
    CASE WHEN self > 0 THEN greatest(0, (150 + cost / 20 - ex * 0.1::DOUBLE) / self)
      ELSE 'inf'::DOUBLE END AS break_even,
    coalesce(payback || ' years', 'No payback in analysis window') AS shown FROM (
    SELECT site_id, size_kw, 1800 * size_kw AS cost,
    max(prod) FILTER (WHERE y = 1) AS prod, max(self) FILTER (WHERE y = 1) AS self,
    max(ex) FILTER (WHERE y = 1) AS ex, max(im) FILTER (WHERE y = 1) AS im,
    max(load) FILTER (WHERE y = 1) AS load, min(y) FILTER (WHERE y > 0 AND cum >= 0) AS payback,
    sum(cf) FILTER (WHERE y BETWEEN 1 AND 20) AS benefit, max(cum) FILTER (WHERE y = 20) AS profit,
    sum(disc) AS npv FROM years GROUP BY site_id, size_kw)""",
)
cte(
    "scenarios_named",
    "scenarios",
    """SELECT site_id, size_kw AS panel_size_kw, round(cost, 6) AS installation_cost_euro,
    round(prod, 6) AS annual_production_kwh, round(self, 6) AS annual_self_consumed_kwh,
    round(ex, 6) AS annual_exported_kwh, round(im, 6) AS annual_imported_kwh,
    round(load, 6) AS annual_load_kwh, payback AS payback_years, shown AS payback_display,
    round(self_pct, 6) AS self_consumption_pct, round(demand_pct, 6) AS demand_coverage_pct,
    round(prod_pct, 6) AS production_coverage_pct, round(roi, 6) AS roi_20_years,
    round(profit, 6) AS net_profit_20_years_euro, round(benefit, 6) AS total_benefit_20_years_euro,
    round(npv, 6) AS npv_25_years_euro, round(load * 0.3::DOUBLE
      * (SELECT sum(pow(1.03::DOUBLE, i)) FROM (SELECT unnest(range(0, 20)) AS i)), 6)
      AS grid_cost_20_years_euro, round(profit, 6) AS net_benefit_vs_grid_20_years_euro,
    round(break_even, 6) AS break_even_rate_euro_per_kwh,
    row_number() OVER (PARTITION BY site_id ORDER BY npv DESC, coalesce(-payback, -999) DESC,
      size_kw) AS place FROM scenarios""",
)
oracle("scenario_metrics", "scenarios_named", "SELECT * EXCLUDE (place) FROM scenarios_named")
oracle(
    "optimal_size",
    "scenarios_named",
    "SELECT * EXCLUDE (place) FROM scenarios_named WHERE place = 1",
)
cte(
    "sensitivity",
    "scenarios",
    """SELECT site_id, size_kw AS panel_size_kw, round_even(prod, 1) AS annual_production_kwh,
    round_even(self_pct, 1) AS self_consumption_pct, round_even(demand_pct, 1)
      AS demand_coverage_pct, round_even(cost, 0) AS installation_cost_euro,
    shown AS payback_years, round_even(npv, 0) AS npv_25_years_euro FROM scenarios""",
)
oracle("size_sensitivity", "sensitivity", "SELECT * FROM sensitivity")
VERDICT = """CASE WHEN score >= 80 THEN 'HIGHLY RECOMMENDED' WHEN score >= 60 THEN 'RECOMMENDED'
    WHEN score >= 40 THEN 'CONSIDER WITH CAUTION' ELSE 'NOT RECOMMENDED' END AS verdict"""
oracle(
    "recommendation_score",
    "scenarios",
    f"""SELECT site_id, size_kw AS panel_size_kw, score, {VERDICT},
    concat_ws('; ',
      CASE WHEN payback <= 7 THEN 'Fast payback for a residential PV system'
        WHEN payback <= 10 THEN 'Healthy payback within a typical asset horizon'
        WHEN payback <= 13 THEN 'Acceptable payback' END,
      CASE WHEN roi >= 150 THEN 'Strong 20-year ROI' WHEN roi >= 100 THEN 'Solid 20-year ROI'
        WHEN roi >= 50 THEN 'Positive long-term return' END,
      CASE WHEN demand_pct >= 70 THEN 'Covers most of the household demand directly'
        WHEN demand_pct >= 55 THEN 'Good direct demand coverage'
        WHEN demand_pct >= 40 THEN 'Meaningful reduction in grid purchases' END,
      CASE WHEN self_pct >= 60 THEN 'High self-consumption keeps exported energy limited'
        WHEN self_pct >= 45 THEN 'Balanced self-consumption profile' END) AS strengths,
    concat_ws('; ',
      CASE WHEN payback <= 13 THEN NULL WHEN payback <= 16 THEN 'Payback is on the long side'
        ELSE 'No payback within the analysis window' END,
      CASE WHEN roi >= 50 THEN NULL WHEN roi > 0 THEN 'ROI is positive but modest'
        ELSE 'Negative 20-year ROI' END,
      CASE WHEN demand_pct >= 40 THEN NULL WHEN demand_pct >= 25
        THEN 'Only partial demand coverage' ELSE 'Low direct demand coverage' END,
      CASE WHEN self_pct >= 45 THEN NULL WHEN self_pct >= 30
        THEN 'A notable share of production is exported'
        ELSE 'Low self-consumption reduces financial efficiency' END) AS concerns
    FROM (SELECT *,
      CASE WHEN payback <= 7 THEN 35 WHEN payback <= 10 THEN 28 WHEN payback <= 13 THEN 18
        WHEN payback <= 16 THEN 8 ELSE 0 END
      + CASE WHEN roi >= 150 THEN 25 WHEN roi >= 100 THEN 20 WHEN roi >= 50 THEN 14
        WHEN roi > 0 THEN 8 ELSE 0 END
      + CASE WHEN demand_pct >= 70 THEN 20 WHEN demand_pct >= 55 THEN 16 WHEN demand_pct >= 40
        THEN 12 WHEN demand_pct >= 25 THEN 6 ELSE 0 END
      + CASE WHEN self_pct >= 60 THEN 20 WHEN self_pct >= 45 THEN 16 WHEN self_pct >= 30 THEN 10
        ELSE 0 END AS score FROM scenarios)""",
)
oracle(
    "panel_count",
    "scenarios_named",
    """SELECT site_id, panel_size_kw, greatest(1, CAST(floor(panel_size_kw / 0.3::DOUBLE + 0.5)
    AS BIGINT)) AS panels, 11 AS roof_limit FROM scenarios_named WHERE place = 1""",
)

WEIGHTS = """(VALUES
    ('profile', 'homeowner', 0.10::DOUBLE, -0.08::DOUBLE, 0::DOUBLE, 0.04::DOUBLE, 0.10::DOUBLE, -0.05::DOUBLE),
    ('profile', 'small_business', 0, 0.08, 0.06, -0.02, -0.03, 0.04),
    ('profile', 'big_business', 0, 0.14, 0.10, -0.04, -0.08, 0.08),
    ('priority', 'payback', 0.28, -0.10, 0, 0, 0.12, -0.04),
    ('priority', 'value', -0.06, 0.30, 0, 0, -0.08, 0.08),
    ('priority', 'coverage', 0, 0, 0.28, 0.04, -0.06, 0.10),
    ('horizon', 'short', 0.18, -0.12, 0, 0, 0.12, -0.05),
    ('horizon', 'medium', 0, 0, 0, 0, 0, 0),
    ('horizon', 'long', -0.08, 0.16, 0.08, 0, -0.08, 0.08)) AS t(kind, name, pb, va, co, se, ca, pr)"""
CRITERIA = {"pb": 0.22, "va": 0.20, "co": 0.18, "se": 0.14, "ca": 0.14, "pr": 0.12}
cte("adjust", "", f"SELECT * FROM {WEIGHTS}")
cte(
    "choices",
    "adjust",
    f"""SELECT *, pb + va + co + se + ca + pr AS total FROM (
    SELECT a.name AS profile, b.name AS priority, d.budget, d.cap, c.name AS horizon,
    {', '.join(f'{base}::DOUBLE + a.{n} + b.{n} + c.{n} AS {n}' for n, base in CRITERIA.items())}
    FROM adjust a, adjust b, adjust c, (VALUES ('lean', 4500), ('balanced', 7200),
      ('premium', NULL)) AS d(budget, cap)
    WHERE a.kind = 'profile' AND b.kind = 'priority' AND c.kind = 'horizon')""",
)


def unit(column: str) -> str:
    low, high = (f"{f}({column}) OVER (PARTITION BY site_id)" for f in ("min", "max"))
    return f"CASE WHEN {high} = {low} THEN 0.5 ELSE ({column} - {low}) / ({high} - {low}) END"


cte(
    "rated",
    "sensitivity scenarios",
    f"""SELECT s.*, 1 - {unit('pay')} AS pb, {unit('npv_25_years_euro')} AS va,
    {unit('demand_coverage_pct')} AS co, {unit('self_consumption_pct')} AS se,
    1 - {unit('installation_cost_euro')} AS ca, {unit('annual_production_kwh')} AS pr FROM (
      SELECT x.*, coalesce(TRY_CAST(split_part(x.payback_years, ' ', 1) AS DOUBLE), 99) AS pay,
        c.demand_pct AS now_cover FROM sensitivity x
      JOIN scenarios c ON c.site_id = x.site_id AND c.size_kw = 3) s""",
)
oracle(
    "scenario_ranking",
    "rated choices",
    """SELECT site_id, profile, priority, budget, horizon, rank, panel_size_kw,
    greatest(1, CAST(floor(panel_size_kw / 0.3::DOUBLE + 0.5) AS BIGINT)) AS panels,
    round(score, 6) AS ranking_score, within_budget, outside_budget,
    round(pb, 6) AS payback_score, round(va, 6) AS value_score, round(co, 6) AS coverage_score,
    round(se, 6) AS self_consumption_score, round(ca, 6) AS capex_score,
    round(pr, 6) AS production_score FROM (SELECT *,
      row_number() OVER (PARTITION BY site_id, profile, priority, budget, horizon
        ORDER BY score DESC, panel_size_kw) AS rank,
      count(*) FILTER (WHERE NOT within_budget) OVER (PARTITION BY site_id, profile, priority,
        budget, horizon) AS outside_budget FROM (SELECT r.*, c.profile, c.priority, c.budget,
      c.horizon, coalesce(installation_cost_euro <= cap, TRUE) AS within_budget,
      (r.pb * c.pb + r.va * c.va + r.co * c.co + r.se * c.se + r.ca * c.ca + r.pr * c.pr) / total
      - CASE WHEN installation_cost_euro > cap THEN 0.45 ELSE 0 END
      - CASE WHEN budget = 'lean' AND panel_size_kw > 3 THEN 0.08 ELSE 0 END
      - CASE WHEN profile = 'homeowner' AND self_consumption_pct < 25 THEN 0.08 ELSE 0 END
      - CASE WHEN profile = 'homeowner' AND panel_size_kw > 3.5 THEN 0.10 ELSE 0 END
      + CASE WHEN profile = 'small_business' AND panel_size_kw BETWEEN 3 AND 4.5 THEN 0.05 ELSE 0 END
      + CASE WHEN profile = 'big_business' AND panel_size_kw >= 4.5 THEN 0.08 ELSE 0 END
      + CASE WHEN priority = 'coverage' AND demand_coverage_pct > now_cover THEN 0.04 ELSE 0 END
      + CASE WHEN priority = 'payback' AND installation_cost_euro < 5400 THEN 0.03 ELSE 0 END
        AS score FROM rated r, choices c)) WHERE rank <= 4""",
)
oracle(
    "chart_series",
    "years scenarios_named",
    """SELECT site_id, series, size_kw, year, round(cum, 4) AS cumulative,
    round((cum - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END, 4) AS scaled FROM (
      SELECT *, min(cum) OVER (PARTITION BY site_id) AS lo, max(cum) OVER (PARTITION BY site_id)
        AS hi FROM (SELECT site_id, 'current' AS series, size_kw, y AS year, cum FROM years
          WHERE size_kw = 3 UNION ALL
        SELECT y.site_id, 'optimal', y.size_kw, y.y, y.cum FROM years y JOIN scenarios_named s
          ON s.site_id = y.site_id AND s.panel_size_kw = y.size_kw AND s.place = 1))""",
)
oracle(
    "season_chart",
    "months",
    """SELECT site_id, month, production_kwh, load_kwh,
    round(production_kwh / top * 100, 6) AS production_height_pct,
    round(load_kwh / top * 100, 6) AS load_height_pct FROM (SELECT *,
      max(greatest(production_kwh, load_kwh)) OVER (PARTITION BY site_id) AS top FROM months)""",
)

# --------------------------------------------------------------- simple study

cte(
    "shares",
    "produced",
    """SELECT *, CASE WHEN yearly > 0 THEN round(5400 / yearly, 1) ELSE 'inf'::DOUBLE END AS payback
    FROM (SELECT *, benefit * 12 - 150 AS yearly FROM (SELECT *,
      total * pct / 100 * 0.30::DOUBLE AS savings, total * (100 - pct) / 100 * 0.10::DOUBLE AS revenue,
      least(total * (100 - pct) / 100, 225) * 0.12::DOUBLE AS incentive,
      total * pct / 100 * 0.30::DOUBLE + total * (100 - pct) / 100 * 0.10::DOUBLE
        + least(total * (100 - pct) / 100, 225) * 0.12::DOUBLE AS benefit
      FROM (SELECT city, sum(hourly_kwh) AS total, count(DISTINCT date) AS days FROM produced
        GROUP BY city), (SELECT unnest([20, 30, 40, 50, 60, 70]) AS pct)))""",
)
SHARES = """city AS site_id, round(total, 6) AS total_kwh, days, pct AS self_consumption_pct,
    round(total * pct / 100, 1) AS self_consumed_kwh, round(total * (100 - pct) / 100, 1)
      AS grid_injected_kwh, round(savings, 2) AS savings_euro, round(revenue, 2) AS revenue_euro,
    round(incentive, 2) AS incentive_euro, round(benefit, 2) AS period_benefit_euro,
    round(yearly, 2) AS annual_benefit_euro, payback AS payback_years"""
oracle("self_consumption_scenarios", "shares", f"SELECT {SHARES} FROM shares")
cte(
    "best_shares",
    "shares",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY payback, pct) AS place
    FROM shares) WHERE place = 1""",
)
oracle("best_self_consumption", "best_shares", f"SELECT {SHARES} FROM best_shares")
FACTOR = "(0.7 + 1.0 + 1.4 + 1.8 + 2.1 + 2.3 + 2.4 + 2.2 + 1.9 + 1.5 + 1.0 + 0.6)::DOUBLE / 12"


def yearly_benefit(energy: str) -> str:
    return (
        f"({energy}) * pct / 100 * 0.30::DOUBLE + ({energy}) * (100 - pct) / 100 * 0.10::DOUBLE "
        f"+ least(({energy}) * (100 - pct) / 100, 2700) * 0.12::DOUBLE - 150"
    )


cte(
    "seasonal",
    "best_shares",
    f"""SELECT *, sum(cf) OVER (PARTITION BY city ORDER BY year) AS cum FROM (
    SELECT *, CASE WHEN year = 0 THEN -5400 ELSE benefit * pow(1.03::DOUBLE, year)
      - CASE WHEN year = 12 THEN 1200 ELSE 0 END END AS cf FROM (
    SELECT city, total, pct, annual, {yearly_benefit('annual')} AS benefit,
      unnest(range(0, 26)) AS year
    FROM (SELECT *, total * {FACTOR} AS annual FROM best_shares)))""",
)
oracle(
    "seasonal_cash_flow",
    "seasonal",
    """SELECT city AS site_id, round(total, 4) AS total_kwh, pct AS self_consumption_pct,
    round(annual, 4) AS annual_kwh, round(benefit, 4) AS annual_benefit_euro, year,
    round(cf, 4) AS cash_flow, round(cum, 4) AS cumulative FROM seasonal""",
)
cte(
    "season_metrics",
    "seasonal",
    """SELECT city, any_value(total) AS total, any_value(annual) AS annual,
    any_value(benefit) AS benefit,
    coalesce(min(year) FILTER (WHERE year > 0 AND cum >= 0), 999) AS payback,
    max(cum) FILTER (WHERE year = 20) AS profit FROM seasonal GROUP BY city""",
)
oracle(
    "seasonal_metrics",
    "season_metrics",
    """SELECT city AS site_id, round(total, 4) AS total_kwh, round(annual, 4) AS annual_kwh,
    round(benefit, 4) AS annual_benefit_euro, payback AS payback_years,
    round(profit / 5400 * 100, 4) AS roi_20_years, round(profit, 4) AS total_profit_20_years
    FROM season_metrics""",
)
oracle(
    "solar_vs_grid",
    "season_metrics",
    """SELECT city AS site_id, 810::DOUBLE AS annual_grid_cost, round(grid, 4)
      AS grid_cost_20_years, round(profit + 5400, 4) AS solar_savings_20_years,
    round(profit + 5400 - grid, 4) AS net_benefit_vs_grid,
    round(5400 / (annual * 20) + 0.1::DOUBLE, 4) AS break_even_rate, 67.5::DOUBLE
      AS period_grid_cost, round(total / 225 * 100, 4) AS coverage_percentage
    FROM season_metrics, (SELECT 810 * sum(pow(1.03::DOUBLE, i)) AS grid
      FROM (SELECT unnest(range(1, 21)) AS i))""",
)
oracle(
    "simple_sensitivity",
    "best_shares sizes",
    f"""SELECT site_id, panel_size_kw, round(period, 1) AS period_production_kwh,
    CAST(trunc(annual) AS BIGINT) AS annual_production_kwh, CAST(1800 * panel_size_kw AS BIGINT)
      AS installation_cost_euro, CAST(trunc(benefit) AS BIGINT) AS annual_benefit_euro,
    payback AS payback_years,
    row_number() OVER (PARTITION BY site_id ORDER BY payback, panel_size_kw) = 1 AS is_best
    FROM (SELECT *, CASE WHEN benefit > 0 THEN round(1800 * panel_size_kw / benefit, 1)
        ELSE 'inf'::DOUBLE END AS payback FROM (
      SELECT *, {yearly_benefit('annual')} AS benefit FROM (
        SELECT city AS site_id, size_kw AS panel_size_kw, pct, total / 3 * size_kw AS period,
          total / 3 * size_kw * {FACTOR} AS annual FROM best_shares, sizes)))""",
)
oracle(
    "simple_score",
    "season_metrics",
    f"""SELECT city AS site_id, payback AS payback_years, score, {VERDICT},
    concat_ws('; ', CASE WHEN payback < 6 THEN 'EXCELLENT payback: Less than 6 years'
      WHEN payback < 8 THEN 'VERY GOOD payback: 6-8 years' WHEN payback < 10
      THEN 'GOOD payback: 8-10 years' WHEN payback < 12 THEN 'ACCEPTABLE payback: 10-12 years'
      WHEN payback < 15 THEN 'MEDIOCRE payback: 12-15 years' END,
    CASE WHEN roi > 300 THEN 'EXCELLENT ROI: >300%' WHEN roi > 200 THEN 'VERY GOOD ROI: 200-300%'
      WHEN roi > 150 THEN 'GOOD ROI: 150-200%' WHEN roi > 100 THEN 'ACCEPTABLE ROI: 100-150%'
      WHEN roi > 50 THEN 'LOW ROI: 50-100%' END,
    CASE WHEN cover > 40 THEN CASE WHEN cover > 120 THEN 'EXCELLENT' WHEN cover > 80 THEN 'GREAT'
      WHEN cover > 60 THEN 'GOOD' ELSE 'PARTIAL' END || printf(' coverage: %.0f', cover)
      || '% of consumption' END) AS strengths,
    concat_ws('; ', CASE WHEN payback >= 15 THEN 'POOR payback: More than 15 years' END,
    CASE WHEN roi <= 50 THEN 'VERY LOW ROI: <50%' END,
    CASE WHEN cover <= 40 THEN 'LOW coverage: ' || printf('%.0f', cover) || '% of consumption' END)
      AS concerns
    FROM (SELECT *, CASE WHEN payback < 6 THEN 40 WHEN payback < 8 THEN 35 WHEN payback < 10 THEN 30
      WHEN payback < 12 THEN 20 WHEN payback < 15 THEN 10 ELSE 0 END
      + CASE WHEN roi > 300 THEN 30 WHEN roi > 200 THEN 25 WHEN roi > 150 THEN 20
        WHEN roi > 100 THEN 15 WHEN roi > 50 THEN 5 ELSE 0 END
      + CASE WHEN cover > 120 THEN 20 WHEN cover > 80 THEN 30 WHEN cover > 60 THEN 25
        WHEN cover > 40 THEN 15 ELSE 0 END AS score
      FROM (SELECT *, profit / 5400 * 100 AS roi, total / 225 * 100 AS cover
        FROM season_metrics))""",
)
