"""Oracles of payload decoding and stream ingestion."""

from __future__ import annotations

from oracles.base import cte, dbl, oracle

oracle(
    "weather_payload_flatten",
    "weather",
    """SELECT id, CASE WHEN id % 11 = 2 THEN 'Turin' ELSE city END AS city,
    TIMESTAMP '2024-01-31 10:00:00' AS timestamp, CAST(temperature AS DOUBLE) AS temperature,
    CAST(humidity AS BIGINT) AS humidity, CAST(wind_speed AS DOUBLE) AS wind_speed,
    CAST(weather_code + 900 AS DOUBLE) AS pressure, 0::DOUBLE AS precipitation,
    CAST(cloud_cover AS BIGINT) AS cloud_cover, CAST(uv_index AS DOUBLE) AS uv_index,
    CAST(weather_code AS BIGINT) AS weather_code,
    'NW' AS wind_direction,
    CASE WHEN id % 5 = 0 THEN '' ELSE 'Sunny' END AS weather_description, is_day,
    CASE WHEN id % 7 IN (0, 1) THEN TIMESTAMP '2024-01-31 10:00:00'
      ELSE DATE '2024-01-31' + (date_trunc('minute', timestamp) - date_trunc('day', timestamp)) END
      AS observation_time FROM weather WHERE id % 11 > 1""",
)
cte(
    "messages",
    "readings",
    """SELECT *, event_id AS n, CASE WHEN event_id % 83 = 2 THEN 'not a JSON object'
      WHEN event_id % 89 = 1 THEN 'missing field: panel_id'
      WHEN event_id % 79 = 3 THEN 'wrong type' END AS reject_reason,
    CASE WHEN event_id % 97 = 0 OR event_id % 67 = 6 THEN 2 ELSE 1 END AS copies FROM readings""",
)
STORED = """SELECT CASE WHEN n % 67 = 6 THEN NULL ELSE 'e' || n END AS event_id, timestamp,
    CASE WHEN n % 71 = 5 THEN NULL ELSE panel_id END AS panel_id, panel_type,
    CAST(panel_power_kw AS DOUBLE) AS panel_power_kw, CAST(production_kw AS DOUBLE)
      AS production_kw, CAST(temperature_c AS DOUBLE) AS temperature_c,
    CAST(cloud_factor AS DOUBLE) AS cloud_factor, CAST(temp_efficiency AS DOUBLE)
      AS temp_efficiency, CASE WHEN n % 73 = 4 THEN 'active' ELSE status END AS status, city
    FROM messages, range(2) AS r(i) WHERE reject_reason IS NULL
    AND (i = 0 OR n % 67 = 6)"""
oracle("stream_ingest", "messages", STORED)
oracle("stream_ingest_state", "messages", STORED)
oracle("stream_ingest_ids", "messages", STORED)
oracle(
    "stream_rejects",
    "messages",
    """SELECT reject_reason, CAST(sum(copies) AS BIGINT) AS count FROM messages
    WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
)
oracle(
    "ingest_counters",
    "messages",
    """SELECT m AS messages, e AS errors, (m - e)::DOUBLE / m * 100 AS success_rate FROM (
    SELECT CAST(sum(copies) FILTER (WHERE reject_reason IS NULL) AS BIGINT) AS m,
    CAST(sum(copies) FILTER (WHERE reject_reason IS NOT NULL) AS BIGINT) AS e FROM messages)""",
)
oracle(
    "stream_hourly_rollup",
    "solar",
    f"""SELECT date_trunc('hour', timestamp) AS hour, count(*) AS readings,
    count(DISTINCT panel_id) AS active_panels,
    {dbl('sum(p_m)', 1000)} AS total_production_kw, {dbl('max(p_m)', 1000)} AS peak_production_kw,
    count(*) FILTER (WHERE is_valid) AS valid_readings FROM solar GROUP BY 1""",
)
LIVE = f"""SELECT w AS window_start, w + INTERVAL 30 MINUTE AS window_end, count(*) AS readings,
    count(DISTINCT panel_id) AS active_panels, {dbl('sum(p_m)', 1000)} AS total_production_kw,
    {dbl('max(p_m)', 1000)} AS peak_production_kw,
    count(*) FILTER (WHERE is_valid) AS valid_readings
    FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, timestamp) - to_minutes(5 * i) AS w
      FROM solar, range(6) AS r(i)) GROUP BY w"""
oracle("live_windows", "solar", LIVE)
oracle(
    "live_windows_stream",
    "solar",
    f"""{LIVE} HAVING w + INTERVAL 30 MINUTE <= (SELECT date_trunc('milliseconds', max(timestamp)) FROM solar)
    - INTERVAL 1 HOUR""",
)
oracle(
    "csv_weather_scan",
    "climate",
    """SELECT city, round(temperature, 6) AS temperature, CAST(humidity AS BIGINT) AS humidity,
    CAST(trunc(wind_speed) AS BIGINT) AS wind_speed, CAST(cloudcover AS BIGINT) AS cloudcover,
    round(uv_index, 6) AS uv_index, observation_time, date, CAST(hour AS BIGINT) AS hour,
    CAST(extract(month FROM date) AS BIGINT) AS month, round(solar_angle, 6) AS solar_angle,
    round(cloud_factor, 6) AS cloud_factor, 1::DOUBLE AS temp_efficiency,
    round(uv_factor, 6) AS uv_factor, round(solar_potential, 6) AS solar_potential FROM climate""",
)
oracle(
    "json_export",
    "daily",
    f"""SELECT date, panel_id, panel_type, readings_count, {dbl('avg_p_m', 1000)}
    AS avg_production_kw, {dbl('total_c', 100)} AS total_production_kwh,
    {dbl('max_m', 1000)} AS peak_production_kw, {dbl('min_m', 1000)} AS min_production_kw,
    {dbl('eff_m', 1000)} AS avg_efficiency, valid_readings, invalid_readings,
    {dbl('quality_c', 100)} AS data_quality_pct FROM daily""",
)
oracle(
    "refreshed_days",
    "readings",
    """SELECT CAST(timestamp AS DATE) AS event_date, count(*) * CASE WHEN CAST(timestamp AS DATE)
    BETWEEN DATE '2024-01-29' AND DATE '2024-01-30' THEN 1 ELSE 2 END AS row_count
    FROM readings GROUP BY CAST(timestamp AS DATE)""",
)
oracle(
    "silver_audit",
    "readings weather",
    """SELECT 'silver_solar' AS table_name, TIMESTAMP '2024-01-30 23:59:59.999999' AS stamped,
    count(*) AS row_count FROM readings
    UNION ALL SELECT 'silver_weather', TIMESTAMP '2024-01-30 23:59:59.999999', count(*) FROM weather""",
)
