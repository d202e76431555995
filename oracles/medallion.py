"""Oracles of the silver and gold layers, anomalies, quality and monitoring."""

from __future__ import annotations

from oracles.base import (
    cte,
    AS_OF,
    anomalies,
    anomaly_parts,
    dbl,
    mean,
    mean_at,
    oracle,
    pct,
    rdiv,
)

SOLAR_COLUMNS = """id, event_id, timestamp, panel_id, panel_type,
  CAST(panel_power_kw AS DOUBLE) AS panel_power_kw, CAST(production_kw AS DOUBLE) AS production_kw,
  CAST(temperature_c AS DOUBLE) AS temperature_c, CAST(cloud_factor AS DOUBLE) AS cloud_factor,
  CAST(temp_efficiency AS DOUBLE) AS temp_efficiency, status, city, year, month, day, hour,
  day_of_week"""

oracle(
    "silver_solar",
    "solar",
    f"""SELECT {SOLAR_COLUMNS}, {dbl('r_m', 1000)} AS efficiency_ratio, performance_category,
    is_valid FROM solar""",
)
oracle(
    "silver_weather",
    "sky",
    """SELECT id, city, timestamp, CAST(temperature AS DOUBLE) AS temperature,
    CAST(humidity AS BIGINT) AS humidity, CAST(wind_speed AS DOUBLE) AS wind_speed,
    CAST(cloud_cover AS BIGINT) AS cloud_cover, CAST(uv_index AS DOUBLE) AS uv_index,
    CAST(weather_code AS BIGINT) AS weather_code, is_day, year, month, day, hour, day_of_week,
    CAST(weather_code + 900 AS DOUBLE) AS pressure, 0::DOUBLE AS precipitation,
    temperature_category, sky_condition, uv_category, is_valid FROM sky""",
)
oracle(
    "gold_daily_panel",
    "daily",
    f"""SELECT date, panel_id, panel_type, readings_count, {dbl('avg_p_m', 1000)}
    AS avg_production_kw, {dbl('total_c', 100)} AS total_production_kwh,
    {dbl('max_m', 1000)} AS peak_production_kw, {dbl('min_m', 1000)} AS min_production_kw,
    {dbl('eff_m', 1000)} AS avg_efficiency, valid_readings, invalid_readings,
    {dbl('quality_c', 100)} AS data_quality_pct FROM daily""",
)
oracle(
    "gold_hourly_system",
    "hourly",
    f"""SELECT hour, active_panels, {dbl('total_c', 100)} AS total_production_kw,
    {dbl('avg_p_m', 1000)} AS avg_production_per_panel, {dbl('max_m', 1000)}
    AS peak_production_kw, {dbl('temp_d', 10)} AS avg_temperature,
    {dbl('eff_m', 1000)} AS avg_system_efficiency, valid_readings FROM hourly""",
)
MONTHLY = f"""year, month, total_panels, {dbl('total_c', 100)} AS total_production_kwh,
    {dbl('avg_p_m', 1000)} AS avg_production_kw, {dbl('eff_m', 1000)} AS avg_efficiency,
    {dbl('quality_c', 100)} AS data_quality_pct"""
for _name in ("gold_monthly_kpis", "gold_monthly_from_days"):
    oracle(
        _name,
        "monthly",
        f"""SELECT {MONTHLY}, {dbl('max_m', 1000)} AS peak_production_kw,
        {dbl('temp_d', 10)} AS avg_temperature, valid_readings FROM monthly""",
    )
oracle(
    "gold_weather_impact",
    "impact",
    f"""SELECT timestamp, city, {dbl('t_c', 100)} AS temperature,
    CAST(humidity AS BIGINT) AS humidity, CAST(cloud_cover AS BIGINT) AS cloud_cover,
    CAST(uv_index AS DOUBLE) AS uv_index, sky_condition,
    {dbl('avg_p_m', 1000)} AS avg_solar_production, reporting_panels FROM impact""",
)
oracle(
    "combined_solar_weather",
    "readings weather",
    """SELECT s.timestamp, s.panel_id, CAST(s.production_kw AS DOUBLE) AS production_kw,
    CAST(s.temperature_c AS DOUBLE) AS panel_temperature,
    CAST(w.temperature AS DOUBLE) AS ambient_temperature, CAST(w.humidity AS BIGINT) AS humidity,
    CAST(w.wind_speed AS DOUBLE) AS wind_speed, CAST(w.cloud_cover AS BIGINT) AS cloud_cover,
    CAST(w.uv_index AS DOUBLE) AS uv_index
    FROM readings s LEFT JOIN weather w
    ON CAST(s.timestamp AS DATE) = CAST(w.timestamp AS DATE)
    AND extract(hour FROM s.timestamp) = extract(hour FROM w.timestamp)""",
)

cte(
    "combined",
    "scaled weather",
    """SELECT date_trunc('hour', s.timestamp) AS hour, s.panel_id, s.p_m, s.t_d,
    CAST(w.temperature * 100 AS BIGINT) AS t_c, w.cloud_cover FROM scaled s
    LEFT JOIN weather w ON date_trunc('hour', s.timestamp) = date_trunc('hour', w.timestamp)""",
)
for _name, _key in (("combined_by_hour", "hour"), ("combined_by_panel", "panel_id")):
    oracle(
        _name,
        "combined",
        f"""SELECT {_key}, count(*) AS view_rows, {mean('p_m', 1000)} AS avg_production_kw,
        {mean('t_d', 10)} AS avg_panel_temperature,
        {mean('t_c', 100)} AS avg_ambient_temperature,
        {mean('cloud_cover', 1)} AS avg_cloud_cover,
        round(covar_pop({dbl('p_m', 1000)}, {dbl('t_c', 100)}), 6) AS production_temperature_covariance
        FROM combined GROUP BY {_key}""",
    )

# ------------------------------------------------------------------ anomalies

oracle(
    "panel_stats",
    "solar",
    f"""SELECT panel_id, {mean('p_m', 1000)} AS avg_production,
    round(stddev_samp({dbl('p_m', 1000)}), 6) AS stddev_production FROM solar
    WHERE is_valid AND timestamp > {AS_OF} - INTERVAL 7 DAY AND timestamp <= {AS_OF}
    GROUP BY panel_id""",
)
for _name, _part in (
    ("anomaly_low_production", "low"),
    ("anomaly_high_temperature", "hot"),
    ("anomaly_missing_data", "missing"),
    ("anomaly_sudden_drop", "drop"),
):
    oracle(_name, "solar", anomaly_parts(AS_OF)[_part])
oracle(
    "anomaly_missing_simple",
    "solar",
    f"""SELECT {AS_OF} AS detection_time, CAST({AS_OF} AS DATE) AS anomaly_date, e.panel_id,
    'Missing Data' AS anomaly_type, 'Critical' AS severity, CAST(NULL AS DOUBLE) AS expected_value,
    CAST(NULL AS DOUBLE) AS actual_value, CAST(NULL AS DOUBLE) AS deviation_percentage,
    'Open' AS resolution_status
    FROM (SELECT DISTINCT panel_id FROM solar) e WHERE NOT EXISTS (SELECT 1 FROM solar s
    WHERE s.panel_id = e.panel_id AND CAST(s.timestamp AS DATE) = CAST({AS_OF} AS DATE))""",
)
oracle("anomaly_incremental", "solar raised_noon", anomalies(AS_OF, "raised_noon"))
oracle(
    "anomaly_today_summary",
    "raised",
    f"""SELECT 'ANOMALY SUMMARY' AS title, count(*) AS total,
    count(*) FILTER (WHERE severity = 'Critical') AS critical,
    count(*) FILTER (WHERE severity = 'Warning') AS warning
    FROM raised WHERE anomaly_date = CAST({AS_OF} AS DATE)""",
)
oracle(
    "anomaly_today_by_type",
    "raised",
    f"""SELECT anomaly_type, severity, count(*) AS count FROM raised
    WHERE anomaly_date = CAST({AS_OF} AS DATE) GROUP BY ALL""",
)
oracle(
    "anomaly_open_rollup",
    "raised",
    """SELECT anomaly_type, severity, count(*) AS count, min(anomaly_date) AS oldest,
    max(anomaly_date) AS latest, count(DISTINCT panel_id) AS panels
    FROM raised WHERE resolution_status = 'Open' GROUP BY anomaly_type, severity""",
)
oracle(
    "anomaly_open_panels",
    "raised",
    """SELECT anomaly_type, severity, panel_id, count(*) AS count, min(anomaly_date) AS oldest,
    max(anomaly_date) AS latest
    FROM raised WHERE resolution_status = 'Open' GROUP BY anomaly_type, severity, panel_id""",
)
oracle(
    "anomaly_purge",
    "raised raised_middle",
    """SELECT * FROM (SELECT * FROM raised UNION ALL SELECT * FROM raised_middle)
    WHERE detection_time >= TIMESTAMP '2024-02-20' - INTERVAL 30 DAY""",
)
oracle(
    "anomaly_maintenance",
    "raised raised_middle raised_early",
    """SELECT * REPLACE (CASE WHEN anomaly_date < DATE '2024-02-20' - 30
      AND resolution_status = 'Open' THEN 'Resolved' ELSE resolution_status END
      AS resolution_status)
    FROM (SELECT * FROM raised UNION ALL SELECT * FROM raised_middle UNION ALL SELECT * FROM raised_early)
    WHERE detection_time >= TIMESTAMP '2024-02-20' - INTERVAL 40 DAY""",
)
oracle(
    "anomaly_auto_resolve",
    "raised raised_middle",
    """SELECT * REPLACE (CASE WHEN anomaly_date < DATE '2024-02-20' - 30
      AND resolution_status = 'Open' THEN 'Resolved' ELSE resolution_status END
      AS resolution_status)
    FROM (SELECT * FROM raised UNION ALL SELECT * FROM raised_middle)""",
)

# -------------------------------------------------------------------- quality

oracle(
    "bronze_counts",
    "readings weather",
    """SELECT 'weather_data' AS table_name, count(*) AS row_count,
    min(timestamp) AS earliest_record, max(timestamp) AS latest_record FROM weather UNION ALL
    SELECT 'solar_panel_readings', count(*), min(timestamp), max(timestamp) FROM readings""",
)


def outside(column: str, low: str, high: str, alias: str) -> str:
    return f"count(*) FILTER (WHERE {column} NOT BETWEEN {low} AND {high}) AS {alias}"


oracle(
    "weather_dq",
    "weather",
    f"""SELECT count(*) AS total_records, count(*) - count(temperature) AS null_temperature,
    count(*) - count(humidity) AS null_humidity,
    {outside('temperature', '-30', '50', 'out_of_range_temp')},
    {outside('humidity', '0', '100', 'invalid_humidity')},
    {outside('cloud_cover', '0', '100', 'invalid_cloud_cover')} FROM weather""",
)
oracle(
    "reading_dq",
    "scaled",
    f"""SELECT count(*) AS total_records, count(DISTINCT panel_id) AS unique_panels,
    count(*) - count(p_m) AS null_production,
    count(*) FILTER (WHERE p_m < 0) AS negative_production,
    {outside('t_d', '-300', '600', 'out_of_range_temp')},
    {outside('cloud_factor', '0', '1', 'invalid_cloud_factor')},
    {outside('temp_efficiency', '0.5', '1.5', 'invalid_efficiency')} FROM scaled""",
)
oracle(
    "panel_summary",
    "scaled",
    f"""SELECT panel_id, count(*) AS readings, min(timestamp) AS first_seen,
    max(timestamp) AS last_seen, {mean('p_m', 1000)} AS avg_production,
    {dbl('min(p_m)', 1000)} AS min_production, {dbl('max(p_m)', 1000)} AS max_production
    FROM scaled GROUP BY panel_id""",
)
oracle(
    "city_summary",
    "sky",
    f"""SELECT city, count(*) AS readings, {mean('t_c', 100)} AS avg_temp,
    {dbl('min(t_c)', 100)} AS min_temp, {dbl('max(t_c)', 100)} AS max_temp,
    {mean('humidity', 1)} AS avg_humidity FROM sky GROUP BY city""",
)
oracle(
    "duplicate_check",
    "readings weather",
    """SELECT 'weather_data' AS table_name,
    count(*) - count(DISTINCT (timestamp, city)) AS potential_duplicates FROM weather UNION ALL
    SELECT 'solar_panel_readings', count(*) - count(DISTINCT event_id) FROM readings""",
)
oracle(
    "hour_distribution",
    "scaled",
    f"""SELECT extract(hour FROM timestamp) AS hour_of_day, count(*) AS readings,
    {mean('p_m', 1000)} AS avg_production FROM scaled GROUP BY 1""",
)
oracle(
    "bronze_verdict",
    "readings weather",
    """SELECT CASE WHEN min(n) > 0 THEN '✅ PASS - All tables have data'
    ELSE '❌ FAIL - Some tables are empty' END AS data_presence_check,
    concat('Total records: ', sum(n)) AS total_records FROM (
    SELECT count(*) AS n FROM weather UNION ALL SELECT count(*) FROM readings)""",
)
oracle(
    "layer_reconciliation",
    "weather readings sky solar",
    """SELECT source, bronze_count, silver_count,
    CASE WHEN bronze_count = silver_count THEN '✅ MATCH' ELSE '❌ MISMATCH' END AS status
    FROM (SELECT 'weather_data' AS source, (SELECT count(*) FROM weather) AS bronze_count,
    (SELECT count(*) FROM sky) AS silver_count UNION ALL
    SELECT 'solar_panel_readings', (SELECT count(*) FROM readings), (SELECT count(*) FROM solar))""",
)
VALIDITY = f"""count(*) AS total_records, count(*) FILTER (WHERE is_valid) AS valid_records,
    count(*) FILTER (WHERE NOT is_valid) AS invalid_records,
    {pct('count(*) FILTER (WHERE is_valid)', 'count(*)')} AS quality_pct"""
oracle(
    "silver_weather_quality",
    "sky",
    f"""SELECT {VALIDITY}, count(DISTINCT temperature_category) AS temp_categories,
    count(DISTINCT sky_condition) AS sky_categories, count(DISTINCT uv_category) AS uv_categories
    FROM sky""",
)
oracle(
    "silver_solar_quality",
    "solar",
    f"""SELECT {VALIDITY}, count(DISTINCT performance_category) AS performance_categories,
    {mean('r_m', 1000)} AS avg_efficiency, {dbl('min(r_m)', 1000)} AS min_efficiency,
    {dbl('max(r_m)', 1000)} AS max_efficiency FROM solar""",
)
oracle(
    "category_distribution",
    "sky",
    f"""SELECT category_type, category, count(*) AS count,
    {pct('count(*)', '(SELECT count(*) FROM sky)')} AS percentage FROM (
    SELECT 'Temperature' AS category_type, temperature_category AS category FROM sky UNION ALL
    SELECT 'Sky Condition', sky_condition FROM sky) GROUP BY ALL""",
)
oracle(
    "performance_distribution",
    "solar",
    f"""SELECT performance_category, count(*) AS readings,
    {pct('count(*)', '(SELECT count(*) FROM solar)')} AS percentage,
    {mean('p_m', 1000)} AS avg_production, {mean('r_m', 1000)} AS avg_efficiency
    FROM solar GROUP BY performance_category""",
)
oracle(
    "invalid_share",
    "sky",
    f"""SELECT 'weather' AS source, count(*) AS count,
    {pct('count(*)', '(SELECT count(*) FROM sky)')} AS percentage FROM sky WHERE NOT is_valid""",
)
oracle(
    "invalid_reasons",
    "solar",
    """SELECT CASE WHEN production_kw < 0 THEN 'Negative production'
    WHEN temperature_c < -30 OR temperature_c > 60 THEN 'Temperature out of range'
    WHEN cloud_factor < 0 OR cloud_factor > 1 THEN 'Invalid cloud factor'
    WHEN temp_efficiency < 0.5 OR temp_efficiency > 1.5 THEN 'Invalid efficiency'
    ELSE 'Other' END AS reason, count(*) AS count FROM solar WHERE NOT is_valid GROUP BY 1""",
)
oracle(
    "time_coverage",
    "sky solar",
    """SELECT 'silver_weather' AS table_name, min(timestamp) AS earliest, max(timestamp) AS latest,
    datesub('day', min(timestamp), max(timestamp)) AS days_covered FROM sky UNION ALL
    SELECT 'silver_solar', min(timestamp), max(timestamp),
    datesub('day', min(timestamp), max(timestamp)) FROM solar""",
)
oracle(
    "silver_verdict",
    "sky solar",
    f"""SELECT CASE WHEN least(w.q, s.q) > 0.95::DOUBLE
      THEN '✅ EXCELLENT - Data quality >95% in both tables'
    WHEN least(w.q, s.q) > 0.8::DOUBLE THEN '⚠️ GOOD - Data quality >80% in both tables'
    ELSE '❌ POOR - Data quality below 80% in one or more tables' END AS data_quality_verdict,
    concat('Weather: ', printf('%.1f', w.p), '%, Solar: ', printf('%.1f', s.p), '%')
      AS quality_percentages
    FROM (SELECT CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) AS q,
      {pct('count(*) FILTER (WHERE is_valid)', 'count(*)', 1)} AS p FROM sky) w,
    (SELECT CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) AS q,
      {pct('count(*) FILTER (WHERE is_valid)', 'count(*)', 1)} AS p FROM solar) s""",
)
oracle(
    "layer_counts",
    "weather readings sky solar daily hourly impact monthly raised",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, '{layer}' AS layer FROM {table}"
        for layer, name, table in (
            ("bronze", "weather_data", "weather"),
            ("bronze", "solar_panel_readings", "readings"),
            ("silver", "silver_weather", "sky"),
            ("silver", "silver_solar", "solar"),
            ("gold", "gold_daily_panel", "daily"),
            ("gold", "gold_hourly_system", "hourly"),
            ("gold", "gold_weather_impact", "impact"),
            ("gold", "gold_monthly_kpis", "monthly"),
            ("gold", "gold_anomalies", "raised"),
        )
    ),
)
oracle(
    "daily_fleet_7d",
    "daily",
    f"""SELECT date, count(DISTINCT panel_id) AS panels_reporting,
    {dbl('sum(total_c)', 100)} AS total_production,
    {dbl(mean_at('eff_m', 1000, 1000), 1000)} AS avg_efficiency,
    {dbl(mean_at('quality_c', 100, 10), 10)} AS avg_quality
    FROM daily GROUP BY date ORDER BY date DESC LIMIT 7""",
)
for _name, _order in (("top_panels_7d", "DESC"), ("bottom_panels_7d", "ASC")):
    oracle(
        _name,
        "daily",
        f"""SELECT panel_id, {dbl('sum(total_c)', 100)} AS total_7day_production,
        {dbl(mean_at('eff_m', 1000, 1000), 1000)} AS avg_efficiency,
        {dbl(mean_at('quality_c', 100, 10), 10)} AS data_quality
        FROM daily WHERE date >= CAST({AS_OF} AS DATE) - 7 GROUP BY panel_id
        ORDER BY sum(total_c) {_order}, panel_id LIMIT 5""",
    )
oracle(
    "hourly_24h",
    "hourly",
    f"""SELECT hour, active_panels, {dbl('total_c', 100)} AS total_kw,
    {dbl('avg_p_m', 1000)} AS avg_per_panel, {dbl('eff_m', 1000)} AS efficiency, valid_readings
    FROM hourly WHERE hour >= {AS_OF} - INTERVAL 24 HOUR AND hour <= {AS_OF}""",
)
oracle(
    "weather_impact_by_sky",
    "impact",
    f"""SELECT sky_condition, count(*) AS samples,
    {dbl(mean_at('avg_p_m', 1000, 1000), 1000)} AS avg_production,
    {dbl(mean_at('t_c', 100, 10), 10)} AS avg_temperature,
    {dbl(mean_at('cloud_cover', 1, 10), 10)} AS avg_clouds FROM impact GROUP BY sky_condition""",
)
oracle("monthly_kpi_listing", "monthly", f"SELECT {MONTHLY} FROM monthly")
oracle(
    "completeness",
    "daily",
    """SELECT concat(min(date), ' to ', max(date)) AS coverage_period,
    date_diff('day', min(date), max(date)) + 1 AS days_covered,
    count(DISTINCT date) AS days_with_data FROM daily""",
)
oracle(
    "gold_verdict",
    "daily hourly monthly raised",
    """SELECT CASE WHEN (SELECT count(*) FROM daily) > 0 AND (SELECT count(*) FROM hourly) > 0
    AND (SELECT count(*) FROM monthly) > 0 THEN '✅ PASS - All gold tables populated'
    ELSE '❌ FAIL - Some gold tables are empty' END AS tables_check,
    CASE WHEN n = 0 THEN '✅ PASS - No open anomalies'
    WHEN n < 5 THEN '⚠️ WARNING - ' || n || ' open anomalies'
    ELSE '❌ CRITICAL - ' || n || ' open anomalies require attention' END AS anomalies_check
    FROM (SELECT count(*) AS n FROM raised WHERE resolution_status = 'Open')""",
)
oracle(
    "layer_gate",
    "weather readings sky solar",
    """SELECT layer, CAST(sum(n) AS BIGINT) AS row_count,
    CASE layer WHEN 'bronze' THEN max(n) > 0 ELSE min(n) > 0 END AS ready FROM (
    SELECT 'bronze' AS layer, count(*) AS n FROM weather UNION ALL
    SELECT 'bronze', count(*) FROM readings UNION ALL
    SELECT 'silver', count(*) FROM sky UNION ALL SELECT 'silver', count(*) FROM solar)
    GROUP BY layer""",
)
oracle(
    "required_columns",
    "weather",
    """SELECT '' AS missing_columns, count(*) AS total_rows,
    min(CAST(timestamp AS DATE)) AS first_date, max(CAST(timestamp AS DATE)) AS last_date
    FROM weather""",
)
oracle(
    "weather_by_sky",
    "sky",
    f"""SELECT sky_condition, count(*) AS count, {mean('t_c', 100)} AS avg_temperature
    FROM sky GROUP BY 1""",
)
oracle(
    "business_metrics",
    "solar hourly raised",
    f"""SELECT s.system_efficiency, s.data_quality, r.n AS open_anomalies,
    h.peak AS peak_production_kw, CAST(r.n_all AS DOUBLE) / s.n AS anomaly_rate
    FROM (SELECT {mean('r_m', 1000)} AS system_efficiency, count(*) AS n,
      CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) AS data_quality FROM solar) s,
    (SELECT count(*) AS n_all, count(*) FILTER (WHERE resolution_status = 'Open') AS n
      FROM raised) r,
    (SELECT {dbl('max(total_c)', 100)} AS peak FROM hourly) h""",
)
oracle(
    "open_anomalies_per_panel",
    "raised",
    "SELECT panel_id, count(*) AS open_anomalies FROM raised "
    "WHERE resolution_status = 'Open' GROUP BY panel_id",
)

# ----------------------------------------------------------------- monitoring


def hours(ts: str) -> str:
    return f"(CAST(epoch_us({AS_OF}) - epoch_us({ts}) AS DOUBLE) / 3600000000::DOUBLE)"


WATCHED = (("weather_data", "weather"), ("solar_panel_readings", "readings"), ("silver_solar", "solar"))
oracle(
    "freshness",
    "weather readings solar",
    """SELECT table_name, last_record, round(h, 2) AS hours_since_last_record,
    CASE WHEN h < 1 THEN 'Real-time' WHEN h < 6 THEN 'Slight delay' WHEN h < 24 THEN 'Batch mode'
    ELSE 'Stale data' END AS status FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, max(timestamp) AS last_record, {hours('max(timestamp)')} AS h "
        f"FROM {t} WHERE timestamp <= {AS_OF}"
        for n, t in WATCHED
    )
    + ")",
)
oracle(
    "volume_24h",
    "weather readings solar",
    """SELECT table_name, n AS records_last_24h, (2 * n + 24) // 48 AS avg_per_hour,
    CASE WHEN n = 0 THEN 'No data' WHEN n < 2400 THEN 'Low volume' ELSE 'Normal' END AS status
    FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n FROM {t} "
        f"WHERE timestamp > {AS_OF} - INTERVAL 24 HOUR AND timestamp <= {AS_OF}"
        for n, t in WATCHED
    )
    + ")",
)
oracle(
    "panel_health",
    "scaled",
    f"""SELECT panel_id, n AS total_readings, avg_production_kw, last_seen,
    CASE WHEN h < 1 THEN 'Online' WHEN h < 6 THEN 'Intermittent' ELSE 'Offline' END AS status
    FROM (SELECT panel_id, count(*) AS n, max(timestamp) AS last_seen,
      {dbl(mean_at('p_m', 1000, 100), 100)} AS avg_production_kw,
      {hours('max(timestamp)')} AS h FROM scaled GROUP BY panel_id)""",
)
oracle(
    "quality_7d",
    "daily",
    f"""SELECT date, {mean('quality_c', 100)} AS avg_quality,
    CAST(sum(valid_readings) AS BIGINT) AS total_valid,
    CAST(sum(invalid_readings) AS BIGINT) AS total_invalid,
    {pct('sum(valid_readings)', 'sum(valid_readings) + sum(invalid_readings)')} AS overall_quality
    FROM daily WHERE date >= CAST({AS_OF} AS DATE) - 7 GROUP BY date""",
)
oracle(
    "pipeline_lag",
    "readings solar daily",
    f"""SELECT b AS bronze_latest, s AS silver_latest, g AS gold_latest,
    CAST(epoch_us(s) - epoch_us(b) AS DOUBLE) / 60000000::DOUBLE AS bronze_to_silver_minutes,
    {hours('CAST(g AS TIMESTAMP)')} AS gold_freshness_hours
    FROM (SELECT max(timestamp) AS b FROM readings), (SELECT max(timestamp) AS s FROM solar),
    (SELECT max(date) AS g FROM daily)""",
)


def vitals(days: int) -> str:
    return f"""(SELECT {hours('max(timestamp)')} AS h FROM readings) a,
    (SELECT count(*) FILTER (WHERE severity = 'Critical') AS critical,
       count(*) FILTER (WHERE severity = 'Critical' AND anomaly_type <> 'Missing Data') AS real,
       count(*) FILTER (WHERE severity = 'Critical' AND anomaly_type = 'Missing Data') AS missing,
       count(*) FILTER (WHERE severity = 'Warning') AS warning
     FROM raised WHERE resolution_status = 'Open') o,
    (SELECT {mean('quality_c', 100)} AS q FROM daily
     WHERE date >= CAST({AS_OF} AS DATE) - {days}) d"""


def level(score: str, lowest: str) -> str:
    return (
        f"CASE WHEN {score} >= 90 THEN 'EXCELLENT' WHEN {score} >= 70 THEN 'GOOD' "
        f"WHEN {score} >= 50 THEN 'FAIR' ELSE '{lowest}' END"
    )


oracle(
    "health_score",
    "readings raised daily",
    f"""SELECT *, freshness_score + anomaly_score + quality_score AS total_score,
    {level('freshness_score + anomaly_score + quality_score', 'CRITICAL')} AS health_status
    FROM (SELECT CASE WHEN h < 1 THEN 30 WHEN h < 6 THEN 20 WHEN h < 24 THEN 10 ELSE 0 END
      AS freshness_score, greatest(0, 40 - 5 * critical - 2 * warning) AS anomaly_score,
      CASE WHEN q > 98 THEN 30 WHEN q > 95 THEN 25 WHEN q > 90 THEN 20 WHEN q > 80 THEN 10
      ELSE 0 END AS quality_score FROM {vitals(7)})""",
)
oracle(
    "health_score_deductions",
    "readings raised daily weather sky solar",
    f"""SELECT score AS health_score, {level('score', 'POOR')} AS health_status,
    score < 50 AS failed, f AS freshness_penalty, a AS anomaly_penalty, q5 AS quality_penalty,
    e AS empty_penalty, concat_ws('; ',
      CASE WHEN f > 0 THEN CASE WHEN f = 30 THEN 'Stale data' ELSE 'Data delay' END || ': -' || f
        || ' (' || printf('%.1f', h) || ' hours)' END,
      CASE WHEN a > 0 THEN 'Anomalies: -' || a || ' (' || real || ' critical real, ' || missing
        || ' missing, ' || warning || ' warning)' END,
      CASE WHEN q5 > 0 THEN CASE WHEN q5 = 20 THEN 'Poor' ELSE 'Fair' END || ' data quality: -'
        || q5 || ' (' || printf('%.1f', q) || '%)' END,
      CASE WHEN e > 0 THEN 'Missing tables: -' || e || ' (' || e // 5 || ' tables empty)' END)
      AS deductions
    FROM (SELECT *, greatest(0, 100 - f - a - q5 - e) AS score FROM (SELECT *,
      CASE WHEN h > 24 THEN 30 WHEN h > 6 THEN 10 ELSE 0 END AS f,
      least(40, 5 * real + missing + warning) AS a,
      CASE WHEN q < 80 THEN 20 WHEN q < 90 THEN 10 ELSE 0 END AS q5,
      5 * ((SELECT count(*) FROM weather) = 0)::INT + 5 * ((SELECT count(*) FROM readings) = 0)::INT
      + 5 * ((SELECT count(*) FROM sky) = 0)::INT + 5 * ((SELECT count(*) FROM solar) = 0)::INT
      + 5 * ((SELECT count(*) FROM daily) = 0)::INT AS e FROM {vitals(7)}))""",
)
oracle(
    "alert_decision",
    "readings raised daily",
    f"""SELECT critical AS critical_count, warning AS warning_count, h AS hours_delayed,
    q AS avg_quality, reasons, severity,
    CASE severity WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS exit_code,
    CASE WHEN reasons <> '' THEN 'Alert triggered: ' || replace(reasons, '; ', ', ')
      ELSE 'No action needed - all systems normal' END || chr(10) || 'Summary: ' || critical
      || ' critical, ' || warning || ' warnings, ' || printf('%.1f', h) || 'h delay, '
      || printf('%.1f', q) || '% quality' AS message
    FROM (SELECT *, CASE WHEN critical >= 1 THEN 'CRITICAL' WHEN warning >= 5 OR h > 2 OR q < 90
        THEN 'WARNING' ELSE 'INFO' END AS severity, concat_ws('; ',
        CASE WHEN critical >= 1 THEN critical || ' critical anomalies' END,
        CASE WHEN warning >= 5 THEN warning || ' warnings' END,
        CASE WHEN h > 2 THEN 'Data delayed by ' || printf('%.1f', h) || ' hours' END,
        CASE WHEN q < 90 THEN 'Low data quality: ' || printf('%.1f', q) || '%' END) AS reasons
      FROM {vitals(3)})""",
)
oracle(
    "ingest_recency",
    "weather readings",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS count, max(timestamp) AS latest FROM {t} "
        f"WHERE timestamp > {AS_OF} - INTERVAL 15 MINUTE AND timestamp <= {AS_OF}"
        for n, t in WATCHED[:2]
    ),
)
oracle(
    "ingest_alive",
    "weather readings",
    "SELECT CAST(sum(n) AS BIGINT) AS recent_rows, max(n) > 0 AS alive FROM ("
    + " UNION ALL ".join(
        f"SELECT count(*) AS n FROM {t} "
        f"WHERE timestamp > {AS_OF} - INTERVAL 1 HOUR AND timestamp <= {AS_OF}"
        for _, t in WATCHED[:2]
    )
    + ")",
)
oracle(
    "live_dashboard",
    "scaled",
    f"""SELECT {mean('p_m', 1000)} AS avg_production, count(DISTINCT panel_id) AS active_panels,
    {mean('t_d', 10)} AS avg_temperature FROM scaled
    WHERE timestamp > {AS_OF} - INTERVAL 5 MINUTE AND timestamp <= {AS_OF}""",
)
oracle(
    "live_daily_summary",
    "scaled",
    f"""SELECT CAST(timestamp AS DATE) AS date, count(*) AS readings,
    {mean('p_m', 1000)} AS avg_production, {dbl('sum(p_m)', 1000)} AS total_production,
    {mean('t_d', 10)} AS avg_temp FROM scaled
    WHERE CAST(timestamp AS DATE) = CAST({AS_OF} AS DATE) GROUP BY 1""",
)
oracle(
    "live_series",
    "scaled",
    f"""SELECT timestamp, panel_id, {dbl('p_m', 1000)} AS production_kw,
    {dbl('t_d', 10)} AS temperature_c FROM scaled
    WHERE timestamp > {AS_OF} - INTERVAL 30 MINUTE AND timestamp <= {AS_OF}""",
)
oracle(
    "latest_readings",
    "scaled",
    f"""SELECT event_id, timestamp, panel_id, {dbl('p_m', 1000)} AS production_kw,
    {dbl('t_d', 10)} AS temperature_c FROM scaled ORDER BY timestamp DESC, event_id LIMIT 10""",
)
