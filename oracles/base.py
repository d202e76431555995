"""Common table expressions of the DuckDB oracles.

Decimals are kept as scaled integers (``_m`` thousandths, ``_c`` hundredths,
``_d`` tenths), so that every rounding is integer arithmetic and independent of
the way Spark gets there.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-30 23:59:59.999999'"
NOON = "TIMESTAMP '2024-01-30 12:00:00'"
EARLY = "TIMESTAMP '2024-01-05 23:59:59.999999'"
MIDDLE = "TIMESTAMP '2024-01-15 23:59:59.999999'"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLES: dict[str, str] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (tuple(needs.split()), body)


def with_ctes(needs: str, body: str) -> str:
    """``body`` preceded by the CTEs it needs, directly or not."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered or name not in CTES:
            return
        for other in CTES[name][0]:
            add(other)
        ordered.append(name)

    for name in needs.split():
        add(name)
    parts = ", ".join(f"{name} AS ({CTES[name][1]})" for name in ordered)
    return f"WITH {parts} {body}"


def oracle(name: str, needs: str, body: str) -> None:
    ORACLES[name] = with_ctes(needs, body)


def rdiv(num: str, den: str) -> str:
    """num / den of integers, rounded half away from zero; NULL for 0."""
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(sign({num}) AS HUGEINT) * "
        f"((2 * abs(CAST({num} AS HUGEINT)) + ({den})) // (2 * CAST({den} AS HUGEINT))) END)"
    )


def dbl(scaled: str, factor: int) -> str:
    return f"(CAST({scaled} AS DOUBLE) / {factor}::DOUBLE)"


def mean(scaled: str, factor: int, condition: str = "") -> str:
    """Mean as DOUBLE: exact integer sum, one division by the scale, one by the count."""
    only = f" FILTER (WHERE {condition})" if condition else ""
    return f"(CAST(sum({scaled}){only} AS DOUBLE) / {factor}::DOUBLE / count({scaled}){only})"


def mean_at(scaled: str, factor: int, digits_factor: int) -> str:
    """Mean rounded to a stored scale, as a scaled integer (factor >= digits_factor)."""
    return rdiv(f"sum({scaled}) * {digits_factor}", f"count({scaled}) * {factor}")


def pct(part: str, whole: str, digits: int = 2) -> str:
    scale = 10**digits
    return dbl(rdiv(f"({part}) * {100 * scale}", whole), scale)


cte(
    "raw",
    "",
    "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)
cte(
    "readings",
    "raw",
    """SELECT event_id AS id, event_id, ts AS timestamp,
       'PV-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS panel_id,
       CASE user_id % 3 WHEN 0 THEN 'Monocrystalline' WHEN 1 THEN 'Polycrystalline'
            ELSE 'Thin-film' END AS panel_type,
       CAST(CASE WHEN user_id % 10 = 9 THEN 0 ELSE 120 END AS DECIMAL(5,2)) AS panel_power_kw,
       CAST(CASE WHEN event_id % 499 = 498 THEN NULL ELSE 120 - value END AS DECIMAL(8,3))
         AS production_kw,
       CAST(CASE WHEN k < 2 THEN -40 ELSE 15 + CAST(60 AS DOUBLE) * k * k * k * k
            / CAST(1e8 AS DOUBLE) END AS DECIMAL(5,1)) AS temperature_c,
       CAST(k / CAST(88 AS DOUBLE) AS DECIMAL(3,2)) AS cloud_factor,
       CAST(CAST(0.45 AS DOUBLE) + k / CAST(100 AS DOUBLE) AS DECIMAL(4,3)) AS temp_efficiency,
       event_type AS status, 'Turin' AS city
       FROM raw""",
)
cte(
    "weather",
    "raw",
    """SELECT event_id AS id,
       CASE user_id % 3 WHEN 0 THEN 'Turin' WHEN 1 THEN 'Milan' ELSE 'Rome' END AS city,
       ts AS timestamp,
       CAST(k * CAST(0.9 AS DOUBLE) - 25 AS DECIMAL(5,2)) AS temperature,
       (k * 7) % 106 AS humidity, CAST(value - 1 AS DECIMAL(5,2)) AS wind_speed,
       (k * 13) % 104 AS cloud_cover, CAST(k / CAST(10 AS DOUBLE) AS DECIMAL(3,1)) AS uv_index,
       100 + k AS weather_code, extract(hour FROM ts) BETWEEN 6 AND 18 AS is_day
       FROM raw WHERE event_type = 'view'""",
)
PARTS = """extract(year FROM timestamp) AS year, extract(month FROM timestamp) AS month,
       extract(day FROM timestamp) AS day, extract(hour FROM timestamp) AS hour,
       extract(dow FROM timestamp) AS day_of_week"""
cte(
    "scaled",
    "readings",
    """SELECT *, CAST(production_kw * 1000 AS BIGINT) AS p_m,
       CAST(panel_power_kw * 100 AS BIGINT) AS w_c, CAST(temperature_c * 10 AS BIGINT) AS t_d
       FROM readings""",
)
cte(
    "solar",
    "scaled",
    f"""SELECT *, {PARTS}, {rdiv('100 * p_m', 'w_c')} AS r_m,
       CASE WHEN w_c = 0 THEN 'Poor' WHEN p_m > 8 * w_c THEN 'Excellent'
            WHEN p_m > 5 * w_c THEN 'Good' WHEN p_m > 2 * w_c THEN 'Fair' ELSE 'Poor' END
         AS performance_category,
       coalesce(production_kw >= 0 AND temperature_c BETWEEN -30 AND 60
         AND cloud_factor BETWEEN 0 AND 1 AND temp_efficiency BETWEEN 0.5 AND 1.5, FALSE)
         AS is_valid
       FROM scaled""",
)
cte(
    "sky",
    "weather",
    f"""SELECT *, {PARTS},
       CASE WHEN temperature < 0 THEN 'Freezing' WHEN temperature < 10 THEN 'Cold'
            WHEN temperature < 20 THEN 'Mild' WHEN temperature < 30 THEN 'Warm' ELSE 'Hot' END
         AS temperature_category,
       CASE WHEN cloud_cover < 20 THEN 'Clear' WHEN cloud_cover < 60 THEN 'Partly Cloudy'
            ELSE 'Cloudy' END AS sky_condition,
       CASE WHEN uv_index < 3 THEN 'Low' WHEN uv_index < 6 THEN 'Moderate'
            WHEN uv_index < 8 THEN 'High' ELSE 'Very High' END AS uv_category,
       coalesce(temperature BETWEEN -30 AND 50 AND humidity BETWEEN 0 AND 100
         AND wind_speed >= 0 AND cloud_cover BETWEEN 0 AND 100, FALSE) AS is_valid,
       CAST(temperature * 100 AS BIGINT) AS t_c
       FROM weather""",
)
cte(
    "daily",
    "solar",
    f"""SELECT CAST(timestamp AS DATE) AS date, panel_id, panel_type,
       count(*) AS readings_count, {mean_at('p_m', 1000, 1000)} AS avg_p_m,
       {rdiv('sum(p_m)', '10')} AS total_c, max(p_m) AS max_m, min(p_m) AS min_m,
       {mean_at('r_m', 1000, 1000)} AS eff_m,
       count(*) FILTER (WHERE is_valid) AS valid_readings,
       count(*) FILTER (WHERE NOT is_valid) AS invalid_readings,
       {rdiv('count(*) FILTER (WHERE is_valid) * 10000', 'count(*)')} AS quality_c
       FROM solar GROUP BY ALL""",
)
cte(
    "hourly",
    "solar",
    f"""SELECT date_trunc('hour', timestamp) AS hour, count(DISTINCT panel_id) AS active_panels,
       {rdiv('sum(p_m)', '10')} AS total_c, {mean_at('p_m', 1000, 1000)} AS avg_p_m,
       max(p_m) AS max_m, {mean_at('t_d', 10, 10)} AS temp_d,
       {mean_at('r_m', 1000, 1000)} AS eff_m,
       count(*) FILTER (WHERE is_valid) AS valid_readings
       FROM solar GROUP BY ALL""",
)
cte(
    "monthly",
    "solar",
    f"""SELECT year, month, count(DISTINCT panel_id) AS total_panels,
       {rdiv('sum(p_m)', '10')} AS total_c, {mean_at('p_m', 1000, 1000)} AS avg_p_m,
       max(p_m) AS max_m, {mean_at('r_m', 1000, 1000)} AS eff_m,
       {mean_at('t_d', 10, 10)} AS temp_d,
       count(*) FILTER (WHERE is_valid) AS valid_readings,
       {rdiv('count(*) FILTER (WHERE is_valid) * 10000', 'count(*)')} AS quality_c
       FROM solar GROUP BY year, month""",
)
cte(
    "impact",
    "sky solar",
    f"""SELECT w.timestamp, w.city, w.t_c, w.humidity, w.cloud_cover, w.uv_index,
       w.sky_condition, h.avg_p_m, coalesce(h.panels, 0) AS reporting_panels
       FROM sky w LEFT JOIN (
         SELECT date_trunc('hour', timestamp) AS hour, {mean_at('p_m', 1000, 1000)} AS avg_p_m,
                count(DISTINCT panel_id) AS panels FROM solar GROUP BY 1
       ) h ON h.hour = date_trunc('hour', w.timestamp)""",
)

ANOMALY_COLUMNS = (
    "detection_time, anomaly_date, panel_id, anomaly_type, severity, expected_value, "
    "actual_value, deviation_percentage, resolution_status"
)


def anomaly_parts(as_of: str, raised: str | None = None) -> dict[str, str]:
    """The four detectors as plain joins; ``raised`` names the table of earlier anomalies."""
    day = f"CAST({as_of} AS DATE)"
    seen = f"(SELECT * FROM solar WHERE timestamp <= {as_of})"
    week = f"(SELECT * FROM {seen} WHERE timestamp > {as_of} - INTERVAL 7 DAY)"
    today = f"(SELECT * FROM {seen} WHERE CAST(timestamp AS DATE) = {day})"
    yesterday = f"(SELECT * FROM {seen} WHERE CAST(timestamp AS DATE) = {day} - 1)"

    def new(condition: str, on_day: bool = True) -> str:
        if raised is None:
            return "TRUE"
        date = f" AND g.anomaly_date = {day}" if on_day else " AND g.resolution_status = 'Open'"
        return f"NOT EXISTS (SELECT 1 FROM {raised} g WHERE g.panel_id = x.panel_id AND {condition}{date})"

    head = f"{as_of} AS detection_time, {day} AS anomaly_date, x.panel_id"
    none = "CAST(NULL AS DOUBLE)"
    low = f"""SELECT {head},
        CASE WHEN z < -3 THEN 'Critical Low Production' ELSE 'Low Production' END AS anomaly_type,
        CASE WHEN z < -3 THEN 'Critical' ELSE 'Warning' END AS severity,
        {dbl(rdiv('s_m', 'n'), 1000)} AS expected_value, {dbl('p_m', 1000)} AS actual_value,
        CASE WHEN a <> 0 THEN round(100.0::DOUBLE * (a - {dbl('p_m', 1000)}) / a, 2) END
          AS deviation_percentage, 'Open' AS resolution_status
        FROM (SELECT r.panel_id, r.p_m, s.a, s.s_m, s.n,
                     CASE WHEN s.sd <> 0 THEN ({dbl('r.p_m', 1000)} - s.a) / s.sd END AS z
              FROM {today} r JOIN (
                SELECT panel_id, {mean('p_m', 1000)} AS a, sum(p_m) AS s_m, count(p_m) AS n,
                       stddev_samp({dbl('p_m', 1000)}) AS sd
                FROM {week} WHERE is_valid GROUP BY panel_id) s ON s.panel_id = r.panel_id) x
        WHERE z < -2 AND {new("g.anomaly_type LIKE '%Low Production%'")}"""
    hot = f"""SELECT {head}, 'High Temperature' AS anomaly_type,
        CASE WHEN z > 3 THEN 'Critical' ELSE 'Warning' END AS severity,
        {dbl(rdiv('s_d * 100', 'n'), 1000)} AS expected_value, {dbl('t_d', 10)} AS actual_value,
        CASE WHEN a <> 0 THEN round(100.0::DOUBLE * ({dbl('t_d', 10)} - a) / a, 2) END
          AS deviation_percentage, 'Open' AS resolution_status
        FROM (SELECT r.panel_id, r.t_d, s.a, s.s_d, s.n,
                     CASE WHEN s.sd <> 0 THEN ({dbl('r.t_d', 10)} - s.a) / s.sd END AS z
              FROM {today} r CROSS JOIN (
                SELECT {mean('t_d', 10)} AS a, sum(t_d) AS s_d, count(t_d) AS n,
                       stddev_samp({dbl('t_d', 10)}) AS sd
                FROM {week} WHERE is_valid) s) x
        WHERE z > 2 AND {new("g.anomaly_type = 'High Temperature'")}"""
    missing = f"""SELECT {head}, 'Missing Data' AS anomaly_type,
        CASE WHEN t.panel_id IS NOT NULL THEN 'Warning' ELSE 'Critical' END AS severity,
        {none} AS expected_value, {none} AS actual_value, {none} AS deviation_percentage,
        'Open' AS resolution_status
        FROM (SELECT DISTINCT panel_id FROM {week}) x
        LEFT JOIN (SELECT DISTINCT panel_id FROM {seen}
                   WHERE timestamp > {as_of} - INTERVAL 1 HOUR) h ON h.panel_id = x.panel_id
        LEFT JOIN (SELECT DISTINCT panel_id FROM {today}) t ON t.panel_id = x.panel_id
        WHERE h.panel_id IS NULL AND {new("g.anomaly_type = 'Missing Data'", False)}"""
    drop = f"""SELECT {head}, 'Sudden Production Drop' AS anomaly_type,
        CASE WHEN pct > 70 THEN 'Critical' ELSE 'Warning' END AS severity,
        {dbl('y_m', 1000)} AS expected_value, {dbl('t_m', 1000)} AS actual_value,
        round(pct, 2) AS deviation_percentage, 'Open' AS resolution_status
        FROM (SELECT t.panel_id, t.m AS t_m, y.m AS y_m,
                     CASE WHEN y.a <> 0 THEN (y.a - t.a) / y.a * 100 END AS pct
              FROM (SELECT panel_id, {mean('p_m', 1000)} AS a,
                           {mean_at('p_m', 1000, 1000)} AS m FROM {today} GROUP BY 1) t
              JOIN (SELECT panel_id, {mean('p_m', 1000)} AS a,
                           {mean_at('p_m', 1000, 1000)} AS m FROM {yesterday} GROUP BY 1) y
                ON y.panel_id = t.panel_id
              WHERE t.a < y.a * 0.5::DOUBLE) x
        WHERE {new("g.anomaly_type = 'Sudden Production Drop'")}"""
    return {"low": low, "hot": hot, "missing": missing, "drop": drop}


def anomalies(as_of: str, raised: str | None = None) -> str:
    parts = anomaly_parts(as_of, raised).values()
    return " UNION ALL ".join(f"SELECT {ANOMALY_COLUMNS} FROM ({part})" for part in parts)


cte("raised", "solar", anomalies(AS_OF))
cte("raised_noon", "solar", anomalies(NOON))
cte("raised_middle", "solar", anomalies(MIDDLE))
cte("raised_early", "solar", anomalies(EARLY))
