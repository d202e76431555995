"""Messages and payloads derived from the solar view, with every kind of defect in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# which reading gets which defect: event_id % modulus = rest
TWICE = (97, 0)
NO_PANEL = (89, 1)
BROKEN = (83, 2)
TEXT_NUMBER = (79, 3)
NO_STATUS_CITY = (73, 4)
NULL_PANEL = (71, 5)
NULL_EVENT = (67, 6)


def _hit(defect: tuple[int, int]) -> str:
    return f"(event_id % {defect[0]} = {defect[1]})"


def reading_messages(readings: DataFrame) -> DataFrame:
    """``value``: each reading as a JSON line; some broken, incomplete or repeated."""
    quoted = (
        f"CASE WHEN {_hit(TEXT_NUMBER)} THEN '\"much\"' "
        "ELSE coalesce(CAST(production_kw AS STRING), 'null') END"
    )
    panel = (
        f"CASE WHEN {_hit(NO_PANEL)} THEN '' WHEN {_hit(NULL_PANEL)} THEN '\"panel_id\": null, ' "
        "ELSE concat('\"panel_id\": \"', panel_id, '\", ') END"
    )
    tail = (
        f"CASE WHEN {_hit(NO_STATUS_CITY)} THEN '' "
        "ELSE concat(', \"status\": \"', status, '\", \"city\": \"', city, '\"') END"
    )
    event = f"CASE WHEN {_hit(NULL_EVENT)} THEN 'null' ELSE concat('\"e', event_id, '\"') END"
    line = (
        f"concat('{{\"event_id\": ', {event}, ', \"timestamp\": \"', "
        "date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00\", ', "
        f"{panel}, '\"panel_type\": \"', panel_type, '\", \"panel_power_kw\": ', panel_power_kw, "
        "', \"temperature_c\": ', temperature_c, ', \"cloud_factor\": ', cloud_factor, "
        f"', \"temp_efficiency\": ', temp_efficiency, ', \"production_kw\": ', {quoted}, {tail}, "
        f"CASE WHEN {_hit(BROKEN)} THEN '' ELSE '}}' END)"
    )
    copies = f"CASE WHEN {_hit(TWICE)} OR {_hit(NULL_EVENT)} THEN array(1, 2) ELSE array(1) END"
    return readings.select(F.expr(line).alias("value"), F.expr(f"explode({copies})").alias("copy")).select(
        "value"
    )


def weather_payloads(weather: DataFrame) -> DataFrame:
    """(id, value): each observation as an API payload; some without data, some errors."""
    current = (
        "named_struct('temperature', temperature, 'humidity', humidity, 'wind_speed', wind_speed, "
        "'wind_dir', 'NW', 'pressure', pressure, 'precip', precipitation, 'cloudcover', cloud_cover, "
        "'uv_index', uv_index, 'weather_code', weather_code, "
        "'weather_descriptions', IF(id % 5 = 0, NULL, array(sky, 'second')), "
        "'is_day', IF(is_day, 'yes', 'no'), "
        "'observation_time', CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'soon' "
        "ELSE date_format(timestamp, 'hh:mm a') END)"
    )
    value = (
        "CASE id % 11 WHEN 0 THEN '{}' "
        "WHEN 1 THEN to_json(named_struct('error', named_struct('info', 'limit reached'), "
        f"'current', {current})) "
        f"WHEN 2 THEN to_json(named_struct('current', {current})) "
        f"ELSE to_json(named_struct('location', named_struct('name', city), 'current', {current})) END"
    )
    return weather.withColumn("sky", F.lit("Sunny")).selectExpr("id", f"{value} AS value")
