"""Messages of the reading topic and payloads of the weather API as typed rows.

Plain column expressions: the same functions serve a stream and a batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger import constants as C
from sunledger.schemas import (
    READING_EVENT,
    SOLAR_PANEL_READINGS,
    WEATHER_DATA,
    WEATHER_PAYLOAD,
    conform,
)

NOT_AN_OBJECT = "not a JSON object"
MISSING_FIELD = "missing field: "
WRONG_TYPE = "wrong type"
BAD_TIMESTAMP = "unreadable timestamp"
OUT_OF_RANGE = "number out of range"

_CORRUPT = "_corrupt_record"
_NUMBERS = ("panel_power_kw", "production_kw", "temperature_c", "cloud_factor", "temp_efficiency")


def _has_key(keys: Column, name: str) -> Column:
    """The key is there, possibly with a JSON null."""
    return F.coalesce(F.array_contains(keys, name), F.lit(False))


def decode_readings(messages: DataFrame) -> DataFrame:
    """``value`` -> reading columns plus ``reject_reason`` (NULL for a good row).

    Required fields must be present, though a null is let through; status and
    city get their defaults only when their key is absent.  What the table's
    types cannot hold is rejected instead of failing the whole batch.
    """
    schema = T.StructType([*READING_EVENT.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = messages.withColumns(
        {"keys": F.json_object_keys(text), "e": F.from_json(text, schema, options)}
    )
    keys, event = F.col("keys"), F.col("e")
    moment = F.try_to_timestamp(event["timestamp"])
    columns = {
        "event_id": event["event_id"],
        "timestamp": moment,
        "panel_id": event["panel_id"],
        "panel_type": event["panel_type"],
        **{
            name: event[name].try_cast(SOLAR_PANEL_READINGS[name].dataType) for name in _NUMBERS
        },
        "status": F.when(_has_key(keys, "status"), event["status"]).otherwise(C.DEFAULT_STATUS),
        "city": F.when(_has_key(keys, "city"), event["city"]).otherwise(C.DEFAULT_CITY),
    }
    reason = F.when(keys.isNull(), NOT_AN_OBJECT)
    for name in C.REQUIRED_EVENT_FIELDS:
        reason = reason.when(~_has_key(keys, name), MISSING_FIELD + name)
    too_large = F.lit(False)
    for name in _NUMBERS:
        too_large = too_large | (event[name].isNotNull() & columns[name].isNull())
    reason = (
        reason.when(event[_CORRUPT].isNotNull(), WRONG_TYPE)
        .when(event["timestamp"].isNotNull() & moment.isNull(), BAD_TIMESTAMP)
        .when(too_large, OUT_OF_RANGE)
    )
    passed = [name for name in messages.columns if name not in columns]
    return parsed.select(
        *passed, *conform(columns, SOLAR_PANEL_READINGS), reason.alias("reject_reason")
    )


def flatten_weather(
    payloads: DataFrame, as_of: datetime | Column, city: str = C.DEFAULT_CITY
) -> DataFrame:
    """``value`` (API payload) -> weather rows; payloads with an error or no data vanish.

    ``as_of`` is the moment of the fetch: a literal or a column of ``payloads``.
    """
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of.isoformat(sep=" "))
    text = F.col("value").cast("string")
    parsed = payloads.withColumns(
        {
            "keys": F.json_object_keys(text),
            "named": F.json_object_keys(F.get_json_object(text, "$.location")),
            "p": F.from_json(text, WEATHER_PAYLOAD),
            "fetched": moment.cast("timestamp"),
        }
    ).where(
        _has_key(F.col("keys"), "current")
        & ~_has_key(F.col("keys"), "error")
        & F.col("p.current").isNotNull()
    )
    now = F.col("p.current")
    columns = {
        "city": F.when(_has_key(F.col("named"), "name"), F.col("p.location.name")).otherwise(city),
        "timestamp": F.col("fetched"),
        "temperature": now["temperature"],
        "humidity": now["humidity"],
        "wind_speed": now["wind_speed"],
        "wind_direction": now["wind_dir"],
        "pressure": now["pressure"],
        "precipitation": now["precip"],
        "cloud_cover": now["cloudcover"],
        "uv_index": now["uv_index"],
        "weather_code": now["weather_code"],
        "weather_description": F.coalesce(F.get(now["weather_descriptions"], F.lit(0)), F.lit("")),
        "is_day": F.coalesce(now["is_day"] == "yes", F.lit(False)),
        "observation_time": clock_on_day(now["observation_time"], F.col("fetched")),
    }
    passed = [name for name in payloads.columns if name != "value" and name not in columns]
    return parsed.select(*passed, *conform(columns, WEATHER_DATA))


def clock_on_day(clock: Column, moment: Column) -> Column:
    """A clock time such as '07:34 PM' on the day of ``moment``; unreadable -> ``moment``."""
    time_of_day = F.coalesce(
        F.try_to_timestamp(clock, F.lit(C.OBSERVATION_TIME_FORMAT)),
        F.try_to_timestamp(clock, F.lit("h:mm a")),
    )
    merged = F.unix_micros(F.date_trunc("day", moment)) + F.unix_micros(time_of_day)
    return F.coalesce(F.timestamp_micros(merged), moment)
