"""Declared schemas of the medallion tables; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BIGINT, INT, TEXT, FLAG = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
DOUBLE, DATE = T.DoubleType(), T.DateType()
MOMENT, LOCAL_MOMENT = T.TimestampType(), T.TimestampNTZType()
DEC = T.DecimalType


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# The generic event table behind the solar view; ``ts`` is UTC without a zone.
EVENTS = _struct(
    event_id=BIGINT, ts=LOCAL_MOMENT, user_id=BIGINT, event_type=TEXT, value=DOUBLE, props=TEXT
)

WEATHER_DATA = _struct(
    id=BIGINT,
    city=TEXT,
    timestamp=MOMENT,
    temperature=DEC(5, 2),
    humidity=INT,
    wind_speed=DEC(5, 2),
    wind_direction=TEXT,
    pressure=DEC(7, 2),
    precipitation=DEC(5, 2),
    cloud_cover=INT,
    uv_index=DEC(3, 1),
    weather_code=INT,
    weather_description=TEXT,
    is_day=FLAG,
    observation_time=MOMENT,
    ingestion_timestamp=MOMENT,
)

SOLAR_PANEL_READINGS = _struct(
    id=BIGINT,
    event_id=TEXT,
    timestamp=MOMENT,
    panel_id=TEXT,
    panel_type=TEXT,
    panel_power_kw=DEC(5, 2),
    production_kw=DEC(8, 3),
    temperature_c=DEC(5, 1),
    cloud_factor=DEC(3, 2),
    temp_efficiency=DEC(4, 3),
    status=TEXT,
    city=TEXT,
    ingestion_timestamp=MOMENT,
)

# Value of one message of the reading topic; numbers arrive as JSON numbers.
READING_EVENT = _struct(
    event_id=TEXT,
    timestamp=TEXT,
    panel_id=TEXT,
    panel_type=TEXT,
    panel_power_kw=DOUBLE,
    production_kw=DOUBLE,
    temperature_c=DOUBLE,
    cloud_factor=DOUBLE,
    temp_efficiency=DOUBLE,
    status=TEXT,
    city=TEXT,
)

WEATHER_PAYLOAD = _struct(
    location=_struct(name=TEXT),
    current=_struct(
        temperature=DOUBLE,
        humidity=INT,
        wind_speed=DOUBLE,
        wind_dir=TEXT,
        pressure=DOUBLE,
        precip=DOUBLE,
        cloudcover=INT,
        uv_index=DOUBLE,
        weather_code=INT,
        weather_descriptions=T.ArrayType(TEXT),
        is_day=TEXT,
        observation_time=TEXT,
    ),
)

GOLD_ANOMALIES = _struct(
    anomaly_id=BIGINT,
    detection_time=LOCAL_MOMENT,
    anomaly_date=DATE,
    panel_id=TEXT,
    anomaly_type=TEXT,
    severity=TEXT,
    expected_value=DEC(8, 3),
    actual_value=DEC(8, 3),
    # wider than the usual five digits: a mean close to zero gives huge percentages
    deviation_percentage=DEC(18, 2),
    weather_conditions=TEXT,
    resolution_status=TEXT,
    resolution_notes=TEXT,
    resolved_time=LOCAL_MOMENT,
)

# Header CSV of site weather used by the climate and simple production operators.
SITE_WEATHER_CSV = _struct(
    city=TEXT,
    temperature=DOUBLE,
    humidity=INT,
    wind_speed=INT,
    cloudcover=INT,
    uv_index=DOUBLE,
    observation_time=LOCAL_MOMENT,
    date=DATE,
    hour=INT,
    month=INT,
    solar_angle=DOUBLE,
    cloud_factor=DOUBLE,
    temp_efficiency=DOUBLE,
    uv_factor=DOUBLE,
    solar_potential=DOUBLE,
)

SIMPLE_PRODUCTION_INPUT = ("solar_angle", "cloudcover", "temperature", "uv_index", "hour")


def conform(columns: dict[str, Column], schema: T.StructType) -> list[Column]:
    """Select list that casts each given column to its declared type, in schema order.

    Columns of the schema that are not given are left out, so partial rows
    (without surrogate ids, say) keep working.
    """
    return [
        columns[field.name].cast(field.dataType).alias(field.name)
        for field in schema.fields
        if field.name in columns
    ]


def typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)
