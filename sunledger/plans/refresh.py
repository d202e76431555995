"""Scheduled jobs over a folder of tables: silver, gold, detection, maintenance.

``Lake`` names the tables; every function is one job that reads what earlier
jobs wrote and is safe to run again.  A job refuses to build from empty input.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions.clock import PARTITION_COLUMN
from sunledger.functions.semantics import join_null_safe
from sunledger.operators import anomalies, daystates, gold, monitoring, quality, silver
from sunledger.schemas import GOLD_ANOMALIES
from sunledger.session import materialise
from sunledger.sources.tables import append_table, delete, exists, folder_names, refresh_days, refresh_table
from sunledger.streaming import decode

GENERATION = "generation"
_ANOMALY_TABLE = T.StructType([*GOLD_ANOMALIES.fields, T.StructField(GENERATION, T.IntegerType())])

_ANOMALY_DAY, _SINCE = "anomaly_date", "since"
_MARKERS = T.StructType(
    [T.StructField(GENERATION, T.IntegerType()), T.StructField(_ANOMALY_DAY, T.DateType())]
)


class LayerNotReady(RuntimeError):
    """The input layer is empty; nothing was written."""


class PipelineUnhealthy(RuntimeError):
    """The health score is below its limit."""


class Lake:
    """Locations of the tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.location(layer, table))

    @property
    def weather(self) -> DataFrame:
        return self.read("bronze", "weather_data")

    @property
    def readings(self) -> DataFrame:
        return self.read("bronze", "solar_panel_readings")

    @property
    def silver_weather(self) -> DataFrame:
        return self.read("silver", "silver_weather")

    @property
    def silver_solar(self) -> DataFrame:
        return self.read("silver", "silver_solar")

    @property
    def daily_panel(self) -> DataFrame:
        return self.read("gold", "gold_daily_panel")

    def anomalies(self) -> DataFrame:
        """gold_anomalies as it stands (no rows before the first run).

        A day that maintenance has rewritten is read from the generation that did so on.
        """
        stored = self._table("gold_anomalies", _ANOMALY_TABLE).where(F.col(GENERATION) <= self.generation())
        rewritten = self._markers().groupBy(_ANOMALY_DAY).agg(F.max(GENERATION).alias(_SINCE))
        current = join_null_safe(stored, rewritten, [_ANOMALY_DAY], "left")
        return current.where(F.col(GENERATION) >= F.coalesce(_SINCE, F.lit(0))).drop(GENERATION, _SINCE)

    def generation(self) -> int:
        """The newest generation readers see; its markers are written after its rows are complete."""
        return self._markers().agg(F.max(GENERATION)).first()[0] or 0

    def append_anomalies(self, found: DataFrame) -> None:
        location = self.location("gold", "gold_anomalies")
        found.write.mode("append").partitionBy(_ANOMALY_DAY).parquet(
            f"{location}/{GENERATION}={self.generation()}"
        )

    def replace_anomalies(self, rows: DataFrame, days: Sequence[date | None] | None = None) -> None:
        """Make ``rows`` the content of ``days`` (of the whole table without them), as the next generation.

        Files of other days stay as they are.  What a failed run has left is overwritten by the next.
        """
        if days is None:
            days = days_of(self.anomalies().select(_ANOMALY_DAY).unionByName(rows.select(_ANOMALY_DAY)))
        following = self.generation() + 1
        location = self.location("gold", "gold_anomalies")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(_ANOMALY_DAY).parquet(f"{location}/{GENERATION}={following}")
        markers = self.spark.createDataFrame([(following, day) for day in days], _MARKERS)
        # one file, so that either all days change or none
        markers.coalesce(1).write.mode("append").parquet(self.location("gold", "gold_anomalies_generations"))

    def superseded(self) -> list[str]:
        """Folders of rewritten days that no reader of the current generation needs."""
        rewritten = self._markers().groupBy(_ANOMALY_DAY).agg(F.max(GENERATION).alias(_SINCE)).collect()
        since = {_folder(r[_ANOMALY_DAY]): r[_SINCE] for r in rewritten}  # one row per day
        location, found = self.location("gold", "gold_anomalies"), []
        for generation in range(self.generation()):
            base = f"{location}/{GENERATION}={generation}"
            found += [f"{base}/{day}" for day in folder_names(self.spark, base) if since.get(day, 0) > generation]
        return found

    def _markers(self) -> DataFrame:
        return self._table("gold_anomalies_generations", _MARKERS)

    def _table(self, table: str, schema: T.StructType) -> DataFrame:
        location = self.location("gold", table)
        if not exists(self.spark, location):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(location)


def refresh_silver(lake: Lake, as_of: datetime, days: Sequence[date] | None = None) -> None:
    """Bronze -> silver: everything, or only the given event days."""
    weather, readings = lake.weather, lake.readings
    if weather.isEmpty() and readings.isEmpty():
        raise LayerNotReady("both bronze tables are empty")
    for bronze, build, table in (
        (weather, silver.build_silver_weather, "silver_weather"),
        (readings, silver.build_silver_solar, "silver_solar"),
    ):
        location = lake.location("silver", table)
        if days is None:
            refresh_table(build(bronze, as_of), location, ts="timestamp")
        else:
            refresh_days(build(_of_days(bronze, days), as_of), location, days=days)


def refresh_gold(lake: Lake, as_of: datetime, days: Sequence[date] | None = None) -> None:
    """Silver -> gold roll-ups: everything, or only the given days and the months they lie in.

    Only the readings of the given days are read; the months follow from stored states of their days.

    All tables are partitioned by day, the monthly one by the first of the month.
    """
    _require(silver_weather=lake.silver_weather, silver_solar=lake.silver_solar)
    weather, solar = lake.silver_weather, lake.silver_solar
    months = sorted({day.replace(day=1) for day in days or ()})
    if days is not None:
        weather, solar = _of_days(weather, days), _of_days(solar, days)
    production, panels = _refresh_states(lake, solar, days)
    if days is not None:
        wanted = [day for m in months for day in _days_of_month(m)]
        production, panels = (df.where(F.col(PARTITION_COLUMN).isin(*wanted)) for df in (production, panels))
    monthly = daystates.months_of_days(production, panels, as_of).withColumn(
        "month_start", F.expr("make_date(year, month, 1)")
    )
    tables = {
        "gold_daily_panel": (gold.daily_panel(solar, as_of), "date", days),
        "gold_hourly_system": (gold.hourly_system(solar, as_of), "hour", days),
        "gold_monthly_kpis": (monthly, "month_start", months),
        "gold_weather_impact": (gold.weather_impact(weather, solar), "timestamp", days),
    }
    for table, (df, ts, given) in tables.items():
        if days is None:
            refresh_table(df, lake.location("gold", table), ts=ts)
        else:
            refresh_days(df, lake.location("gold", table), ts, given)


def _refresh_states(
    lake: Lake, solar: DataFrame, days: Sequence[date] | None
) -> tuple[DataFrame, DataFrame]:
    """Production and panel states per day, rebuilt from ``solar`` for ``days`` (or all): a month follows from its days."""
    where = {name: lake.location("gold", name) for name in ("panel_numbers", "production_days", "panel_days")}
    fresh = days is None or not all(exists(lake.spark, location) for location in where.values())
    if fresh:
        solar, days = lake.silver_solar, None
        refresh_table(daystates.panel_numbers(solar), where["panel_numbers"])
    else:
        known = lake.read("gold", "panel_numbers")
        append_table(daystates.panel_numbers(solar, known), where["panel_numbers"], ts=None)
    numbers = lake.read("gold", "panel_numbers")
    states = {
        "production_days": daystates.production_states(solar),
        "panel_days": daystates.panel_bitmaps(solar, numbers),
    }
    for name, df in states.items():
        if days is None:
            refresh_table(df, where[name], ts=daystates.DAY)
        else:
            refresh_days(df, where[name], daystates.DAY, days)
    return lake.read("gold", "production_days"), lake.read("gold", "panel_days")


def _days_of_month(first: date) -> list[date]:
    days = [first + timedelta(days=i) for i in range(31)]
    return [day for day in days if day.month == first.month]


def ingest_weather(lake: Lake, payloads: DataFrame, as_of: datetime) -> None:
    """Weather payloads -> bronze: decoded, given their clock time and appended."""
    rows = decode.flatten_weather(payloads, as_of)
    append_table(rows, lake.location("bronze", "weather_data"), ts="timestamp")


def run_detection(lake: Lake, as_of: datetime) -> None:
    """Append the anomalies of this run that the table does not hold yet."""
    solar = lake.silver_solar
    profile = materialise(anomalies.panel_profile(solar, as_of))
    found = anomalies.detect_anomalies(solar, as_of, lake.anomalies(), profile)
    lake.append_anomalies(found)


def maintain_anomalies(
    lake: Lake,
    as_of: datetime,
    keep: timedelta = anomalies.RETENTION,
    after_days: int = anomalies.RESOLVE_AFTER_DAYS,
) -> list[date | None]:
    """Drop expired anomalies and resolve old ones; returns the days that changed.

    Only these days are rewritten, as a new generation; Parquet rows cannot be changed in place, and
    readers stay on the old files until the new ones are there.
    """
    held = lake.anomalies()
    days = days_of(held.where(anomalies.overdue(held, as_of, keep, after_days)))
    if days:
        affected = held.where(_on_days(days))
        kept = anomalies.auto_resolve(anomalies.purge(affected, as_of, keep), as_of, after_days)
        lake.replace_anomalies(kept, days)
    return days


def vacuum_anomalies(lake: Lake) -> int:
    """Delete the files that maintenance has replaced; to be run when no reader uses them any more."""
    folders = lake.superseded()
    for folder in folders:
        delete(lake.spark, folder)
    return len(folders)


def days_of(rows: DataFrame) -> list[date | None]:
    """The different anomaly days, at most one per day of the history."""
    found = rows.select(_ANOMALY_DAY).distinct().collect()
    return sorted((r[0] for r in found), key=lambda day: (day is None, day or date.min))


def _on_days(days: Sequence[date | None]) -> Column:
    listed = F.col(_ANOMALY_DAY).isin(*(day for day in days if day is not None))
    return listed | F.col(_ANOMALY_DAY).isNull() if None in days else listed


def _folder(day: date | None) -> str:
    return f"{_ANOMALY_DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def check_health(lake: Lake, as_of: datetime) -> DataFrame:
    """The deduction score as a one-row DataFrame; raises when it is below its limit."""
    report = materialise(
        monitoring.health_score_deductions(
            lake.readings,
            lake.anomalies(),
            lake.daily_panel,
            {
                "weather_data": lake.weather,
                "solar_panel_readings": lake.readings,
                "silver_weather": lake.silver_weather,
                "silver_solar": lake.silver_solar,
                "gold_daily_panel": lake.daily_panel,
            },
            as_of,
        )
    )
    row = report.first()
    if row["failed"]:
        raise PipelineUnhealthy(f"health {row['health_score']}/100: {row['deductions']}")
    return report


def layer_report(lake: Lake) -> DataFrame:
    """Row counts of every table of the lake."""
    return quality.layer_counts(
        {
            "bronze": {"weather_data": lake.weather, "solar_panel_readings": lake.readings},
            "silver": {
                "silver_weather": lake.silver_weather,
                "silver_solar": lake.silver_solar,
            },
            "gold": {
                **{
                    table: lake.read("gold", table)
                    for table in (
                        "gold_daily_panel",
                        "gold_hourly_system",
                        "gold_weather_impact",
                        "gold_monthly_kpis",
                    )
                },
                "gold_anomalies": lake.anomalies(),
            },
        }
    )


def _require(**tables: DataFrame) -> None:
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise LayerNotReady(f"empty: {', '.join(empty)}")


def _of_days(df: DataFrame, days: Sequence[date]) -> DataFrame:
    """Rows of the given days, as ranges that reach the scan (or the partition filter)."""
    if PARTITION_COLUMN in df.columns:
        return df.where(F.col(PARTITION_COLUMN).isin(*days)).drop(PARTITION_COLUMN)
    chosen = F.lit(False)
    for day in days:
        chosen = chosen | (
            (F.col("timestamp") >= F.lit(day)) & (F.col("timestamp") < F.lit(day + timedelta(days=1)))
        )
    return df.where(chosen)
