"""The medallion tables of one data folder as lazy DataFrames."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sunledger.operators import anomalies, gold, silver
from sunledger.session import materialise
from sunledger.sources import events


class Fleet:
    """Bronze, silver and gold of ``folder`` as they stand at ``as_of``.

    Nothing is computed or cached here: each property is a logical plan, and
    Spark prunes the columns and rows a report does not need.  A deployment
    writes the layers with :mod:`sunledger.plans.refresh` and reads them back.
    """

    def __init__(self, spark: SparkSession, folder: str, as_of: datetime):
        self.spark = spark
        self.folder = folder
        self.as_of = as_of

    @cached_property
    def events(self) -> DataFrame:
        return events.read_events(self.spark, self.folder)

    @cached_property
    def readings(self) -> DataFrame:
        return events.readings_view(self.events)

    @cached_property
    def weather(self) -> DataFrame:
        return events.weather_view(self.events)

    @cached_property
    def silver_solar(self) -> DataFrame:
        return silver.build_silver_solar(self.readings)

    @cached_property
    def silver_weather(self) -> DataFrame:
        return silver.build_silver_weather(self.weather)

    @cached_property
    def daily_panel(self) -> DataFrame:
        return gold.daily_panel(self.silver_solar)

    @cached_property
    def hourly_system(self) -> DataFrame:
        return gold.hourly_system(self.silver_solar)

    @cached_property
    def monthly_kpis(self) -> DataFrame:
        return gold.monthly_kpis(self.silver_solar)

    @cached_property
    def weather_impact(self) -> DataFrame:
        return gold.weather_impact(self.silver_weather, self.silver_solar)

    def anomalies_of_first_run(self, as_of: datetime | None = None) -> DataFrame:
        """gold_anomalies after one detection run on an empty table."""
        return self.detection_run(as_of or self.as_of)

    def detection_run(self, as_of: datetime, existing: DataFrame | None = None) -> DataFrame:
        """One detection run; the panel profile is computed once for all detectors."""
        profile = materialise(anomalies.panel_profile(self.silver_solar, as_of))
        return anomalies.detect_anomalies(self.silver_solar, as_of, existing, profile)

    @cached_property
    def anomalies(self) -> DataFrame:
        return self.anomalies_of_first_run()

    @cached_property
    def site_weather(self) -> DataFrame:
        return events.site_weather_view(self.weather)

    @cached_property
    def site_hours(self) -> DataFrame:
        return events.site_hours_view(self.events)
