"""Parameters of the fleet, the site model and the economics.

The numbers and names in this module are fixed values: results are only
comparable with the published goldens when they are kept as they are.  All of
them can be replaced per call with ``dataclasses.replace``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# ingestion
# --------------------------------------------------------------------------
TOPIC = "solar-raw"
REQUIRED_EVENT_FIELDS = ("event_id", "timestamp", "panel_id", "production_kw")
DEFAULT_STATUS = "active"
DEFAULT_CITY = "Turin"
OBSERVATION_TIME_FORMAT = "hh:mm a"

# --------------------------------------------------------------------------
# Category limits of the silver layer (value < limit -> label)
# --------------------------------------------------------------------------
TEMPERATURE_LIMITS = ((0, "Freezing"), (10, "Cold"), (20, "Mild"), (30, "Warm"))
TEMPERATURE_REST = "Hot"
SKY_LIMITS = ((20, "Clear"), (60, "Partly Cloudy"))
SKY_REST = "Cloudy"
UV_LIMITS = ((3, "Low"), (6, "Moderate"), (8, "High"))
UV_REST = "Very High"
# ratio > limit -> label
PERFORMANCE_LIMITS = ((0.8, "Excellent"), (0.5, "Good"), (0.2, "Fair"))
PERFORMANCE_REST = "Poor"

# Validity ranges
WEATHER_TEMPERATURE_RANGE = (-30, 50)
HUMIDITY_RANGE = (0, 100)
CLOUD_COVER_RANGE = (0, 100)
PANEL_TEMPERATURE_RANGE = (-30, 60)
CLOUD_FACTOR_RANGE = (0, 1)
TEMP_EFFICIENCY_RANGE = (0.5, 1.5)

# --------------------------------------------------------------------------
# Report bands, both ends inclusive: (name, min, max, description)
# --------------------------------------------------------------------------
CLOUD_BANDS = (
    ("clear_sky", 0, 20, "Minimal clouds"),
    ("partly_cloudy", 21, 60, "Moderate clouds"),
    ("cloudy", 61, 100, "Heavy clouds"),
)
UV_BANDS = (
    ("low", 0, 2, "Minimal radiation"),
    ("moderate", 2, 5, "Good radiation"),
    ("high", 5, 15, "Intense radiation"),
)
WIND_BANDS = (
    ("calm", 0, 5, "Minimal wind"),
    ("light", 5, 20, "Good cooling"),
    ("moderate", 20, 40, "Strong cooling"),
    ("strong", 40, 200, "Structural concern"),
)
REPORT_PERCENTILES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)

# --------------------------------------------------------------------------
# Climate normals by calendar month, January first
# --------------------------------------------------------------------------
MONTHLY_NORMALS = {
    "temp_mean_c": (2.8, 4.7, 8.9, 12.8, 17.2, 21.1, 23.9, 23.3, 19.2, 13.7, 8.0, 3.7),
    "temp_min_c": (-0.6, 0.5, 3.8, 7.5, 11.8, 15.7, 18.4, 18.0, 14.4, 9.2, 4.0, 0.3),
    "temp_max_c": (6.3, 9.0, 14.0, 18.0, 22.7, 26.8, 29.8, 29.2, 24.2, 18.1, 11.8, 6.8),
    "humidity_pct": (80, 76, 71, 69, 70, 68, 67, 69, 74, 78, 82, 83),
    "cloud_cover_pct": (61, 56, 52, 51, 54, 46, 36, 38, 45, 54, 60, 63),
    "wind_speed_kmh": (7.8, 7.6, 8.1, 8.0, 7.2, 6.5, 6.0, 5.8, 6.1, 6.4, 6.8, 7.2),
}

# Production of each month relative to February, January first
NOTEBOOK_SEASONAL_FACTORS = (0.7, 1.0, 1.4, 1.8, 2.1, 2.3, 2.4, 2.2, 1.9, 1.5, 1.0, 0.6)
CONFIG_SEASONAL_FACTORS = (0.7, 1.0, 1.4, 1.8, 2.1, 2.3, 2.4, 2.2, 1.9, 1.3, 0.8, 0.6)

# Candidate sizes (kWp) and self-consumption shares (%)
CANDIDATE_SIZES_KW = (2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 6.0)
SELF_CONSUMPTION_PCTS = (20, 30, 40, 50, 60, 70)


@dataclass(frozen=True)
class Battery:
    """Storage."""

    efficiency: float = 0.90
    cost_per_kwh: float = 450.0
    lifetime_years: int = 10
    min_days_autonomy: int = 1
    min_recommended_kwh: float = 2.0
    margin_if_enough: float = 1.2
    margin_if_short: float = 1.5
    look_back_days: int = 3


@dataclass(frozen=True)
class Panel:
    """One system as installed."""

    power_kw: float = 3.0
    efficiency: float = 0.19
    temp_loss_coeff: float = 0.004
    area_m2: float = 1.7
    roof_area_m2: float = 20.0
    kw_per_panel: float = 0.3


@dataclass(frozen=True)
class Losses:
    """Loss factors."""

    system_losses: float = 0.14
    derating_factor: float = 0.85
    degradation_rate: float = 0.005
    inverter_replacement_year: int = 12
    inverter_replacement_cost: float = 1200.0


@dataclass(frozen=True)
class Economics:
    """Prices and horizon."""

    installation_cost_per_kw: float = 1800.0
    annual_maintenance: float = 150.0
    electricity_rate: float = 0.30
    sell_back_rate: float = 0.10
    incentive_rate: float = 0.12
    annual_rate_increase: float = 0.03
    household_consumption: float = 2700.0
    monthly_consumption: float = 225.0
    analysis_years: int = 25
    discount_rate: float = 0.02


@dataclass(frozen=True)
class Site:
    """Location and mounting of the default site."""

    city: str = "Turin"
    latitude: float = 45.0703
    longitude: float = 7.6869
    timezone: str = "Europe/Rome"
    system_size_kw: float = 3.0
    tilt_deg: float = 35.0
    azimuth_from_south_deg: float = 0.0
    albedo: float = 0.20
    noct_c: float = 45.0
    calibration: float = 0.84
    derating_factor: float = 0.85
    temp_coefficient: float = 0.004


@dataclass(frozen=True)
class Sky:
    """Empirical constants of sun position and irradiance."""

    equation_of_time: tuple[float, float, float] = (9.87, 7.53, 1.5)
    equinox_day: float = 81.0
    tilt_of_earth: float = 23.45
    clear_sky_wm2: float = 1098.0
    extinction: float = 0.059
    cloud_loss: float = 0.72
    cloud_power: float = 3.2
    lowest_transmittance: float = 0.16
    haze_humidity: float = 55.0
    haze_scale: float = 230.0
    lowest_haze: float = 0.82
    uv_scale: float = 11.0
    uv_highest: float = 10.5
    uv_power: float = 1.25
    uv_cloud_loss: float = 0.55
    uv_cloud_power: float = 2.2
    diffuse_base: float = 0.22
    diffuse_cloud: float = 0.42
    diffuse_lowest: float = 0.18
    diffuse_highest: float = 0.72


@dataclass(frozen=True)
class LoadProfile:
    """Household demand shape; bumps are (height, centre, width)."""

    base_kw: float = 0.18
    morning: tuple[float, float, float] = (0.55, 7.5, 1.7)
    evening: tuple[float, float, float] = (0.85, 19.5, 2.6)
    midday: tuple[float, float, float] = (0.16, 13.0, 2.8)
    weekend_bias: float = 0.06
    weekend_hours: tuple[int, int] = (10, 16)
    winter_bias: float = 0.10
    winter_peak_day: int = 15


@dataclass(frozen=True)
class AlertThresholds:
    """Alert limits."""

    critical_anomalies: int = 1
    warning_anomalies: int = 5
    data_delay_hours: float = 2.0
    quality_pct: float = 90.0
    quality_days: int = 3


@dataclass(frozen=True)
class ChoiceWeights:
    """Weights of the scenario ranking and their adjustments."""

    base: dict = field(
        default_factory=lambda: {
            "payback": 0.22,
            "value": 0.20,
            "coverage": 0.18,
            "self_consumption": 0.14,
            "capex": 0.14,
            "production": 0.12,
        }
    )
    profile: dict = field(
        default_factory=lambda: {
            "homeowner": {
                "payback": 0.10, "capex": 0.10, "self_consumption": 0.04,
                "value": -0.08, "production": -0.05,
            },
            "small_business": {
                "value": 0.08, "coverage": 0.06, "production": 0.04,
                "capex": -0.03, "self_consumption": -0.02,
            },
            "big_business": {
                "value": 0.14, "coverage": 0.10, "production": 0.08,
                "capex": -0.08, "self_consumption": -0.04,
            },
        }
    )
    priority: dict = field(
        default_factory=lambda: {
            "payback": {"payback": 0.28, "capex": 0.12, "value": -0.10, "production": -0.04},
            "value": {"value": 0.30, "production": 0.08, "capex": -0.08, "payback": -0.06},
            "coverage": {
                "coverage": 0.28, "production": 0.10, "self_consumption": 0.04, "capex": -0.06,
            },
        }
    )
    horizon: dict = field(
        default_factory=lambda: {
            "short": {"payback": 0.18, "capex": 0.12, "value": -0.12, "production": -0.05},
            "medium": {},
            "long": {
                "value": 0.16, "coverage": 0.08, "production": 0.08,
                "capex": -0.08, "payback": -0.08,
            },
        }
    )
    # None = no limit
    budget: dict = field(
        default_factory=lambda: {"lean": 4500.0, "balanced": 7200.0, "premium": None}
    )
    over_budget: float = -0.45
    top_k: int = 4
