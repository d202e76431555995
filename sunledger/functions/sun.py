"""Sun position and irradiance as SQL expressions over columns of the same row.

Each dictionary maps a new column to its expression, in an order in which one
step may only use columns of the steps before it.  Angles are in degrees
unless the name ends in ``_rad``; azimuth 0 is north, the surface azimuth is
counted from south.
"""

from __future__ import annotations

from sunledger import constants as C

_SKY = C.Sky()
_SIN2, _COS, _SIN = _SKY.equation_of_time

# needs: ts_local, utc_offset_hours, latitude, longitude
POSITION_STEPS = (
    {
        "day_of_year": "dayofyear(ts_local)",
        "lat_rad": "radians(latitude)",
        "clock": "hour(ts_local) + minute(ts_local) / 60D + second(ts_local) / 3600D",
    },
    {
        "season_rad": f"radians(360D / 364D * (day_of_year - {_SKY.equinox_day}D))",
        "decl_rad": f"radians({_SKY.tilt_of_earth}D * sin(radians(360D * (284 + day_of_year) / 365D)))",
    },
    {
        "equation_of_time": f"{_SIN2}D * sin(2 * season_rad) - {_COS}D * cos(season_rad) "
        f"- {_SIN}D * sin(season_rad)",
    },
    {
        "hour_rad": "radians(15D * (clock + (4D * (longitude - 15D * utc_offset_hours) "
        "+ equation_of_time) / 60D - 12D))",
    },
    {
        "cos_zenith": "greatest(-1D, least(1D, sin(lat_rad) * sin(decl_rad) "
        "+ cos(lat_rad) * cos(decl_rad) * cos(hour_rad)))",
    },
    {
        "elevation": "90D - degrees(acos(cos_zenith))",
        "azimuth": "pmod(degrees(atan2(-sin(hour_rad) * cos(decl_rad), "
        "(sin(decl_rad) * cos(lat_rad) - cos(decl_rad) * sin(lat_rad) * cos(hour_rad)) "
        "/ greatest(cos_zenith, 1e-6D))) + 180D, 360D)",
    },
    {"solar_factor": "greatest(0D, sin(radians(greatest(elevation, 0D))))"},
)

# needs also: cloud (percent), humidity, temperature, tilt_deg, azimuth_from_south_deg, albedo
IRRADIANCE_STEPS = (
    {
        "clear_sky": "CASE WHEN solar_factor > 0 "
        f"THEN {_SKY.clear_sky_wm2}D * solar_factor * exp(-{_SKY.extinction}D / solar_factor) ELSE 0D END",
        "transmittance": f"greatest({_SKY.lowest_transmittance}D, least(1D, "
        f"1D - {_SKY.cloud_loss}D * pow(cloud / 100D, {_SKY.cloud_power}D)))",
        "haze": f"greatest({_SKY.lowest_haze}D, least(1D, "
        f"1D - (humidity - {_SKY.haze_humidity}D) / {_SKY.haze_scale}D))",
        "uv": f"CASE WHEN solar_factor > 0 THEN round(greatest(0D, least({_SKY.uv_highest}D, "
        f"{_SKY.uv_scale}D * pow(solar_factor, {_SKY.uv_power}D) "
        f"* (1D - {_SKY.uv_cloud_loss}D * pow(cloud / 100D, {_SKY.uv_cloud_power}D)))), 1) ELSE 0D END",
        "tilt_rad": "radians(tilt_deg)",
        "facing_rad": "radians(azimuth_from_south_deg)",
        "diffuse_share": f"greatest({_SKY.diffuse_lowest}D, least({_SKY.diffuse_highest}D, "
        f"{_SKY.diffuse_base}D + {_SKY.diffuse_cloud}D * cloud / 100D))",
    },
    {
        "ghi": "clear_sky * transmittance * haze",
        "cos_incidence": "greatest(0D, "
        "sin(decl_rad) * (sin(lat_rad) * cos(tilt_rad) - cos(lat_rad) * sin(tilt_rad) * cos(facing_rad)) "
        "+ cos(decl_rad) * cos(hour_rad) "
        "* (cos(lat_rad) * cos(tilt_rad) + sin(lat_rad) * sin(tilt_rad) * cos(facing_rad)) "
        "+ cos(decl_rad) * sin(hour_rad) * sin(tilt_rad) * sin(facing_rad))",
    },
    {
        "poa": "CASE WHEN ghi > 0 AND solar_factor > 0 THEN greatest(0D, "
        "ghi * (1D - diffuse_share) * cos_incidence / greatest(solar_factor, 1e-6D) "
        "+ ghi * diffuse_share * (1D + cos(tilt_rad)) / 2D "
        "+ ghi * albedo * (1D - cos(tilt_rad)) / 2D) ELSE 0D END",
    },
)

# needs also: noct_c, temp_coefficient, system_size_kw, derating_factor, calibration
PANEL_STEPS = (
    {"cell": "temperature + (noct_c - 20D) / 800D * poa"},
    {
        "cell_efficiency": "CASE WHEN cell <= 25 THEN 1D "
        "ELSE greatest(0D, 1D - (cell - 25D) * temp_coefficient) END",
    },
    {
        "kw": "greatest(0D, system_size_kw * poa / 1000D * derating_factor * calibration "
        "* cell_efficiency)",
    },
)
