"""Schemas of the input files and of the stored tables."""

from __future__ import annotations

# Columns of a measurement file with their types; further columns pass through as text.
MEASUREMENT_COLUMNS = {
    "device_code": "string",
    "time_ms": "bigint",
    "lat": "double",
    "lng": "double",
    "cell_code": "string",
    "p_cell_rsrp": "double",
    "p_cell_rsrq": "double",
}

# Columns of a cell configuration file: x is the latitude, y the longitude.
CELL_COLUMNS = {
    "cell_code": "string",
    "x": "double",
    "y": "double",
    "station_code": "string",
    "azimuth": "double",
    "province_name": "string",
    "district_name": "string",
}

# Two rows with the same six values are copies of one measurement.
COPY_KEYS = ("device_code", "lat", "lng", "cell_code", "p_cell_rsrp", "p_cell_rsrq")

BATCH = ("batch_date", "batch_hour")
EVENT_HOUR = ("event_date", "event_hour")

FORECAST_VALUES = (
    "forecast_density",
    "forecast_lower",
    "forecast_upper",
    "forecast_rsrp",
    "forecast_rsrp_lower",
    "forecast_rsrp_upper",
)
