"""Column functions: no UDFs, all evaluated inside generated code."""

from signalgrid.functions.bands import clip, load_band, percent_error, rsrp_band, share
from signalgrid.functions.clock import hour_label, iso_weekday, local_time, record_time
from signalgrid.functions.geo import HexGrid, distance_or_sentinel, great_circle_km
from signalgrid.functions.keys import normalize_key

__all__ = [
    "HexGrid",
    "clip",
    "distance_or_sentinel",
    "great_circle_km",
    "hour_label",
    "iso_weekday",
    "load_band",
    "local_time",
    "normalize_key",
    "percent_error",
    "record_time",
    "rsrp_band",
    "share",
]
