"""Scalar helpers: clipping, error shares, colour bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper edges (dBm) of the signal classes; the last class is everything above.
RSRP_BANDS = (
    (-110.0, "very_poor"),
    (-105.0, "poor"),
    (-100.0, "weak"),
    (-95.0, "fair"),
)
RSRP_FAIR_TOP = -85.0  # up to and including this value: "good", above it: "excellent"

# Lower edges of the load bands, as a share of the busiest slot.
LOAD_BANDS = ((0.8, 5), (0.6, 4), (0.4, 3), (0.2, 2))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to a range; null stays null (``least``/``greatest`` would skip it)."""
    out = value
    if low is not None:
        out = F.when(value < low, F.lit(float(low))).otherwise(out)
    if high is not None:
        out = F.when(value > high, F.lit(float(high))).otherwise(out)
    return out


def percent_error(actual: Column, error: Column) -> Column:
    """Absolute error in percent of the actual value; 0 where the actual value is 0."""
    return F.when(actual == 0, F.lit(0.0)).otherwise(F.abs(error) / actual * 100)


def share(condition: Column) -> Column:
    """Mean of a yes/no condition over all rows, unknown counted as no."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def rsrp_band(rsrp: Column) -> Column:
    """Signal class of a level in dBm; each band holds its lower edge."""
    band = F.when(rsrp.isNull(), F.lit(None).cast("string"))
    for upper, name in RSRP_BANDS:
        band = band.when(rsrp < upper, name)
    return band.when(rsrp <= RSRP_FAIR_TOP, "good").otherwise("excellent")


def load_band(value: Column, busiest: Column) -> Column:
    """0 for no load, else 1..5 by the share of the busiest slot."""
    ratio = value / F.when(busiest > 0, busiest).otherwise(F.lit(1.0))
    band = F.when(value == 0, 0)
    for edge, code in LOAD_BANDS:
        band = band.when(ratio >= edge, code)
    return band.otherwise(1).cast("int")
