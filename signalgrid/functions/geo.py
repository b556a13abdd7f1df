"""Distances and the hexagonal grid, as plain column arithmetic.

The grid bins points on a local equirectangular plane. A hexagon is named by its axial
coordinates ``(q, r)``; the text form is ``'q:r'``. It suits one country; shapes stretch
far away from ``lat0``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS_KM = 6371.0
UNKNOWN_STATION_KM = 9999.0
KM_PER_DEGREE_LAT = 110.574
KM_PER_DEGREE_LNG = 111.32  # on the equator
SQRT3 = math.sqrt(3.0)


def great_circle_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines; null if a point is unknown.

    Rounding can push the cosine of two equal (or opposite) points just outside [-1, 1],
    where ``acos`` gives NaN; the angle is then 0 (or pi). The cosine is looked at again
    only in that case. Nulls stay null, and a NaN coordinate is no known point.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(phi1) * F.sin(phi2) + F.cos(phi1) * F.cos(phi2) * F.cos(
        F.radians(lng2 - lng1)
    )
    edge = (
        F.when(F.isnan(cosine), F.lit(None).cast("double"))
        .when(cosine > 0, F.lit(0.0))
        .otherwise(F.lit(math.pi))
    )
    return F.nanvl(F.acos(cosine), edge) * EARTH_RADIUS_KM


def distance_or_sentinel(distance: Column) -> Column:
    """A station that is not known is treated as infinitely far away."""
    return F.coalesce(distance, F.lit(UNKNOWN_STATION_KM))


@dataclass(frozen=True)
class HexGrid:
    """Pointy-top hexagons of ``edge_km`` around the origin ``(lat0, lng0)``."""

    edge_km: float = 0.2
    lat0: float = 16.0
    lng0: float = 105.8

    @property
    def km_per_lng(self) -> float:
        return KM_PER_DEGREE_LNG * math.cos(math.radians(self.lat0))

    @property
    def row_km(self) -> float:
        """Distance between two neighbouring rows of centres."""
        return 1.5 * self.edge_km

    @property
    def column_km(self) -> float:
        """Distance between two neighbouring centres of one row."""
        return SQRT3 * self.edge_km

    def assign(self, df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
        """Add ``hex_q`` and ``hex_r`` (bigint); null for unknown or impossible points."""
        x = (F.col(lng) - self.lng0) * self.km_per_lng
        y = (F.col(lat) - self.lat0) * KM_PER_DEGREE_LAT
        usable = F.col(lat).between(-90, 90) & F.col(lng).between(-180, 180)
        placed = df.withColumns(
            {
                "_fq": F.when(usable, (SQRT3 / 3 * x - y / 3) / self.edge_km),
                "_fr": F.when(usable, (2 * y / 3) / self.edge_km),
            }
        ).withColumn("_ft", -F.col("_fq") - F.col("_fr"))
        rounded = placed.withColumns(
            {f"_r{axis}": F.round(F.col(f"_f{axis}")) for axis in "qrt"}
        ).withColumns(
            {f"_d{axis}": F.abs(F.col(f"_r{axis}") - F.col(f"_f{axis}")) for axis in "qrt"}
        )
        fix_q = (F.col("_dq") > F.col("_dr")) & (F.col("_dq") > F.col("_dt"))
        fix_r = ~fix_q & (F.col("_dr") > F.col("_dt"))
        q = F.when(fix_q, -F.col("_rr") - F.col("_rt")).otherwise(F.col("_rq"))
        r = F.when(fix_r, -F.col("_rq") - F.col("_rt")).otherwise(F.col("_rr"))
        cell = F.struct(q.cast("bigint").alias("hex_q"), r.cast("bigint").alias("hex_r"))
        # A one-element generator instead of two plain columns: later conditions on the
        # hexagon (joins add "is not null") then stop here. Without it the optimizer would
        # copy the whole arithmetic into each filter, past the size generated code may have.
        return rounded.select(*df.columns, F.inline(F.array(cell)))

    @staticmethod
    def text_id(q: Column, r: Column) -> Column:
        """``'q:r'``, null if either is null."""
        return F.concat(q.cast("string"), F.lit(":"), r.cast("string"))

    def centre_lat(self, r: Column) -> Column:
        return self.lat0 + r * self.row_km / KM_PER_DEGREE_LAT

    def centre_lng(self, q: Column, r: Column) -> Column:
        return self.lng0 + (q + r / 2) * self.column_km / self.km_per_lng
