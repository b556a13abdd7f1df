"""Attach cells, distances and hexagons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from signalgrid.functions import distance_or_sentinel, great_circle_km, normalize_key
from signalgrid.operators.lookups import lookup_join

STATION = ("station_lat", "station_lng")


def with_cells(measurements: DataFrame, cells: DataFrame) -> DataFrame:
    """Add the normalised ``cell_id`` and the station's position; unknown cells keep their
    rows with a null position."""
    keyed = measurements.withColumn("cell_id", normalize_key(F.col("cell_code")))
    return lookup_join(keyed, cells, ["cell_id"], take={c: c for c in STATION})


def with_distance(
    measurements: DataFrame, cells: DataFrame, sentinel: bool = True
) -> DataFrame:
    """Add ``distance_to_cell_km``; with ``sentinel`` an unknown distance becomes 9999 km."""
    located = with_cells(measurements, cells)
    distance = great_circle_km(
        F.col("lat"), F.col("lng"), F.col("station_lat"), F.col("station_lng")
    )
    if sentinel:
        distance = distance_or_sentinel(distance)
    return located.withColumn("distance_to_cell_km", distance).drop(*STATION)


def star_join(facts: DataFrame, cells: DataFrame, hexes: DataFrame) -> DataFrame:
    """Facts with the positions of their cell and hexagon."""
    positions = {"station_lat": "cell_lat", "station_lng": "cell_lng"}
    located = lookup_join(facts, cells, ["cell_id"], take=positions)
    return lookup_join(located, hexes, ["hex_id"])
