"""Date, hexagon and cell dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalgrid.functions import HexGrid, normalize_key
from signalgrid.functions.geo import KM_PER_DEGREE_LAT
from signalgrid.operators.lookups import newest_per_key
from signalgrid.settings import Limits


def span(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A one-row frame ``(first_day, last_day)`` for :func:`date_dim`."""
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )


def date_dim(days: DataFrame) -> DataFrame:
    """One row per day of a one-row span; Sunday is day 1 of the week."""
    day = F.col("day")
    return days.select(F.explode(F.sequence("first_day", "last_day")).alias("day")).select(
        F.date_format(day, "yyyy-MM-dd").alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def box(
    spark: SparkSession, lat: tuple[float, float], lng: tuple[float, float]
) -> DataFrame:
    """A one-row frame ``(lat_min, lat_max, lng_min, lng_max)`` for :func:`hex_dim`."""
    edges = {"lat_min": lat[0], "lat_max": lat[1], "lng_min": lng[0], "lng_max": lng[1]}
    return spark.range(1).select(*(F.lit(float(v)).alias(k) for k, v in edges.items()))


def covered_box(measurements: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The box around all measurements that lie inside the country."""
    return measurements.where(
        F.col("lat").between(*limits.lat) & F.col("lng").between(*limits.lng)
    ).agg(
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min("lng").alias("lng_min"),
        F.max("lng").alias("lng_max"),
    )


def hex_dim(bounds: DataFrame, grid: HexGrid = HexGrid(), tasks: int = 64) -> DataFrame:
    """All hexagons whose centre lies in a one-row box.

    The rows of the grid are spread over ``tasks`` first and filled there, so a whole
    country never passes through one task.
    """
    row_per_degree = KM_PER_DEGREE_LAT / grid.row_km
    first_row = F.floor((F.col("lat_min") - grid.lat0) * row_per_degree) - 1
    last_row = F.ceil((F.col("lat_max") - grid.lat0) * row_per_degree) + 1
    rows = bounds.select("*", F.explode(F.sequence(first_row, last_row)).alias("hex_r"))
    rows = rows.repartition(tasks, "hex_r")
    column_per_degree = grid.km_per_lng / grid.column_km
    shift = F.col("hex_r") / 2
    first_column = F.floor((F.col("lng_min") - grid.lng0) * column_per_degree - shift) - 1
    last_column = F.ceil((F.col("lng_max") - grid.lng0) * column_per_degree - shift) + 1
    cells = rows.select("*", F.explode(F.sequence(first_column, last_column)).alias("hex_q"))
    q, r = F.col("hex_q"), F.col("hex_r")
    centred = cells.withColumns(
        {
            "hex_id": grid.text_id(q, r),
            "hex_center_lat": grid.centre_lat(r),
            "hex_center_lng": grid.centre_lng(q, r),
        }
    )
    return centred.where(
        F.col("hex_center_lat").between(F.col("lat_min"), F.col("lat_max"))
        & F.col("hex_center_lng").between(F.col("lng_min"), F.col("lng_max"))
    ).select("hex_id", "hex_center_lat", "hex_center_lng")


def cell_dim(cells: DataFrame, newest: Sequence[str] = ()) -> DataFrame:
    """Cell dimension from configuration rows, one row per normalised key.

    ``newest`` names columns that order the rows of one cell; the last one is kept.
    """
    named = cells.select(
        normalize_key(F.col("cell_code")).alias("cell_id"),
        F.col("cell_code"),
        F.col("x").cast("double").alias("station_lat"),
        F.col("y").cast("double").alias("station_lng"),
        F.col("station_code").cast("string").alias("sector_code"),
        F.col("azimuth").cast("double").alias("azimuth"),
        F.col("province_name"),
        F.col("district_name"),
        *newest,
    )
    return newest_per_key(named, ["cell_id"], newest).drop(*newest)


def sector_polygons(
    cells: DataFrame, radius_degrees: float = 0.005, half_angle: float = 30.0
) -> DataFrame:
    """The antenna sector of each cell as a closed triangle of ``(lng, lat)`` points."""

    def corner(turn: float):
        angle = F.radians(F.col("azimuth") + turn)
        return F.struct(
            (F.col("station_lng") + radius_degrees * F.sin(angle)).alias("lng"),
            (F.col("station_lat") + radius_degrees * F.cos(angle)).alias("lat"),
        )

    station = F.struct(
        F.col("station_lng").alias("lng"), F.col("station_lat").alias("lat")
    )
    ring = F.array(station, corner(-half_angle), corner(half_angle), station)
    return cells.select("cell_id", ring.alias("ring"))
