"""Hexagons inside polygons, by scan lines over the rows of the grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from signalgrid.functions import HexGrid
from signalgrid.functions.geo import KM_PER_DEGREE_LAT


def _edges(polygons: DataFrame, keys: Sequence[str], rings: str) -> DataFrame:
    """Edges ``a`` to ``b`` of all rings, the closing one included."""
    known = F.forall(
        rings,
        lambda ring: F.forall(
            ring, lambda p: p["lat"].between(-90, 90) & p["lng"].between(-180, 180)
        ),
    )
    ring = F.col("_ring")
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return (
        polygons.where(known)
        .select(*keys, F.explode(rings).alias("_ring"))
        .where(F.size("_ring") > 0)
        .select(*keys, F.inline(F.zip_with(ring, following, lambda a, b: F.struct(a.alias("_a"), b.alias("_b")))))
    )


def hex_fill(
    polygons: DataFrame,
    keys: Sequence[str],
    grid: HexGrid = HexGrid(),
    rings: str = "rings",
    tasks: int = 64,
) -> DataFrame:
    """The hexagons whose centre lies inside a polygon: keys, hex_id and centre.

    ``rings`` holds arrays of ``(lng, lat)`` points, closed or not. A point is inside if a line
    to the west crosses an odd number of edges, so holes (and islands in them) are rings like
    any other, whichever way they turn. A centre on a western or southern edge is inside, one on an
    eastern or northern edge is not; polygons that share a border share no hexagon.

    Rows with equal keys are parts of one polygon; a null key is a key. A row with a null or
    impossible point, or a null ring, fills nothing. A ring of one or two points encloses
    nothing.

    Each edge is cut with the rows of the grid it spans, and the cuts of a row meet by a
    shuffle. What is grouped is the cuts of one polygon and row; hexagons are written out
    between two cuts, none outside is made and thrown away but two at each end.
    """
    lat_a, lat_b = F.col("_a.lat"), F.col("_b.lat")
    row_per_degree = KM_PER_DEGREE_LAT / grid.row_km
    first_row = F.floor((F.least(lat_a, lat_b) - grid.lat0) * row_per_degree) - 1
    last_row = F.ceil((F.greatest(lat_a, lat_b) - grid.lat0) * row_per_degree) + 1
    cut = F.col("_a.lng") + (F.col("_y") - lat_a) / (lat_b - lat_a) * (F.col("_b.lng") - F.col("_a.lng"))
    cuts = (
        _edges(polygons, keys, rings)
        .where(lat_a != lat_b)
        .select("*", F.explode(F.sequence(first_row, last_row)).alias("_r"))
        .withColumn("_y", grid.centre_lat(F.col("_r")))
        # Half open, so a corner on a line is cut once.
        .where((lat_a <= F.col("_y")) != (lat_b <= F.col("_y")))
        .select(*keys, "_r", cut.alias("_x"))
    )
    lines = (
        cuts.repartition(tasks, *keys, "_r")
        .groupBy(*keys, "_r")
        .agg(F.sort_array(F.collect_list("_x")).alias("_cuts"))
    )
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("_cuts") - 1, F.lit(2)),
        lambda i: F.struct(
            F.element_at("_cuts", i).alias("_from"), F.element_at("_cuts", i + 1).alias("_to")
        ),
    )
    column_per_degree = grid.km_per_lng / grid.column_km
    shift = F.col("_r") / 2
    first_column = F.floor((F.col("_from") - grid.lng0) * column_per_degree - shift) - 1
    last_column = F.ceil((F.col("_to") - grid.lng0) * column_per_degree - shift) + 1
    return (
        lines.select(*keys, "_r", F.inline(pairs))
        .select("*", F.explode(F.sequence(first_column, last_column)).alias("_q"))
        .withColumns(
            {
                "hex_center_lat": grid.centre_lat(F.col("_r")),
                "hex_center_lng": grid.centre_lng(F.col("_q"), F.col("_r")),
            }
        )
        .where((F.col("hex_center_lng") >= F.col("_from")) & (F.col("hex_center_lng") < F.col("_to")))
        .select(
            *keys,
            grid.text_id(F.col("_q"), F.col("_r")).alias("hex_id"),
            "hex_center_lat",
            "hex_center_lng",
        )
    )
