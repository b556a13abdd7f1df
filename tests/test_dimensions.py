from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from signalgrid.functions import HexGrid
from signalgrid.operators import dimensions
from signalgrid.plans.derived import CELL_VALUES, GRID, Tables


def test_date_dim(spark):
    days = dimensions.date_dim(dimensions.span(spark, "2020-01-01", "2030-12-31"))
    assert days.count() == 4018
    row = days.where("date_key = '2024-02-29'").first()
    assert tuple(row) == ("2024-02-29", 2024, 2, 29, 5, "Thursday")
    assert days.where("day_of_week = 1").select("day_name").distinct().collect() == [("Sunday",)]


@pytest.mark.parametrize("edge", [0.2, 1.0])
def test_hex_dim_against_brute_force(spark, edge):
    grid = HexGrid(edge_km=edge)
    lat, lng = (20.95, 21.05), (105.75, 105.9)
    got = dimensions.hex_dim(dimensions.box(spark, lat, lng), grid, tasks=4)
    ids = [r.hex_id for r in got.collect()]
    want = set()
    rows = range(math.floor((lat[0] - 16) * 110.574 / grid.row_km) - 5,
                 math.ceil((lat[1] - 16) * 110.574 / grid.row_km) + 5)
    for r in rows:
        y = 16 + r * grid.row_km / 110.574
        middle = -r / 2
        width = math.ceil(0.2 * grid.km_per_lng / grid.column_km) + 5
        for q in range(math.floor(middle) - width, math.ceil(middle) + width):
            x = 105.8 + (q + r / 2) * grid.column_km / grid.km_per_lng
            if lat[0] <= y <= lat[1] and lng[0] <= x <= lng[1]:
                want.add(f"{q}:{r}")
    assert len(ids) == len(set(ids))
    assert set(ids) == want


def test_hex_centres_return_their_id(spark):
    bounds = dimensions.box(spark, (20.9, 21.3), (105.7, 106.0))
    hexes = dimensions.hex_dim(bounds, GRID)
    back = GRID.assign(hexes, "hex_center_lat", "hex_center_lng")
    wrong = back.where(F.col("hex_id") != GRID.text_id(F.col("hex_q"), F.col("hex_r")))
    assert wrong.count() == 0 and back.count() > 10000


def test_every_measured_hex_is_in_the_dimension_or_on_its_rim(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    inside = tables.measurements.where("lat > 21.01 AND lat < 21.05 AND lng BETWEEN 105.81 AND 105.84")
    used = GRID.assign(inside).select(GRID.text_id(F.col("hex_q"), F.col("hex_r")).alias("hex_id"))
    assert used.join(tables.hexes, "hex_id", "left_anti").count() == 0


def test_cell_dim_merges_spellings(spark):
    raw = spark.sql(CELL_VALUES)
    other = raw.withColumn("cell_code", F.lower("cell_code")).withColumn("azimuth", F.lit(1.0))
    both = raw.withColumn("v", F.lit(1)).unionByName(other.withColumn("v", F.lit(2)))
    dim = dimensions.cell_dim(both, ["v"])
    assert dim.count() == 4
    assert {r.azimuth for r in dim.collect()} == {1.0}
    assert dim.columns == [
        "cell_id", "cell_code", "station_lat", "station_lng",
        "sector_code", "azimuth", "province_name", "district_name",
    ]


def test_sector_is_a_closed_triangle(spark):
    cells = dimensions.cell_dim(spark.sql(CELL_VALUES))
    for row in dimensions.sector_polygons(cells).join(cells, "cell_id").collect():
        station, left, right, end = row.ring
        assert station == end == (row.station_lng, row.station_lat)
        for corner, turn in ((left, -30), (right, 30)):
            angle = math.radians(row.azimuth + turn)
            assert corner.lng == pytest.approx(row.station_lng + 0.005 * math.sin(angle))
            assert corner.lat == pytest.approx(row.station_lat + 0.005 * math.cos(angle))
