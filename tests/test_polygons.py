from __future__ import annotations

import random

import pytest

from signalgrid.functions import HexGrid
from signalgrid.operators import dimensions, polygons

GRID = HexGrid(edge_km=0.4)
SCHEMA = "name string, rings array<array<struct<lng: double, lat: double>>>"


def filled(spark, *rows):
    return polygons.hex_fill(spark.createDataFrame(list(rows), SCHEMA), ["name"], GRID, tasks=4)


def ids(df):
    found = [(r.name, r.hex_id) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def inside(rings, lng, lat):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 <= lat) != (y2 <= lat) and x1 + (lat - y1) / (y2 - y1) * (x2 - x1) <= lng:
                odd = not odd
    return odd


def test_any_rings_against_point_in_polygon(spark):
    rng = random.Random(3)

    def ring(n):
        return [(rng.uniform(105.7, 105.9), rng.uniform(20.9, 21.1)) for _ in range(n)]

    shapes = {f"p{n}": [ring(rng.randint(3, 9)) for _ in range(rng.randint(1, 4))] for n in range(12)}
    centres = dimensions.hex_dim(dimensions.box(spark, (20.85, 21.15), (105.65, 105.95)), GRID, tasks=4).collect()
    want = {
        (name, c.hex_id)
        for name, rings in shapes.items()
        for c in centres
        if inside(rings, c.hex_center_lng, c.hex_center_lat)
    }
    got = ids(filled(spark, *shapes.items()))
    assert got == want and len(want) > 1000


def test_hole_and_closed_ring(spark):
    outer = [(105.7, 20.9), (105.9, 20.9), (105.9, 21.1), (105.7, 21.1)]
    hole = [(105.75, 20.95), (105.75, 21.05), (105.85, 21.05), (105.85, 20.95)]
    whole = ids(filled(spark, ("a", [outer])))
    assert ids(filled(spark, ("a", [outer + outer[:1]]))) == whole
    assert ids(filled(spark, ("a", [outer[::-1]]))) == whole
    assert ids(filled(spark, ("a", [outer, hole]))) == whole - ids(filled(spark, ("a", [hole])))
    # Rows of one key are parts of one polygon.
    assert ids(filled(spark, ("a", [outer]), ("a", [hole]))) == ids(filled(spark, ("a", [outer, hole])))


def test_neighbours_share_no_hexagon(spark):
    # The common border goes through centres.
    middle = 105.8 + GRID.column_km / GRID.km_per_lng * 3
    left = [(105.75, 20.9), (middle, 20.9), (middle, 21.1), (105.75, 21.1)]
    right = [(middle, 20.9), (105.9, 20.9), (105.9, 21.1), (middle, 21.1)]
    both = [(105.75, 20.9), (105.9, 20.9), (105.9, 21.1), (105.75, 21.1)]
    one, other, all_of_them = (
        {i for _, i in ids(filled(spark, ("a", [ring])))} for ring in (left, right, both)
    )
    assert not one & other and one | other == all_of_them


@pytest.mark.parametrize(
    "rings",
    [
        None,
        [],
        [[]],
        [None],
        [[(105.7, 20.9)]],
        [[(105.7, 20.9), (105.9, 21.1)]],
        [[(105.7, 20.9), (105.9, None), (105.9, 21.1)]],
        [[(105.7, 20.9), None, (105.9, 21.1)]],
        [[(105.7, 20.9), (float("nan"), 20.9), (105.9, 21.1)]],
        [[(105.7, 20.9), (float("inf"), 20.9), (105.9, 21.1)]],
    ],
)
def test_nothing_to_fill(spark, rings):
    square = [(105.7, 20.9), (105.8, 20.9), (105.8, 21.0), (105.7, 21.0)]
    got = ids(filled(spark, ("bad", rings), (None, [square])))
    assert {name for name, _ in got} == {None}
    assert {i for _, i in got} == {i for _, i in ids(filled(spark, ("a", [square])))}


def test_no_polygons(spark):
    assert filled(spark).collect() == []
