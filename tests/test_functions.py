from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from signalgrid.functions import (
    HexGrid,
    clip,
    great_circle_km,
    hour_label,
    iso_weekday,
    load_band,
    local_time,
    normalize_key,
    percent_error,
    record_time,
    rsrp_band,
)


def test_times_and_places_that_cannot_be(spark):
    row = one(
        spark,
        micro=local_time(F.lit(1747008000123000)),
        negative=local_time(F.lit(-1)),
        last=local_time(F.lit(4102444799999)),
        nowhere=great_circle_km(F.lit(math.nan), F.lit(1.0), F.lit(1.0), F.lit(1.0)),
        here=great_circle_km(F.lit(21.0), F.lit(105.8), F.lit(21.0), F.lit(105.8)),
    )
    assert row.micro is None and row.negative is None and row.last is not None
    assert row.nowhere is None and row.here == 0.0


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_normalize_key(spark):
    row = one(
        spark,
        a=normalize_key(F.lit("c\t1 2 ")),
        b=normalize_key(F.lit(None).cast("string")),
    )
    assert (row.a, row.b) == ("C12", None)


def test_local_time_cuts_to_seconds_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            row = one(spark, t=local_time(F.lit(1747008000999)), none=local_time(F.lit(None)))
            assert row.t == dt.datetime(2025, 5, 12, 7, 0, 0)
            assert row.none is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hours_and_weekdays(spark):
    sunday = F.lit("2024-01-28").cast("date")
    row = one(
        spark,
        t=record_time(sunday, F.lit(7)),
        w=iso_weekday(sunday),
        label=hour_label(F.lit(7)),
    )
    assert row.t == dt.datetime(2024, 1, 28, 7)
    assert (row.w, row.label) == (7, "07:00")


def haversine(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2
    h += math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(h))


def test_distance(spark):
    points = [
        (21.03, 105.81, 21.03, 105.81),
        (21.0, 105.8, 22.0, 105.8),
        (10.5, 106.7, 21.0, 105.8),
        (0.0, 0.0, 0.0, 180.0),
    ]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    rows = df.withColumn("km", great_circle_km(*(F.col(c) for c in "abcd"))).collect()
    for point, row in zip(points, rows):
        assert row.km == pytest.approx(haversine(*point), abs=1e-3)
        assert not math.isnan(row.km)
    missing = one(spark, km=great_circle_km(F.lit(None), F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    assert missing.km is None


def test_same_point_never_gives_nan(spark):
    grid = spark.range(20000).select((8.5 + F.col("id") * 0.000745).alias("x"))
    x = F.col("x")
    km = grid.select(great_circle_km(x, x + 90, x, x + 90).alias("km"))
    assert km.where(F.isnan("km") | F.col("km").isNull()).count() == 0
    assert km.agg(F.max("km")).first()[0] < 1e-3


@pytest.mark.parametrize("edge", [0.174, 0.2, 4.0])
def test_hex_centre_maps_to_itself(spark, edge):
    grid = HexGrid(edge_km=edge)
    ids = spark.range(-40, 40).select(F.col("id").alias("q")).join(
        spark.range(-40, 40).select(F.col("id").alias("r"))
    )
    centred = ids.select(
        "q",
        "r",
        grid.centre_lat(F.col("r")).alias("lat"),
        grid.centre_lng(F.col("q"), F.col("r")).alias("lng"),
    )
    moved = grid.assign(centred).where("hex_q <> q OR hex_r <> r")
    assert moved.count() == 0


def test_hex_is_the_nearest_centre(spark):
    grid = HexGrid(edge_km=1.0)
    points = spark.range(400).select(
        (16 + F.rand(1) * 0.1).alias("lat"), (105.8 + F.rand(2) * 0.1).alias("lng")
    )
    for row in grid.assign(points).collect():
        def km(q, r, row=row):
            x = grid.column_km * (q + r / 2) - (row.lng - 105.8) * grid.km_per_lng
            y = grid.row_km * r - (row.lat - 16) * 110.574
            return math.hypot(x, y)

        own = km(row.hex_q, row.hex_r)
        around = [
            km(row.hex_q + dq, row.hex_r + dr) for dq in (-1, 0, 1) for dr in (-1, 0, 1)
        ]
        assert own <= min(around) + 1e-9


def test_bad_points_have_no_hex(spark):
    points = [(None, 105.0), (21.0, None), (float("nan"), 105.0), (95.0, 105.0), (21.0, 200.0)]
    df = spark.createDataFrame(points, "lat double, lng double")
    for row in HexGrid().assign(df).collect():
        assert row.hex_q is None and row.hex_r is None


def test_bands(spark):
    # Each edge belongs to the band above it, but -85 to the one below.
    want = {
        -110.1: "very_poor",
        -110.0: "poor",
        -105.0: "weak",
        -100.0: "fair",
        -95.0: "good",
        -85.0: "good",
        -84.9: "excellent",
    }
    df = spark.createDataFrame([(k,) for k in want], "v double")
    got = {r.v: r.band for r in df.withColumn("band", rsrp_band(F.col("v"))).collect()}
    assert got == want
    loads = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 4.0, 6.0, 8.0, 10.0)], "v double")
    codes = [r[0] for r in loads.select(load_band(F.col("v"), F.lit(10.0))).collect()]
    assert codes == [0, 1, 2, 3, 4, 5, 5]


def test_clip_and_error_keep_nulls(spark):
    none = F.lit(None).cast("double")
    row = one(
        spark,
        a=clip(F.lit(-1.0), 0.0),
        b=clip(none, 0.0, 1.0),
        c=clip(F.lit(5.0), 0.0, 1.0),
        d=percent_error(F.lit(0), F.lit(-3.0)),
        e=percent_error(F.lit(4), F.lit(-1.0)),
    )
    assert (row.a, row.b, row.c, row.d, row.e) == (0.0, None, 1.0, 0.0, 25.0)
