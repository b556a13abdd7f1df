"""Facts from changes, and moments that merge, against whole passes."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from signalgrid.functions import HexGrid
from signalgrid.operators import deltas, facts, late, moments
from signalgrid.sources import tables

GRID = HexGrid(edge_km=2.0)
DAY = dt.date(2024, 1, 1)
ROWS = (
    "event_date date, event_hour int, device_code string, time_ms bigint, lat double, lng double,"
    "cell_code string, p_cell_rsrp double, version int"
)


@pytest.fixture(scope="module")
def cells(spark):
    known = [("C1", 21.0, 105.8), ("C2", 21.02, 105.83)]
    return spark.createDataFrame(known, "cell_id string, station_lat double, station_lng double")


def measured(rng, version, keys):
    """One row per key: some without level, position or cell, some with a NaN level."""
    return [
        (
            DAY,
            hour,
            device,
            ms,
            rng.choice([21.0, 21.01, 21.05, None]),
            105.8 + rng.randrange(5) / 100,
            rng.choice(["C1", "c 1", "C2", "C3", None]),
            rng.choice([None, float("nan"), 0.0, -0.0, *(-120 + i / 4 for i in range(80))]),
            version,
        )
        for hour, device, ms in keys
    ]


def keys(rng, count):
    return sorted({(rng.randrange(4), f"d{rng.randrange(6)}", rng.randrange(40)) for _ in range(count)})


def same_facts(got, want):
    def table(df):
        return sorted((tuple(None if isinstance(x, float) and math.isnan(x) else x for x in row) for row in df.collect()), key=repr)

    assert got.columns == want.columns
    assert table(got) == table(want)


def plain(df):
    """NaN levels are missing levels, as parts take them."""
    level = F.col("p_cell_rsrp")
    return df.withColumn("p_cell_rsrp", F.when(~F.isnan(level), level + F.lit(0.0)))


def test_parts_give_the_facts_of_their_rows(spark, cells):
    rng = random.Random(1)
    rows = spark.createDataFrame(measured(rng, 0, keys(rng, 400)), ROWS)
    stored = deltas.parts(rows, cells, GRID)
    same_facts(deltas.to_facts(stored, GRID), facts.hourly(plain(rows), cells, GRID))
    day = ["event_date"]
    same_facts(deltas.to_facts(stored, GRID, hour=day), facts.hourly(plain(rows), cells, GRID, hour=day))
    assert deltas.to_facts(stored.limit(0), GRID).isEmpty()


def test_changes_keep_facts_equal_to_a_full_rebuild(spark, cells, tmp_path):
    rng = random.Random(2)
    silver = spark.createDataFrame(measured(rng, 0, keys(rng, 300)), ROWS)
    path = str(tmp_path / "parts")
    tables.write_table(deltas.parts(silver, cells, GRID), path, ["event_date", "event_hour"])
    for version in (1, 2, 3):
        # Late rows of one or two hours: new keys, keys that replace, and several versions of one.
        wanted = [key for key in keys(rng, 120) if key[0] in (version % 4, 3)]
        arrivals = measured(rng, version * 10, wanted) + measured(rng, version * 10 + 1, wanted[::3])
        arrivals = spark.createDataFrame(arrivals, ROWS)
        changed = deltas.changes(silver, arrivals, cells, GRID, newest=["version"])
        touched = deltas.add_to_table(path, changed)
        assert {row.event_hour for row in touched.collect()} <= {version % 4, 3}
        silver = tables.materialise(late.merge_all(silver, arrivals, newest=["version"]))
        stored = tables.read_table(spark, path)
        same_facts(deltas.to_facts(stored, GRID), facts.hourly(plain(silver), cells, GRID))
    before = sorted(map(tuple, stored.collect()), key=repr)
    deltas.add_to_table(path, deltas.changes(silver, silver.limit(0), cells, GRID, newest=["version"]))
    assert sorted(map(tuple, tables.read_table(spark, path).collect()), key=repr) == before


def test_rows_that_go_leave_nothing_behind(spark, cells):
    rng = random.Random(3)
    one = [(1, "a", 1)]
    silver = spark.createDataFrame(measured(rng, 0, one), ROWS).withColumn("lat", F.lit(21.0))
    away = silver.withColumns({"lat": F.lit(21.5), "version": F.lit(1)})
    stored = deltas.parts(silver, cells, GRID)
    after = deltas.add(stored, deltas.changes(silver, away, cells, GRID, newest=["version"]))
    assert after.count() == 1 and after.first().row_count == 1
    # The same row again changes nothing.
    assert deltas.changes(silver, silver, cells, GRID, newest=["version"]).isEmpty()


VALUES = "hour int, cell_id string, value double"


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_moments_merge_to_those_of_one_pass(spark, offset):
    rng = random.Random(4)
    rows = [(rng.randrange(24), rng.choice(["A", "B", None]), offset + rng.gauss(3, 2)) for _ in range(3000)]
    rows += [(1, "A", None), (2, "A", float("nan")), (3, "D", None), (4, "E", offset)]
    hours = moments.moments(spark.createDataFrame(rows, VALUES), ["hour", "cell_id"], F.col("value")).cache()
    halves = moments.merged(hours.withColumn("half", F.col("hour") % 2), ["half", "cell_id"])
    for found in (moments.merged(hours, ["cell_id"]), moments.merged(halves, ["cell_id"])):
        found = {row.cell_id: row for row in found.withColumn("sd", moments.sample_deviation()).collect()}
        assert set(found) == {"A", "B", None, "D", "E"}
        assert (found["D"].n, found["D"].mean, found["D"].sd) == (0, None, None)
        assert (found["E"].n, found["E"].mean, found["E"].sd) == (1, offset, None)
        for cell in ("A", "B", None):
            own = [v for _, c, v in rows if c == cell and v is not None and not math.isnan(v)]
            assert found[cell].n == len(own)
            assert found[cell].mean == pytest.approx(statistics.fmean(own), rel=1e-12)
            assert found[cell].sd == pytest.approx(statistics.stdev(own), rel=1e-6)
    assert moments.merged(hours.limit(0), ["cell_id"]).isEmpty()


def test_moments_of_rows_are_taken_out_again(spark):
    rng = random.Random(5)
    rows = [(hour, "A", rng.gauss(0, 5)) for hour in range(4) for _ in range(50)]
    hours = moments.moments(spark.createDataFrame(rows, VALUES), ["hour", "cell_id"], F.col("value"))
    gone = moments.negative(hours.where("hour = 2"))
    left = moments.merged(hours.unionByName(gone), ["cell_id"]).withColumn("sd", moments.sample_deviation()).first()
    own = [v for hour, _, v in rows if hour != 2]
    assert left.n == 150 and left.mean == pytest.approx(statistics.fmean(own))
    assert left.sd == pytest.approx(statistics.stdev(own), rel=1e-9)
