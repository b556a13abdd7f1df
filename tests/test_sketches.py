"""Quantile sketches of hours and what they are merged to."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from signalgrid.functions import HexGrid
from signalgrid.operators import facts
from signalgrid.plans.derived import EVENTS
from signalgrid.plans.oracle import STATEMENTS
from signalgrid.plans.registry import QUERIES

GRID = HexGrid(edge_km=40.0)
CELLS = "cell_id string, station_lat double, station_lng double"
ROWS = "cell_code string, lat double, lng double, p_cell_rsrp double, event_date date, event_hour int"


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([("C1", 21.0, 105.8), ("C2", 21.0, 105.8)], CELLS)


def measured(spark, n):
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        F.when(i % 3 == 0, "C2").otherwise("C1").alias("cell_code"),
        F.lit(21.0).alias("lat"),
        F.lit(105.8).alias("lng"),
        (-140 + F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 10_000.0).alias("p_cell_rsrp"),
        F.expr("DATE'2024-01-01'").alias("event_date"),
        (i % 24).cast("int").alias("event_hour"),
    )


@pytest.mark.parametrize("size", [64, facts.SKETCH_SIZE])
def test_a_day_from_its_hours_is_within_the_rank_error(spark, cells, size):
    rows = measured(spark, 200_000)
    days = facts.roll_up(facts.sketched(rows, cells, GRID, size=size), ["cell_id", "event_date"])
    for share in (0.1, 0.5, 0.99):
        for day in days.withColumn("level", facts.level_quantile(share)).collect():
            own = rows.where(F.col("cell_code") == day.cell_id)
            below = own.where(F.col("p_cell_rsrp") <= day.level).count() / own.count()
            assert day.user_density_count == day.level_count == own.count()
            assert abs(below - share) <= 2 * facts.rank_error(size)


def test_small_groups_are_exact_in_whatever_steps_they_are_merged(spark, cells):
    rows = measured(spark, 900)
    hours = facts.sketched(rows, cells, GRID).cache()
    steps = facts.roll_up(facts.roll_up(hours, ["cell_id", "event_date", "event_hour"]), ["cell_id"])
    for day in (facts.roll_up(hours, ["cell_id"]), steps):
        for found in day.withColumn("level", facts.level_quantile(0.1)).collect():
            levels = sorted(r.p_cell_rsrp for r in rows.where(F.col("cell_code") == found.cell_id).collect())
            assert found.level == levels[math.ceil(0.1 * len(levels)) - 1]


def test_missing_levels_count_as_rows_only(spark, cells):
    day = measured(spark, 1).select("event_date").first().event_date
    rows = [("C1", 21.0, 105.8, level, day, hour) for level, hour in ((None, 1), (float("nan"), 1), (-90.0, 2), (None, 2))]
    rows += [("C2", 21.0, 105.8, None, day, 1)]
    hours = facts.sketched(spark.createDataFrame(rows, ROWS), cells, GRID)
    days = facts.roll_up(hours, ["cell_id"]).withColumn("level", facts.level_quantile(0.1))
    assert {r.cell_id: (r.user_density_count, r.level_count, r.level) for r in days.collect()} == {
        "C1": (4, 1, -90.0),
        "C2": (1, 0, None),
    }
    assert facts.roll_up(hours.limit(0), ["cell_id"]).isEmpty()


def test_levels_counted_by_hour_make_days_exact(spark, cells):
    rows = measured(spark, 60_000).cache()
    days = facts.roll_up(facts.sketched(rows, cells, GRID, size=64), ["cell_id", "event_date"])
    counts = facts.level_counts(rows, cells, GRID)
    # Sketches of other rows lie all above or all below: the level is still exact.
    other = lambda by: facts.roll_up(
        facts.sketched(rows.withColumn("p_cell_rsrp", F.col("p_cell_rsrp") + by), cells, GRID), ["cell_id", "event_date"]
    )
    levels = {}
    for row in rows.collect():
        levels.setdefault(row.cell_code, []).append(row.p_cell_rsrp)
    for rolled, size in ((days, 64), (other(500), facts.SKETCH_SIZE), (other(-500), facts.SKETCH_SIZE)):
        for share, tenths in ((0.1, 1), (0.5, 5), (1.0, 10)):
            found = facts.exact_quantile(rolled, counts, ["cell_id", "event_date"], share, "p", size).collect()
            want = {cell: sorted(own)[-(-len(own) * tenths // 10) - 1] for cell, own in levels.items()}
            assert {row.cell_id: row.p for row in found} == want
    rows.unpersist()


def test_exact_levels_of_null_keys_missing_levels_and_ties(spark, cells):
    day = measured(spark, 1).select("event_date").first().event_date
    rows = [(None, None, None, float(level), day, level % 24) for level in range(-100, 0)]
    rows += [("C1", 21.0, 105.8, level, day, 1) for level in (None, float("nan"))]
    rows += [("C2", 21.0, 105.8, level, day, hour) for hour in (1, 2) for level in (-0.0, 0.0, 0.0, -7.0)]
    table = spark.createDataFrame(rows, ROWS)
    days = facts.roll_up(facts.sketched(table, cells, GRID, size=16), ["hex_id", "cell_id"])
    found = facts.exact_quantile(days, facts.level_counts(table, cells, GRID), ["hex_id", "cell_id"], 0.3, size=16).collect()
    assert {row.cell_id: (row.user_density_count, row.level) for row in found} == {None: (100, -71.0), "C1": (2, None), "C2": (8, 0.0)}


def test_daily_percentile_of_big_groups_equals_its_sql(spark, tmp_path):
    """Events of a small table 24 times, so that a day of a hexagon and cell has over 1,024 rows."""
    source, name = "/root/testdata/sf0.01/events.parquet", "p10_daily_from_hours"
    events = spark.read.schema(EVENTS).parquet(source)
    step = events.agg(F.max("event_id")).first()[0] + 1
    copies = events.crossJoin(F.broadcast(spark.range(24).withColumnRenamed("id", "copy")))
    copies.withColumn("event_id", F.col("event_id") + F.col("copy") * step).drop("copy").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()), key=str)
    with duckdb.connect() as oracle:
        oracle.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
        want = sorted(oracle.execute(STATEMENTS[name]).fetchall(), key=str)
    assert max(row[3] for row in want) > facts.SKETCH_SIZE
    assert got == want
