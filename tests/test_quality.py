from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from signalgrid.operators import quality
from signalgrid.operators.enrich import with_distance
from signalgrid.plans.derived import Tables

SF = "/root/testdata/sf0.01"
ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


# What the fixture holds by construction.
@pytest.mark.parametrize("scope, clean", [("valid", 5970), ("all", 5996)])
def test_fixture_counts(tables, scope, clean):
    rated = quality.classify(tables.measurements, tables.cells, by=(), order=ORDER, scope=scope)
    row = rated.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_clean").alias("clean"),
        F.count_if(~F.col("is_first_copy")).alias("copies"),
        F.count_if(F.col("distance_to_cell_km") == 9999).alias("unknown"),
        F.count_if(F.col("is_clean").isNull()).alias("undecided"),
    ).first()
    assert tuple(row) == (10200, clean, 200, 2105, 0)


def test_split_is_complete(tables):
    clean, dirty = quality.split(tables.classified)
    assert clean.count() + dirty.count() == 10200
    assert clean.columns == dirty.columns
    assert not {"is_clean", "mean_distance_km", "batch_date", "cell_id"} & set(clean.columns)
    assert "processed_at" in quality.stamp(clean).columns


@pytest.mark.parametrize("by", [(), quality.BATCH])
@pytest.mark.parametrize("scope", ["valid", "all"])
def test_report_agrees_with_rows(tables, by, scope):
    report = quality.report(tables.measurements, tables.cells, by=by, scope=scope)
    rated = quality.classify(tables.measurements, tables.cells, by=by, order=ORDER, scope=scope)
    total = report.agg(F.sum("clean_count"), F.sum("dirty_count"), F.sum("duplicate_count")).first()
    rows = rated.agg(
        F.count_if("is_clean"), F.count_if(~F.col("is_clean")), F.count_if(~F.col("is_first_copy"))
    ).first()
    assert tuple(total) == tuple(rows)


def test_report_with_late_rows_apart(tables):
    report = quality.report(tables.measurements, tables.cells, late_apart=True)
    off = report.where("clean_count + dirty_count <> on_time_count")
    assert off.count() == 0
    on_time = tables.measurements.where(quality.is_on_time())
    rated = quality.classify(on_time, tables.cells, order=ORDER)
    assert report.agg(F.sum("clean_count")).first()[0] == rated.where("is_clean").count()


ROW = dict(
    device_code="d1", lat=21.03, lng=105.81, cell_code="c click", p_cell_rsrp=-90.0,
    p_cell_rsrq=-10.0, event_date=dt.date(2024, 1, 1), event_hour=3,
    batch_date=dt.date(2024, 1, 1), batch_hour=3,
)
SCHEMA = (
    "device_code string, lat double, lng double, cell_code string, p_cell_rsrp double,"
    "p_cell_rsrq double, event_date date, event_hour int, batch_date date, batch_hour int"
)


def frame(spark, *changes):
    return spark.createDataFrame([ROW | c for c in changes], SCHEMA)


@pytest.mark.parametrize(
    "change, clean",
    [
        ({}, True),
        ({"lat": None}, False),
        ({"lat": 0.0}, False),
        ({"lat": 25.0}, False),
        ({"lng": 101.0}, False),
        ({"p_cell_rsrp": None}, False),
        ({"p_cell_rsrq": None}, False),
        ({"p_cell_rsrp": -44.0}, True),
        ({"p_cell_rsrp": -43.9}, False),
        ({"cell_code": "nowhere"}, False),
        ({"cell_code": None}, False),
        ({"cell_code": "C C\tLICK"}, True),
        ({"lat": 21.6}, False),
        ({"event_hour": None}, True),
    ],
)
def test_verdict_of_single_rows(spark, tables, change, clean):
    """One-row cells: no deviation, and the device may stand at the station itself."""
    rated = quality.classify(frame(spark, change), tables.cells).collect()
    assert [r.is_clean for r in rated] == [clean]
    report = quality.report(frame(spark, change), tables.cells).first()
    assert report.clean_count == int(clean)


def test_three_sigma(spark, tables):
    # Twenty devices near the station, one 22 km off: inside 50 km, outside three sigma.
    near = [{"device_code": f"d{i}", "lat": 21.03 + i * 1e-4} for i in range(20)]
    rated = quality.classify(frame(spark, *near, {"device_code": "far", "lat": 21.23}), tables.cells)
    assert [r.device_code for r in rated.where("NOT is_clean").collect()] == ["far"]
    with pytest.raises(ValueError):
        quality.distance_stats(with_distance(frame(spark, {}), tables.cells), scope="some")


def test_equal_distances_are_no_outliers(spark, tables):
    rows = [{"device_code": f"d{i}", "lat": 21.07} for i in range(7)]
    rated = quality.classify(frame(spark, *rows), tables.cells)
    assert rated.where("is_clean").count() == 7
    assert quality.report(frame(spark, *rows), tables.cells).first().clean_count == 7


def test_rules_on_nulls(spark):
    card = quality.scorecard(frame(spark, {"cell_code": None, "lat": None}))
    rules = {(r.rule, r.rule_column): r for r in card.collect()}
    assert len(rules) == 11
    assert not rules["not_null", "lat"].passed
    # No value to look at: nothing observed, nothing failed.
    assert rules["between", "lat"].observed is None and rules["between", "lat"].passed
    assert rules["length", "cell_code"].passed


def test_uniqueness_counts_all_copies(spark):
    card = quality.scorecard(frame(spark, {}, {}, {"device_code": "d2"}, {"device_code": "d3"}))
    unique = card.where("rule = 'unique'").first()
    assert unique.observed == 0.5 and not unique.passed
    nothing = dict.fromkeys(quality.COPY_KEYS)
    empty = quality.scorecard(frame(spark, nothing, nothing)).where("rule = 'unique'").first()
    assert empty.observed is None and empty.passed


def test_gate_and_audit(spark, tables):
    reports = tables.reports
    below = quality.failing(reports, 80.0)
    assert below.where("success_rate >= 80").count() == 0
    assert 0 < below.count() < reports.count()
    hours = [r.batch_hour for r in quality.audit(reports, "2024-01-24").collect()]
    assert hours == list(range(24))


def test_empty_input(spark, tables):
    nothing = frame(spark, {}).limit(0)
    assert quality.classify(nothing, tables.cells).count() == 0
    assert quality.report(nothing, tables.cells).count() == 0
    assert quality.scorecard(nothing).count() == 0
    assert quality.partition_inventory(nothing).count() == 0
