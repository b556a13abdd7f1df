"""The jobs end to end on a folder of tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from signalgrid.operators import forecast
from signalgrid.plans import jobs
from signalgrid.sources.landing import landing_path
from signalgrid.sources.tables import read_table, table_exists

HEADER = "device_code,time_ms,lat,lng,cell_code,p_cell_rsrp,p_cell_rsrq"
CELLS = "cell_code,x,y,station_code,azimuth,province_name,district_name"
DAY = "2025-05-12"
LAT, LNG = (20.95, 21.05), (105.75, 105.85)


def epoch(hour, minute=0):
    """Epoch milliseconds of a local time of the day."""
    utc = dt.datetime(2025, 5, 12, tzinfo=dt.timezone.utc) - dt.timedelta(hours=7)
    return int((utc + dt.timedelta(hours=hour, minutes=minute)).timestamp() * 1000)


def line(device, hour, minute=0, lat=21.0, rsrp=-95, rsrq=-10, cell="c 1"):
    return f"{device},{epoch(hour, minute)},{lat},105.8,{cell},{rsrp},{rsrq}"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = jobs.Lake(str(root))
    (root / "landing").mkdir()
    cells = root / "cells.csv"
    cells.write_text(f"{CELLS}\nC1,21.001,105.801,S1,120,HN,D1\nc 2,21.01,105.81,S2,0,HN,D1\n")
    jobs.ingest_cells(spark, lake, str(cells))
    cells.write_text(f"{CELLS}\nc1,21.001,105.801,S1,240,HN,D1\nC3,21.02,105.82,S3,0,HN,D1\n")
    jobs.ingest_cells(spark, lake, str(cells))
    return lake


def land(lake, hour, *lines):
    with open(landing_path(lake.landing, DAY, hour), "w") as file:
        file.write("\n".join([HEADER, *lines]) + "\n")


def good(hour, n=40):
    return [line(f"d{i}", hour, i % 60, 21.0 + i * 1e-4) for i in range(n)]


def run_hour(spark, lake, hour, *lines):
    land(lake, hour, *lines)
    assert jobs.ingest_measurements(spark, lake, DAY, hour)
    jobs.check_quality(spark, lake, DAY, hour)
    jobs.build_facts(spark, lake, DAY, hour)


def test_cells_are_upserted(spark, lake):
    dim = {r.cell_id: r.azimuth for r in read_table(spark, lake.dim_cell).collect()}
    assert dim == {"C1": 240.0, "C2": 0.0, "C3": 0.0}


def test_an_hour_and_its_rerun(spark, lake):
    bad = [line("x1", 7, lat=0.0), line("d0", 7), line("d0", 7)]
    for _ in range(2):
        run_hour(spark, lake, 7, *good(7), *bad)
        assert read_table(spark, lake.mdt_raw).count() == 43
        clean, dirty = read_table(spark, lake.mdt_clean), read_table(spark, lake.dirty_data)
        assert (clean.count(), dirty.count()) == (40, 3)
        assert {"distance_to_cell_km", "processed_at"} <= set(clean.columns)
        report = read_table(spark, lake.quality_report).collect()
        assert len(report) == 1
        row = report[0]
        assert (row.total_raw_records, row.duplicate_count) == (43, 2)
        assert (row.clean_count, row.dirty_count, row.late_count) == (40, 3, 0)
        users = read_table(spark, lake.fact_hourly).agg(F.sum("user_density_count")).first()[0]
        assert users == 40


def test_gate_stops_after_writing(spark, lake):
    land(lake, 5, *(line(f"d{i}", 5, lat=0.0, rsrp=0, rsrq=0) for i in range(10)))
    jobs.ingest_measurements(spark, lake, DAY, 5)
    with pytest.raises(jobs.QualityGateError):
        jobs.check_quality(spark, lake, DAY, 5)
    report = read_table(spark, lake.quality_report).where("batch_hour = 5").first()
    assert report.success_rate < 80 and report.dirty_count == 10
    assert read_table(spark, lake.dirty_data).where("event_hour = 5").count() == 10
    assert jobs.build_facts(spark, lake, DAY, 5) is False


def test_empty_hour(spark, lake):
    land(lake, 4)
    assert jobs.ingest_measurements(spark, lake, DAY, 4)
    assert jobs.check_quality(spark, lake, DAY, 4) is False
    assert jobs.build_facts(spark, lake, DAY, 4) is False


def test_late_rows(spark, lake):
    run_hour(spark, lake, 7, *good(7))
    late = [line("late1", 7, 30), line("late2", 7, 31, rsrp=-20), line("d3", 7, 3, rsrp=-70)]
    run_hour(spark, lake, 8, *good(8), *late)
    assert read_table(spark, lake.late_arrival).count() == 3
    report = read_table(spark, lake.quality_report).where("batch_hour = 8").first()
    assert (report.late_count, report.clean_count, report.dirty_count) == (3, 40, 0)
    before = read_table(spark, lake.mdt_clean).where("event_hour = 8").count()
    assert jobs.merge_late(spark, lake)
    clean = read_table(spark, lake.mdt_clean)
    assert clean.where("event_hour = 7").count() == 41
    assert clean.where("event_hour = 8").count() == before
    assert clean.where("device_code = 'd3' AND event_hour = 7").first().p_cell_rsrp == -70
    assert read_table(spark, lake.dirty_data).where("device_code = 'late2'").count() == 1
    fact = read_table(spark, lake.fact_hourly)
    assert fact.where("event_hour = 7").agg(F.sum("user_density_count")).first()[0] == 41
    assert [tuple(r) for r in spark.read.json(lake.affected).collect()] == [(DAY, 7)]
    assert jobs.merge_late(spark, lake) is False
    # The next late rows find an empty quarantine.
    run_hour(spark, lake, 9, *good(9), line("late9", 8, 59))
    assert jobs.merge_late(spark, lake)
    assert read_table(spark, lake.mdt_clean).where("event_hour = 8").count() == before + 1


def test_late_rows_that_come_during_a_merge_stay_for_the_next(spark, tmp_path, monkeypatch):
    lake = jobs.Lake(str(tmp_path))
    (tmp_path / "landing").mkdir()
    cells = tmp_path / "cells.csv"
    cells.write_text(f"{CELLS}\nC1,21.001,105.801,S1,120,HN,D1\n")
    jobs.ingest_cells(spark, lake, str(cells))
    run_hour(spark, lake, 7, *good(7))
    run_hour(spark, lake, 8, *good(8), line("early", 7, 30))
    rebuild = jobs.facts.hourly

    def meanwhile(*args, **kwargs):
        monkeypatch.undo()
        run_hour(spark, lake, 9, *good(9), line("during", 7, 31), line("during2", 8, 31))
        return rebuild(*args, **kwargs)

    monkeypatch.setattr(jobs.facts, "hourly", meanwhile)
    assert jobs.merge_late(spark, lake)
    waiting = {row.device_code for row in read_table(spark, lake.late_arrival).collect()}
    assert waiting == {"during", "during2"}
    assert jobs.merge_late(spark, lake) and jobs.merge_late(spark, lake) is False
    clean = {row.device_code for row in read_table(spark, lake.mdt_clean).where("event_hour < 9").collect()}
    assert {"early", "during", "during2"} <= clean


def test_late_rows_survive_a_rerun_and_the_newest_version_counts(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("late")
    lake = jobs.Lake(str(root))
    (root / "landing").mkdir()
    cells = root / "cells.csv"
    cells.write_text(f"{CELLS}\nC1,21.001,105.801,S1,120,HN,D1\n")
    jobs.ingest_cells(spark, lake, str(cells))
    run_hour(spark, lake, 7, *good(7))
    # Two versions of one late measurement, in two batches; and one 30 km away, which is
    # plausible by itself but not among the rows of its hour.
    run_hour(spark, lake, 8, *good(8), line("late", 7, 30, rsrp=-60), line("far", 7, 31, lat=21.27))
    run_hour(spark, lake, 9, *good(9), line("late", 7, 30, rsrp=-99))
    assert jobs.merge_late(spark, lake)

    def hour():
        rows = read_table(spark, lake.mdt_clean).where("event_hour = 7").collect()
        assert "batch_date" not in rows[0]
        return {row.device_code: row.p_cell_rsrp for row in rows}

    assert len(hour()) == 41 and hour()["late"] == -99
    assert read_table(spark, lake.dirty_data).where("device_code = 'far'").count() == 1
    run_hour(spark, lake, 7, *good(7))
    assert len(hour()) == 41 and hour()["late"] == -99
    run_hour(spark, lake, 8, *good(8), line("late", 7, 30, rsrp=-60))
    assert jobs.merge_late(spark, lake)
    # The older version comes again and changes nothing.
    assert len(hour()) == 41 and hour()["late"] == -99


def test_series_of_different_ends_keep_their_forecasts(spark, tmp_path):
    own = jobs.Lake(str(tmp_path))
    hours = spark.sql(
        """SELECT hex_id, 'C1' AS cell_id, date_add(DATE'2025-05-05', CAST(i DIV 24 AS INT)) AS event_date,
        CAST(i % 24 AS INT) AS event_hour, 100 + i % 24 AS user_density_count, -90.0D - i % 5 AS avg_rsrp
        FROM (SELECT explode(sequence(0, 8 * 24 - 1)) AS i), VALUES ('a'), ('b') v(hex_id)
        WHERE hex_id = 'a' OR i % 24 < 21"""
    )
    hours.write.partitionBy("event_date", "event_hour").parquet(own.fact_hourly)
    for day in ("2025-05-10", "2025-05-11"):
        assert jobs.run_forecast(spark, own, day)

    def kept():
        rows = read_table(spark, own.forecast)
        return sorted(map(tuple, rows.select("hex_id", F.col("forecast_time").cast("string"), "forecast_density").collect()))

    first = kept()
    assert [row[0] for row in first].count("a") == [row[0] for row in first].count("b") == 48
    assert len({row[:2] for row in first}) == 96
    assert jobs.run_forecast(spark, own, "2025-05-11") and kept() == first


def test_forecast_and_evaluation(spark, lake, tmp_path):
    own = jobs.Lake(str(tmp_path))
    hours = spark.range(8 * 24).select(
        F.lit("1:1").alias("hex_id"),
        F.lit("C1").alias("cell_id"),
        F.expr("date_add(DATE'2025-05-05', CAST(id DIV 24 AS INT))").alias("event_date"),
        (F.col("id") % 24).cast("int").alias("event_hour"),
        (F.lit(100) + F.round(20 * F.sin(F.col("id") * (math.pi / 12)))).cast("bigint").alias(
            "user_density_count"
        ),
        (-90 + 5 * F.sin(F.col("id") * (math.pi / 12))).alias("avg_rsrp"),
    )
    hours.write.partitionBy("event_date", "event_hour").parquet(own.fact_hourly)
    assert jobs.evaluate_day(spark, own, DAY) is False if table_exists(spark, own.forecast) else True
    for model in (forecast.seasonal, forecast.fourier, forecast.changepoints):
        assert jobs.run_forecast(spark, own, DAY, model=model)
        ahead = read_table(spark, own.forecast)
        assert ahead.count() == 24
        assert [str(r[0]) for r in ahead.select("forecast_date").distinct().collect()] == [DAY]
        for _ in range(2):
            assert jobs.evaluate_day(spark, own, DAY)
        scores = read_table(spark, own.evaluation).collect()
        assert len(scores) == 1
        assert scores[0].total_matched_records == 24
        assert scores[0].mape_density < 10 and scores[0].mae_rsrp < 1
    assert jobs.run_forecast(spark, own, "2030-01-01") is False
    # The forecast of another day leaves this one alone.
    assert jobs.run_forecast(spark, own, "2025-05-11")
    assert read_table(spark, own.forecast).count() == 48
    assert jobs.evaluate_day(spark, own, "2020-01-01") is False


def test_dimensions_and_registration(spark, lake):
    jobs.build_date_dim(spark, lake)
    jobs.build_hex_dim(spark, lake, lat=LAT, lng=LNG, files=4)
    assert read_table(spark, lake.dim_date).count() == 4018
    hexes = read_table(spark, lake.dim_hex)
    assert hexes.count() == hexes.select("hex_id").distinct().count() > 1000
    known = jobs.register_tables(spark, lake)
    assert known == {
        "fact_mdt_hourly": True, "dim_cell": True, "dim_hex": True, "dim_date": True,
        "quality_report": True, "fact_forecast_hourly": False, "fact_model_evaluation": False,
    }
    assert spark.table("dim_date").count() == 4018
    assert Counter(spark.table("dim_cell").select("cell_id").collect()) == Counter(
        [("C1",), ("C2",), ("C3",)]
    )
    for name in known:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    with pytest.raises(AttributeError):
        lake.nothing
