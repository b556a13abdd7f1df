from __future__ import annotations

import time
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from signalgrid.operators import facts, late, quality
from signalgrid.plans.derived import SERVING_GRID, Tables, as_measurements, with_time_ms
from signalgrid.sources import landing, tables
from signalgrid.streaming import streams

SF = "/root/testdata/sf0.001"
HEADER = "device_code,time_ms,lat,lng,cell_code,p_cell_rsrp,p_cell_rsrq"
COLUMNS = HEADER.split(",")


def rows(df):
    return Counter(map(tuple, df.collect()))


def events_in_parts(spark, tmp_path, parts=3):
    """The events as several files in time order, to be streamed one after the other."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder = tmp_path / "events"
    bounds = events.stat.approxQuantile("event_id", [i / parts for i in range(1, parts)], 0.0)
    edges = [-1, *bounds, 10**9]
    for low, high in zip(edges, edges[1:]):
        part = events.where((F.col("event_id") > low) & (F.col("event_id") <= high))
        part.coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1)  # files are taken by modification time
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    )
    return streams.with_event_time(as_measurements(stream))


def test_facts_equal_batch_on_closed_hours(spark, tmp_path):
    t = Tables(spark, SF)
    stream = events_in_parts(spark, tmp_path)
    hours = streams.hourly_facts(stream, t.cells, SERVING_GRID)
    streams.run_available(hours, str(tmp_path / "ck"), str(tmp_path / "out"))
    got = tables.read_table(spark, str(tmp_path / "out"))
    columns = [c for c in got.columns if c != "hour_start"]
    whole = facts.hourly(t.measurements, t.cells, SERVING_GRID).withColumn(
        "hour_start", F.expr("CAST(event_date AS TIMESTAMP_NTZ) + make_dt_interval(0, event_hour)")
    )
    closed = t.events.agg(F.max("ts") - F.expr("INTERVAL 70 MINUTES")).scalar()
    want = whole.where(F.col("hour_start") <= closed)
    assert rows(got.select("hour_start", *columns)) == rows(want.select("hour_start", *columns))
    assert want.count() < whole.count()


def test_landing_files_are_taken_once_and_archived(spark, tmp_path):
    zone, archive = tmp_path / "zone", tmp_path / "archive"
    zone.mkdir()
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "ck")

    def land(hour, *lines):
        path = landing.landing_path(str(zone), "2025-05-12", hour)
        with open(path, "w") as file:
            file.write("\n".join([HEADER, *lines]) + "\n")

    def run():
        stream = streams.read_landing(spark, str(zone), COLUMNS, archive=str(archive))
        streams.run_available(stream, checkpoint, bronze, ["batch_date", "batch_hour"])

    land(7, "d1,1747008000123,21.0,105.8,c 1,-90,-10", "d2,x,bad,105.8,c 1,-90,-10")
    run()
    land(8, "d3,1747008000123,21.0,105.8,c 1,-90,-10")
    run()
    run()
    got = {r.device_code: r for r in tables.read_table(spark, bronze).collect()}
    assert set(got) == {"d1", "d2", "d3"} and tables.read_table(spark, bronze).count() == 3
    assert (got["d1"].batch_hour, got["d1"].event_hour) == (7, 7)
    assert (got["d2"].event_hour, got["d2"].lat) == (7, None)
    assert (got["d3"].batch_hour, got["d3"].event_hour) == (8, 7)
    batch = landing.derive_partitions(
        landing.read_measurements(spark, landing.landing_path(str(zone), "2025-05-12", 8)),
        "2025-05-12", 8,
    )
    same = tables.read_table(spark, bronze).where("batch_hour = 8").select(batch.columns)
    assert rows(same) == rows(batch)
    land(9, "d4,1747008000123,21.0,105.8,c 1,-90,-10")
    run()
    deadline = time.time() + 30
    while time.time() < deadline and not list(archive.rglob("*.csv")):
        time.sleep(0.5)
    assert list(archive.rglob("mdt_2025051207.csv"))


def test_a_landing_file_in_another_order_fails(spark, tmp_path):
    with open(landing.landing_path(str(tmp_path), "2025-05-12", 7), "w") as file:
        file.write("device_code,time_ms,lng,lat,cell_code,p_cell_rsrp,p_cell_rsrq\nd,1747008000123,105.8,21.0,c,-90,-10\n")
    stream = streams.read_landing(spark, str(tmp_path), COLUMNS)
    with pytest.raises(StreamingQueryException):
        streams.run_available(stream, str(tmp_path / "ck"), str(tmp_path / "out"))


def test_repair_keeps_rows_without_a_time(spark, tmp_path):
    silver, aside = str(tmp_path / "silver"), str(tmp_path / "aside")
    step = streams.repair(silver, aside)
    batch = spark.sql(
        """SELECT 'd' AS device_code, CAST(IF(i < 5, NULL, 7) AS BIGINT) AS time_ms, i AS value,
        DATE'2025-05-12' AS event_date, 7 AS event_hour, DATE'2025-05-12' AS batch_date, 7 AS batch_hour
        FROM (SELECT explode(sequence(0, 6)) AS i)"""
    )
    for number in (0, 0, 1, 1):
        step(batch, number)
        left = tables.read_table(spark, silver)
        assert left.where("time_ms IS NULL").count() == 5 * (number + 1)
        assert left.where("time_ms IS NOT NULL").count() == 1


def test_dedup(spark, tmp_path):
    stream = events_in_parts(spark, tmp_path)
    streams.run_available(
        streams.dedup(stream), str(tmp_path / "ck"), str(tmp_path / "out")
    )
    got = tables.read_table(spark, str(tmp_path / "out"))
    t = Tables(spark, SF)
    # The copies of an event share its time, so each event is left once.
    assert got.count() == t.events.count() == got.select("event_id").distinct().count()
    assert quality.dedup(t.measurements).count() == got.count()


def test_repair_merges_late_rows_and_can_run_twice(spark, tmp_path):
    silver, aside = str(tmp_path / "silver"), str(tmp_path / "aside")
    rebuilt = []
    step = streams.repair(silver, aside, ["batch_date", "batch_hour"], rebuilt.append)
    t = Tables(spark, SF)
    measured = with_time_ms(t.measurements)
    on_time, behind = late.split(measured)
    step(on_time, 0)
    first = tables.read_table(spark, silver).count()
    step(behind, 1)
    step(behind, 1)
    merged = tables.read_table(spark, silver).select(measured.columns)
    want = quality.dedup(measured, late.MERGE_KEYS)
    assert rows(merged) == rows(want.select(measured.columns))
    assert merged.count() > first
    kept = tables.read_table(spark, aside)
    assert kept.count() == behind.count()
    hours = late.affected_partitions(behind)
    assert rows(rebuilt[-1].select("event_date", "event_hour").distinct()) == rows(hours)
