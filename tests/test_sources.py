from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from signalgrid.sources import landing, tables

HEADER = "device_code,time_ms,lat,lng,cell_code,p_cell_rsrp,p_cell_rsrq"


def write(path: Path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_landing_path():
    assert landing.landing_path("s3a://zone/", "2025-05-12", 7) == "s3a://zone/mdt_2025051207.csv"


def test_read_measurements(spark, tmp_path):
    path = write(
        tmp_path / "mdt.csv",
        "lng,lat,device_code,time_ms,cell_code,p_cell_rsrp,p_cell_rsrq,vendor",
        "105.8,21.0,d1,1747008000123,c 1,-110.5,-10,acme",
        "105.8,abc,d2,late,c 1,,x,",
    )
    df = landing.read_measurements(spark, path)
    assert dict(df.dtypes)["p_cell_rsrp"] == "double" and dict(df.dtypes)["time_ms"] == "bigint"
    first, second = sorted(df.collect(), key=lambda r: r.device_code)
    assert (first.lat, first.p_cell_rsrp, first.vendor) == (21.0, -110.5, "acme")
    assert (second.lat, second.time_ms, second.p_cell_rsrp, second.p_cell_rsrq) == (None,) * 4


def test_event_time_or_batch_time(spark, tmp_path):
    with_time = write(
        tmp_path / "a.csv", HEADER, "d1,1747008000123,1,2,c,-1,-1", "d2,?,1,2,c,-1,-1"
    )
    derived = landing.derive_partitions(
        landing.read_measurements(spark, with_time), "2025-05-12", 9
    )
    first, second = sorted(derived.collect(), key=lambda r: r.device_code)
    assert (first.event_date, first.event_hour) == (dt.date(2025, 5, 12), 7)
    assert first.date_hour == "2025-05-12-07" and first.batch_hour == 9
    assert (second.event_hour, second.date_hour) == (9, "2025-05-12-09")
    without = write(tmp_path / "b.csv", "device_code,lat", "d1,21")
    raw = landing.read_measurements(spark, without)
    assert "time_ms" not in raw.columns and "cell_code" in raw.columns
    row = landing.derive_partitions(raw, "2025-05-12", 3).first()
    assert (str(row.event_date), row.event_hour, row.date_hour) == (
        "2025-05-12", 3, "2025-05-12-03",
    )


def test_read_cells(spark, tmp_path):
    path = write(
        tmp_path / "cells.csv",
        "cell_code,x,y,station_code,azimuth,province_name,district_name",
        "C1,21.0,105.8,S1,120,HN,D1",
    )
    row = landing.read_cells(spark, path).first()
    assert (row.x, row.azimuth, row.station_code) == (21.0, 120.0, "S1")


@pytest.fixture
def hours(spark):
    return spark.range(48).select(
        F.col("id").alias("v"),
        F.expr("date_add(DATE'2024-01-01', CAST(id DIV 24 AS INT))").alias("d"),
        (F.col("id") % 24).cast("int").alias("h"),
    )


def test_replace_partitions(spark, tmp_path, hours):
    path = str(tmp_path / "t")
    tables.replace_partitions(hours, path, ["d", "h"])
    day = hours.where("d = DATE'2024-01-02'").withColumn("v", F.col("v") + 1000)
    for _ in range(2):
        tables.replace_partitions(day, path, ["d", "h"])
        got = tables.read_table(spark, path)
        assert rows(got.select("v", "d", "h")) == rows(
            hours.where("d = DATE'2024-01-01'").union(day)
        )
    # An hour that came out empty is emptied, others stay.
    gone = {"d": dt.date(2024, 1, 2), "h": 5}
    tables.replace_partitions(day.limit(0), path, ["d", "h"], owned=[gone])
    got = tables.read_table(spark, path)
    assert got.count() == 47
    assert tables.read_partition(got, **gone).count() == 0
    tables.replace_partitions(day, path, ["d", "h"], owned=[gone])
    assert tables.read_table(spark, path).count() == 48


def test_read_partition(hours):
    assert tables.read_partition(hours, d="2024-01-02", h=3).count() == 1
    assert tables.read_partition(hours, d=("2024-01-01", "2024-01-02"), h=(3, 4)).count() == 4


def test_write_table_files(spark, tmp_path, hours):
    path = tmp_path / "t"
    tables.write_table(hours, str(path), files=5)
    assert len(list(path.glob("*.parquet"))) == 5
    tables.write_table(hours, str(path), ["d"])
    assert len(list(path.glob("d=*"))) == 2
    assert tables.read_table(spark, str(path)).count() == 48


def test_schema_evolution(spark, tmp_path, hours):
    path = str(tmp_path / "t")
    tables.replace_partitions(hours.where("h < 5"), path, ["d", "h"])
    tables.replace_partitions(
        hours.where("h = 5").withColumn("extra", F.lit("x")), path, ["d", "h"]
    )
    got = tables.read_table(spark, path, merge=True)
    assert "extra" in got.columns
    assert got.where("extra = 'x'").count() == 2 and got.count() == 12


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "k int, v string, t int")
    new = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1)], "k int, v string, t int")
    once = tables.upsert(old, new, ["k"], ["t"])
    assert rows(once) == Counter([(1, "a", 1), (2, "d", 3), (3, "e", 1), (None, "n", 1)])
    assert rows(tables.upsert(once, new, ["k"], ["t"])) == rows(once)
    wider = tables.upsert(old, new.withColumn("w", F.lit(1)), ["k"], ["t"])
    assert wider.columns == ["k", "v", "t", "w"]


def test_upsert_table_and_truncate(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    tables.upsert_table(first, path, ["k"])
    for _ in range(2):
        tables.upsert_table(second, path, ["k"])
        got = tables.read_table(spark, path)
        assert rows(got) == Counter([(1, "a"), (2, "B"), (3, "c")])
    tables.truncate(spark, path)
    empty = tables.read_table(spark, path)
    assert empty.count() == 0 and empty.columns == ["k", "v"]


def test_a_swap_that_was_cut_off_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *keys: spark.createDataFrame([(k, "x") for k in keys], "k long, v string")
    tables.upsert_table(rows(1), path, ["k"])
    # Cut off between the two renames: the new rows are complete next to the table.
    tables.write_table(rows(1, 2), f"{path}.next")
    (tmp_path / "t").rename(tmp_path / "t.last")
    tables.upsert_table(rows(3), path, ["k"])
    assert sorted(r.k for r in tables.read_table(spark, path).collect()) == [1, 2, 3]
    # Cut off while the new rows were written: the old ones are the table.
    tables.write_table(rows(9), f"{path}.next")
    (tmp_path / "t.next" / "_SUCCESS").unlink()
    (tmp_path / "t").rename(tmp_path / "t.last")
    tables.finish_swap(spark, path)
    assert sorted(r.k for r in tables.read_table(spark, path).collect()) == [1, 2, 3]


def test_only_absence_is_absence(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet at all")
    assert not tables.table_exists(spark, str(tmp_path / "empty"))
    with pytest.raises(Exception):
        tables.table_exists(spark, str(tmp_path / "broken"))


def test_read_with_schema_of_missing_files(spark, tmp_path, hours):
    (tmp_path / "none").mkdir()
    assert not tables.table_exists(spark, str(tmp_path / "none"))
    got = tables.read_table(spark, str(tmp_path / "none"), schema=hours.schema)
    assert got.count() == 0 and got.columns == hours.columns


def test_register(spark, tmp_path, hours):
    path = str(tmp_path / "t")
    assert tables.register(spark, "hours_t", path) is False
    tables.replace_partitions(hours.where("h < 2"), path, ["d", "h"])
    assert tables.register(spark, "hours_t", path) is True
    assert spark.table("hours_t").count() == 4
    tables.replace_partitions(hours.where("h = 2"), path, ["d", "h"])
    assert tables.register(spark, "hours_t", path) is True
    assert spark.table("hours_t").count() == 6
    other = str(tmp_path / "u")
    tables.write_table(hours, other)
    assert tables.register(spark, "hours_t", other) is True
    assert spark.table("hours_t").count() == 6  # known tables are left alone
    assert tables.register(spark, "hours_t", other, replace=True) is True
    assert spark.table("hours_t").count() == 48
    spark.sql("DROP TABLE hours_t")


def test_work_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = tables.work_folder(spark), tables.work_folder(spark)
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_malformed_lines_are_told_and_none_is_lost(spark, tmp_path):
    lines = ["device_code,lat,cell_code,note", "a,21.5,C1,x", "b,21.0", "c,21.0,C1,x,y", 'd,21.0,"C,1",x', 'e,no,C1,"x,y",z', "f,bad,C1,x", ",,,"]
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.csv").write_text("\n".join([lines[0], "g", "h,1,C2,x"]) + "\n")
    (tmp_path / "three.csv").write_text(lines[0] + "\n")
    columns = {"device_code": "string", "lat": "double", "cell_code": "string", "time_ms": "bigint", "lng": "double"}
    good, rejected = landing.read_checked(spark, str(tmp_path), columns)
    assert good.columns == ["device_code", "lat", "cell_code", "note", "lng"]
    assert {tuple(row) for row in good.collect()} == {
        ("a", 21.5, "C1", "x", None),
        ("d", 21.0, "C,1", "x", None),
        ("f", None, "C1", "x", None),
        (None, None, None, None, None),
        ("h", 1.0, "C2", "x", None),
    }
    told = {(r.line, r.fields, r.expected, r.reason, r.file.rsplit("/", 1)[1]) for r in rejected.collect()}
    assert told == {
        ("b,21.0", 2, 4, "too few fields", "one.csv"),
        ("c,21.0,C1,x,y", 5, 4, "too many fields", "one.csv"),
        ('e,no,C1,"x,y",z', 5, 4, "too many fields", "one.csv"),
        ("g", 1, 4, "too few fields", "two.csv"),
    }
    # Counting reads no column, and still counts each line once.
    assert (good.count(), rejected.count()) == (5, 4)
