from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from signalgrid.sources import compaction, tables


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_size for f in Path(path).rglob("*.parquet")}


def content(spark, path):
    return Counter(map(tuple, tables.read_table(spark, path, merge=True).select("id", "word", "hour").collect()))


@pytest.fixture
def table(spark, tmp_path):
    """Folders with many small files, one large file, and an hour that is spelled ``07``."""
    path = str(tmp_path / "a table")
    wide = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("word"), F.lit("07").alias("hour"))
    tables.append(wide.coalesce(1), path, ["hour"])
    small = spark.range(4_000).select(
        (F.col("id") + 100_000).alias("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("word"),
        F.when(F.col("id") % 3 == 0, "07").when(F.col("id") % 3 == 1, "x: y%").alias("hour"),
    )
    tables.append(small.repartition(10), path, ["hour"])
    return path


def test_small_files_are_merged_and_large_ones_untouched(spark, table):
    before, rows = files_of(table), content(spark, table)
    target = 64 << 10
    large = {name: size for name, size in before.items() if size >= target // 2}
    assert len(large) == 1 and len(before) == 31
    written = compaction.compact_table(spark, table, target)
    after = files_of(table)
    assert content(spark, table) == rows
    assert large.items() <= after.items()
    new = {name: size for name, size in after.items() if name not in before}
    assert len(new) == written and set(after) == set(large) | set(new) | (set(after) & set(before))
    assert len(after) < len(before) / 2
    # Compression differs a little from that of the parts.
    assert all(size < 1.2 * (target + target // 2) for size in new.values())
    assert {Path(name).parent for name in after} == {Path(name).parent for name in before}
    assert not Path(table + ".compact").exists()


def test_compact_already(spark, table):
    assert compaction.compact_table(spark, table) == 3
    before = files_of(table)
    # The large file of 07 was below half the default target and went with the others.
    assert len(before) == 3
    assert compaction.compact_table(spark, table) == 0
    assert files_of(table) == before


def test_order_and_columns_that_some_files_lack(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.range(50).coalesce(1), path)
    tables.append(spark.range(50, 100).select(F.col("id"), (-F.col("id")).alias("other")).coalesce(1), path)
    assert compaction.compact_table(spark, path, sort_by=["other"]) == 1
    got = [tuple(r) for r in tables.read_table(spark, path).select("id", "other").collect()]
    assert [r[1] for r in got] == [None] * 50 + list(range(-99, -49))
    assert sorted(r[0] for r in got) == list(range(100))


@pytest.mark.parametrize("cut", ["before the list", "before deleting", "while deleting", "while moving"])
def test_cut_off_at_any_point(spark, table, cut, monkeypatch):
    rows = content(spark, table)
    finish = compaction.finish_compaction
    monkeypatch.setattr(compaction, "finish_compaction", lambda *_: None)
    written = compaction.compact_table(spark, table)
    monkeypatch.setattr(compaction, "finish_compaction", finish)
    stage = Path(table + ".compact")
    plan = spark.read.parquet(f"{stage}/plan").collect()
    if cut == "before the list":
        (stage / "plan" / "_SUCCESS").unlink()
    elif cut != "before deleting":
        tables.remove_files(spark, [r["_file"] for r in plan[: 5 if cut == "while deleting" else None]])
    if cut == "while moving":
        row = next(r for r in plan if r["_bin"] == 0)
        place, files = tables.file_system(spark, table)
        folder = place(spark.sparkContext._jvm.java.net.URI(row["_folder"]))
        for status in files.listStatus(place(f"{stage}/rows/_bin=0")):
            if status.getPath().getName().endswith(".parquet"):
                files.rename(status.getPath(), place(folder, status.getPath().getName()))
    compaction.finish_compaction(spark, table)
    assert content(spark, table) == rows
    assert not stage.exists()
    assert len(files_of(table)) == (31 if cut == "before the list" else written)


def test_table_without_files(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([], "id long, hour int"), path, ["hour"])
    assert compaction.compact_table(spark, path) == 0
