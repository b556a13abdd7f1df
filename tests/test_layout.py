from __future__ import annotations

import random
import uuid
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from signalgrid.operators import serving
from signalgrid.plans.derived import DAY, Tables
from signalgrid.sources import layout, tables


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def let_through(path, **ranges):
    """Files whose footers cannot rule the ranges out, and all files."""
    names = list(Path(path).rglob("*.parquet"))
    passed = 0
    for name in names:
        footer = pq.ParquetFile(name).metadata
        fits = True
        for column, (low, high) in ranges.items():
            at = footer.schema.names.index(column)
            stats = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
            fits &= any(s.max >= low and s.min <= high for s in stats)
        passed += fits
    return passed, len(names)


def interleave(numbers, bits):
    held = [min(max(n, -(1 << bits - 1)), (1 << bits - 1) - 1) + (1 << bits - 1) for n in numbers]
    return sum(((n >> b) & 1) << (b * len(held) + i) for i, n in enumerate(held) for b in range(bits))


def test_curve_key_against_plain_loops(spark):
    rng = random.Random(1)
    rows = [tuple(rng.choice([rng.randint(-9, 9), rng.randint(-(1 << 40), 1 << 40)]) for _ in range(3)) for _ in range(300)]
    rows += [(-(1 << 19), (1 << 19) - 1, 0), (-(1 << 63), (1 << 63) - 1, -1)]
    df = spark.createDataFrame([*rows, (None, 1, 1), (1, None, 1)], "a long, b long, c long")
    got = df.select("a", "b", "c", layout.curve_key(["a", "b", "c"]).alias("key")).collect()
    for a, b, c, key in got:
        assert key == (None if a is None or b is None else interleave((a, b, c), 20))
    with pytest.raises(ValueError):
        layout.curve_key(["a"] * 4)


def test_clustered_files_are_skipped(spark, tmp_path):
    rows = spark.range(200 * 200).select(
        (F.col("id") % 200 - 100).alias("hex_q"), F.floor(F.col("id") / 200).alias("hex_r"), "id"
    )
    rows = rows.withColumn("event_hour", (F.xxhash64("id") % 24 + 24) % 24)
    plain, curved = str(tmp_path / "plain"), str(tmp_path / "curved")
    tables.write_table(rows, plain, files=32)
    layout.write_clustered(rows, curved, ["hex_q", "hex_r", "event_hour"], files=32)
    box = {"hex_q": (-20, -5), "hex_r": (60, 75)}
    passed, files = let_through(curved, **box)
    assert files == 32 and passed <= 6
    assert let_through(plain, **box) == (32, 32)
    # A condition on one of the coordinates skips files too, whichever it is.
    assert all(let_through(curved, **{name: box[name]})[0] <= 16 for name in box)
    read = tables.read_table(spark, curved)
    assert Counter(read.collect()) == Counter(rows.select(*read.columns).collect())
    found = read.where(layout.within(**box))
    assert found.count() == 16 * 16
    assert "GreaterThanOrEqual(hex_q,-20)" in plan(found) and "LessThanOrEqual(hex_r,75)" in plan(found)


def test_hot_place_fills_several_files(spark, tmp_path):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5).alias("hex_q"))
    path = str(tmp_path / "t")
    layout.write_clustered(rows.withColumn("hex_r", F.when(F.col("id") > 9, 1)), path, ["hex_q", "hex_r"], files=16)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).rglob("*.parquet")]
    assert sum(sizes) == 30_000 and max(sizes) < 30_000 / 16 * 2


def test_coordinates_of_hexagons(spark):
    df = spark.createDataFrame([("-46:92",), (None,), ("x",), ("",), ("1:",)], "hex_id string")
    got = layout.with_coordinates(df).select("hex_q", "hex_r").collect()
    assert list(map(tuple, got)) == [(-46, 92), (None, None), (None, None), (None, None), (1, None)]


HOURS = ["hex_id", "cell_id", "event_date", "event_hour"]
SERIES = HOURS[:2]


def dropped(spark, *names):
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_next_hour_without_a_shuffle(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.001")
    facts, ahead = (f"{kind}_{uuid.uuid4().hex}" for kind in ("facts", "ahead"))
    layout.write_bucketed(t.facts, facts, str(tmp_path / "facts"), 4, HOURS)
    layout.write_bucketed(serving.hour_before(t.forecast), ahead, str(tmp_path / "ahead"), 4, HOURS)
    for day in (None, DAY):
        left = spark.table(facts) if day is None else serving.on_day(spark.table(facts), day)
        joined = left.join(spark.table(ahead).hint("merge"), HOURS, "left")
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        whole = t.facts if day is None else serving.on_day(t.facts, day)
        want = serving.next_hour_forecast(whole, t.forecast.hint("merge"))
        assert "Exchange" in plan(want)
        assert Counter(joined.select(*want.columns).collect()) == Counter(want.collect())
    assert len(list((tmp_path / "facts").rglob("*.parquet"))) <= 4
    dropped(spark, facts, ahead)


def test_series_aggregate_without_a_shuffle(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.001")
    name = f"facts_{uuid.uuid4().hex}"
    layout.write_bucketed(t.facts, name, str(tmp_path / "facts"), 4, SERIES)
    for by in (SERIES, HOURS):
        sums = spark.table(name).groupBy(*by).agg(F.sum("user_density_count").alias("users"))
        assert "Exchange" not in plan(sums)
        want = t.facts.groupBy(*by).agg(F.sum("user_density_count").alias("users"))
        assert Counter(sums.collect()) == Counter(want.collect())
    dropped(spark, name)


def test_days_of_a_bucketed_table_are_replaced(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.001")
    name = f"days_{uuid.uuid4().hex}"
    columns = ["hex_id", "cell_id", "event_hour", "user_density_count", "event_date"]
    rows = t.facts.select(*columns)
    layout.write_bucketed(rows, name, str(tmp_path / "t"), 4, SERIES, ["event_date"])
    day = rows.where(F.col("event_date") == DAY)
    newer = day.withColumn("user_density_count", F.col("user_density_count") + 1000).select(*columns[::-1])
    layout.replace_bucketed(newer, name, 4, SERIES)
    got = spark.table(name)
    want = rows.where(F.col("event_date") != DAY).unionByName(newer)
    assert Counter(got.select(*columns).collect()) == Counter(want.select(*columns).collect())
    assert "Exchange" not in plan(got.groupBy("hex_id", "cell_id").count())
    # Written anew, nothing of before is left.
    layout.write_bucketed(day.select(*columns), name, str(tmp_path / "t"), 4, SERIES, ["event_date"])
    assert Counter(spark.table(name).select(*columns).collect()) == Counter(day.select(*columns).collect())
    dropped(spark, name)
