from __future__ import annotations

import datetime as dt
from collections import Counter

from signalgrid.operators import late
from signalgrid.plans.derived import GRID, Tables, with_time_ms

SCHEMA = (
    "event_date date, event_hour int, device_code string, time_ms bigint, lat double, lng double,"
    "cell_code string, p_cell_rsrp double, p_cell_rsrq double, batch_date date, batch_hour int"
)
DAY = dt.date(2024, 1, 1)


def row(hour, device, ms, rsrp, batch_hour=None):
    batch = hour if batch_hour is None else batch_hour
    return (DAY, hour, device, ms, 21.0, 105.8, "C1", rsrp, -10.0, DAY, batch)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def levels(df):
    return Counter((r.event_hour, r.device_code, r.time_ms, r.p_cell_rsrp) for r in df.collect())


def test_split(spark):
    df = frame(spark, row(1, "a", 1, -90.0), row(1, "b", 2, -90.0, batch_hour=3))
    unknown = df.limit(1).selectExpr("* EXCEPT (event_hour)", "CAST(NULL AS INT) AS event_hour")
    on_time, behind = late.split(df.unionByName(unknown))
    assert on_time.count() == 2 and behind.count() == 1


def test_merge_updates_and_inserts_in_affected_hours_only(spark):
    silver = frame(
        spark, row(1, "a", 1, -90.0), row(1, "b", 2, -91.0), row(2, "a", 9, -92.0)
    )
    arrivals = frame(
        spark,
        row(1, "a", 1, -80.0, 2),
        row(1, "a", 1, -70.0, 3),  # newer version of the same key
        row(1, "c", 5, -60.0, 3),
    )
    newest = ["batch_hour"]
    merged = late.merge(silver, arrivals, newest=newest)
    want = Counter([(1, "a", 1, -70.0), (1, "b", 2, -91.0), (1, "c", 5, -60.0)])
    assert levels(merged) == want
    everything = late.merge_all(silver, arrivals, newest=newest)
    assert levels(everything) == want + Counter([(2, "a", 9, -92.0)])
    again = late.merge_all(everything, arrivals, newest=newest)
    assert levels(again) == levels(everything)
    assert late.affected_partitions(arrivals).collect() == [(DAY, 1)]


def test_dedup_late(spark):
    copies = frame(spark, row(1, "a", 1, -80.0, 2), row(1, "a", 1, -80.0, 2), row(1, "a", 2, -80.0, 2))
    assert late.dedup_late(copies).count() == 2


def test_rebuilt_facts_equal_a_full_build(spark):
    from signalgrid.operators import facts

    t = Tables(spark, "/root/testdata/sf0.001")
    merged = late.merge(t.silver, t.late_rows)
    rebuilt = late.rebuild_affected(merged, t.late_rows, t.cells, GRID)
    whole = facts.hourly(late.merge_all(t.silver, t.late_rows), t.cells, GRID)
    hours = late.affected_partitions(t.late_rows)
    want = Counter(map(tuple, late.in_partitions(whole, hours).select(rebuilt.columns).collect()))
    assert Counter(map(tuple, rebuilt.collect())) == want


def test_time_ms_is_the_epoch_time(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    wrong = with_time_ms(t.measurements).where(
        "time_ms <> unix_millis(CAST(ts AS TIMESTAMP))"
    )
    assert wrong.count() == 0
