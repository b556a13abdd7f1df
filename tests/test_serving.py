from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from signalgrid.operators import alerts, serving
from signalgrid.settings import Thresholds

DAY, BEFORE = "2024-01-24", "2024-01-17"
FACTS = (
    "hex_id string, cell_id string, event_date date, event_hour int, user_density_count bigint,"
    "avg_rsrp double, p10_rsrp double, avg_distance_km double"
)
FORECAST = (
    "hex_id string, cell_id string, forecast_time timestamp_ntz, forecast_density int,"
    "forecast_lower double, forecast_upper double, forecast_rsrp double,"
    "forecast_rsrp_lower double, forecast_rsrp_upper double, forecast_date date, forecast_hour int"
)


def facts(spark, *rows, day=DAY):
    """Rows of (hex, cell, hour, users, rsrp)."""
    date = dt.date.fromisoformat(day)
    full = [(h, c, date, hour, users, rsrp, rsrp - 5, 1.0) for h, c, hour, users, rsrp in rows]
    return spark.createDataFrame(full, FACTS)


def forecasts(spark, *rows, day=DAY):
    """Rows of (hex, cell, hour, users, upper, rsrp, lower)."""
    date = dt.datetime.fromisoformat(day)
    full = [
        (h, c, date + dt.timedelta(hours=hour), users, 0.0, upper, rsrp, low, rsrp + 5,
         (date + dt.timedelta(hours=hour)).date(), hour % 24)
        for h, c, hour, users, upper, rsrp, low in rows
    ]
    return spark.createDataFrame(full, FORECAST)


def test_change_and_run(spark):
    # Hour 2 is missing: the run goes over rows, so it is not broken.
    df = facts(
        spark, ("1:1", "A", 0, 10, -101.0), ("1:1", "A", 1, 7, -102.0),
        ("1:1", "A", 3, 9, -103.0), ("1:1", "A", 4, 9, -90.0), ("2:2", "A", 0, 4, -120.0),
    )
    rows = serving.bad_hour_run(serving.density_change(df)).orderBy("hex_id", "event_hour")
    got = [(r.hex_id, r.event_hour, r.density_diff, r.bad_hours) for r in rows.collect()]
    assert got == [
        ("1:1", 0, 10, 1), ("1:1", 1, -3, 2), ("1:1", 3, 2, 3), ("1:1", 4, 0, 2), ("2:2", 0, 4, 1),
    ]


def test_health_status_order(spark):
    df = facts(
        spark,
        ("a", "A", 0, 60, -101.0), ("a", "A", 1, 60, -101.0), ("a", "A", 2, 60, -101.0),
        ("b", "A", 0, 49, -101.0), ("b", "A", 1, 48, -101.0),
        ("c", "A", 0, 1, -90.0), ("d", "A", 0, 1, -100.0),
    )
    rows = serving.health_status(df, DAY).orderBy("hex_id", "event_hour").collect()
    assert [(r.hex_id, r.event_hour, r.health_status) for r in rows] == [
        ("a", 0, "needs_optimisation"), ("a", 1, "needs_optimisation"), ("a", 2, "critical"),
        ("b", 0, "normal"), ("b", 1, "watch"), ("c", 0, "good"), ("d", 0, "normal"),
    ]
    assert rows[2].record_time == dt.datetime(2024, 1, 24, 2)


def test_slices(spark):
    df = facts(spark, *(("a", "A", h, 60, -101.0) for h in range(5)))
    latest = serving.health_status(df, DAY, serving.LATEST).collect()
    # The run before the slice is still seen.
    assert [(r.event_hour, r.health_status) for r in latest] == [(4, "critical")]
    assert serving.health_status(df, DAY, serving.HOUR, 1).first().event_hour == 1
    assert serving.health_status(df, "2020-01-01", serving.LATEST).count() == 0
    with pytest.raises(ValueError):
        serving.slice_hours(df, "week")


def test_early_warning(spark):
    df = facts(spark, *(("a", c, 22, 1, -95.0) for c in "ABCDE"), ("a", "F", 23, 1, -95.0))
    ahead = forecasts(
        spark,
        ("a", "A", 23, 60, 100.0, -95.0, -106.0),
        ("a", "B", 23, 50, 100.0, -105.0, -120.0),  # not more than half of the upper bound
        ("a", "C", 23, 50, 99.0, -95.0, -105.0),  # a drop of exactly 10
        ("a", "D", 22, 60, 100.0, -95.0, -120.0),  # the wrong hour
        ("a", "F", 24, 60, 100.0, -95.0, -120.0),  # the next day
    )
    got = {r.cell_id: r.early_warning for r in serving.early_warning(df, ahead).collect()}
    assert got == {
        "A": "degradation_risk", "B": "continued_hole", "C": "safe", "D": "no_forecast",
        "E": "no_forecast", "F": "degradation_risk",
    }


def test_forecast_status(spark):
    ahead = forecasts(
        spark,
        ("a", "A", 5, 50, 100.0, -95.0, -111.0),
        ("a", "B", 5, 49, 100.0, -106.0, -122.0),
        ("a", "C", 5, 1, 100.0, -90.0, -91.0),
        ("a", "D", 6, 1, 100.0, -95.0, -96.0),
    )
    whole = {r.cell_id: r.health_status for r in serving.forecast_status(ahead, DAY).collect()}
    assert whole == {"A": "needs_optimisation", "B": "watch"}
    hour = serving.forecast_status(ahead, DAY, serving.HOUR, 5)
    assert {r.cell_id: r.health_status for r in hour.collect()} == whole | {"C": "good"}
    latest = serving.forecast_status(ahead, DAY, serving.LATEST).collect()
    assert [(r.cell_id, r.health_status) for r in latest] == [("D", "normal")]


def test_filter_options(spark):
    df = facts(spark, ("a", "A", 0, 1, -90.0), ("a", "A", 1, 1, -90.0))
    ahead = forecasts(spark, ("b", "B", 0, 1, 1.0, -90.0, -90.0))
    assert serving.filter_options(df, ahead, DAY).collect() == [("a", "A")]
    assert serving.filter_options(df.limit(0), ahead, DAY).collect() == [("b", "B")]
    assert serving.filter_options(df, ahead, "2020-01-01").count() == 0


def test_serving_filter(spark):
    df = facts(spark, ("a", "A", 0, 1, -125.0), ("a", "B", 0, 1, -90.0), ("b", "B", 0, 1, -121.0))
    assert serving.serving_filter(df).count() == 3
    assert serving.serving_filter(df, hex_id="a", cell_id="B").count() == 1
    assert serving.serving_filter(df, below_rsrp=-120.0).count() == 2
    status = serving.health_status(df, DAY)
    assert serving.serving_filter(status, status="good").count() == 1


def test_kpis(spark):
    now = facts(spark, ("a", "A", 1, 5, -90.0), ("a", "A", 2, 7, -100.0))
    before = facts(spark, ("a", "A", 2, 4, -80.0), ("a", "A", 3, 50, -80.0), day=BEFORE)
    both = now.union(before)
    day = serving.kpi_week_over_week(both, DAY, BEFORE).first()
    assert (day.total_users, day.mean_rsrp, day.last_week_users) == (12, -95.0, 54)
    assert (day.density_delta, day.rsrp_delta, day.latest_hour) == (-42, -15.0, 2)
    latest = serving.kpi_week_over_week(both, DAY, BEFORE, serving.LATEST).first()
    assert (latest.total_users, latest.last_week_users, latest.density_delta) == (7, 4, 3)
    alone = serving.kpi_week_over_week(now, DAY, BEFORE).first()
    assert alone.density_delta is None and alone.rsrp_delta is None


def test_trend_is_spliced(spark):
    df = facts(spark, ("a", "A", 1, 5, -115.0), ("b", "A", 1, 5, -90.0), ("a", "A", 2, 7, -111.0))
    ahead = forecasts(spark, *(("a", "A", h, 9, 12.0, -95.0, -99.0) for h in (2, 3, 4)))
    rows = serving.trend_spliced(df, ahead, DAY).orderBy("record_time").collect()
    assert [(r.hour_label, r.is_forecast, r.total_density) for r in rows] == [
        ("01:00", False, 10), ("02:00", False, 7), ("03:00", True, 9), ("04:00", True, 9),
    ]
    assert [r.poor_quality_cells for r in rows] == [1, 1, 1, 1]
    assert rows[0].upper_density == 10.0 and rows[0].lower_rsrp == rows[0].mean_rsrp == -102.5
    assert (rows[3].upper_density, rows[3].lower_rsrp) == (12.0, -99.0)
    only = serving.trend_spliced(df.limit(0), ahead, DAY).collect()
    assert {(r.is_forecast, r.poor_quality_cells) for r in only} == {(True, 0)} and len(only) == 3
    assert serving.trend_spliced(df.limit(0), ahead.limit(0), DAY).count() == 0


def test_heatmap(spark):
    df = facts(spark, ("a", "A", 7, 10, -90.0), ("b", "A", 7, 20, -90.0)).union(
        facts(spark, ("a", "A", 8, 3, -90.0), day="2023-12-27")  # 28 days before: still inside
    ).union(facts(spark, ("a", "A", 9, 99, -90.0), day="2023-12-26"))
    rows = serving.load_heatmap(df, DAY).collect()
    assert len(rows) == 168
    filled = {(r.dow_num, r.event_hour): (r.avg_density, r.load_band) for r in rows if r.avg_density}
    assert filled == {(3, 7): (15.0, 5), (3, 8): (3.0, 2)}
    empty = serving.load_heatmap(df.limit(0), DAY).collect()
    assert len(empty) == 168 and {r.load_band for r in empty} == {0}


def test_holes_severity_centroid(spark):
    view = spark.createDataFrame(
        [
            ("critical", "safe", 1.0, 2.0), ("needs_optimisation", "no_forecast", 3.0, 4.0),
            ("good", "degradation_risk", 5.0, 6.0), ("watch", "continued_hole", 7.0, 8.0),
            ("good", "safe", 9.0, 10.0), ("normal", None, None, None),
        ],
        "health_status string, early_warning string, cell_lat double, cell_lng double",
    )
    live, holes = serving.hole_split(view)
    assert (live.count(), holes.count()) == (2, 4)
    risks = spark.range(3)
    row = serving.severity_counts(view, risks).first()
    assert (row.critical_rows, row.hole_rows, row.risk_rows) == (1, 1, 3)
    assert (row.status_banner, row.forecast_banner) == ("critical", "degradation_risk")
    blind = view.where("early_warning = 'no_forecast'")
    row = serving.severity_counts(blind, risks.limit(0)).first()
    assert (row.status_banner, row.forecast_banner) == ("needs_optimisation", "no_forecast")
    row = serving.severity_counts(view.limit(0), risks.limit(0)).first()
    assert (row.status_banner, row.forecast_banner, row.risk_rows) == ("safe", "safe", 0)
    focus = serving.slice_centroid(view, by_cell=True).first()
    assert (focus.focus_lat, focus.focus_lng) == (5.0, 6.0)


def test_coerce(spark):
    df = spark.createDataFrame(
        [("-90.5", "abc", None, "7", dt.datetime(2024, 1, 24, 3)),
         ("x", "", "2.5", "?", dt.datetime(2024, 1, 24, 4)),
         ("NaN", "NaN", "NaN", "NaN", None), ("1", "2", "3", "1e300", None)],
        "avg_rsrp string, p10_rsrp string, avg_distance_km string, user_density string,"
        "record_time timestamp_ntz",
    )
    assert [tuple(r) for r in serving.coerce(df).collect()] == [
        (-90.5, None, 0.0, 7, "2024-01-24 03:00:00"), (None, None, 2.5, 0, "2024-01-24 04:00:00"),
        (None, None, 0.0, 0, None), (1.0, 2.0, 3.0, 0, None),
    ]


def test_alerts(spark):
    df = facts(
        spark,
        ("a", "A", 1, 90, -101.0), ("b", "A", 2, 90, -101.0), ("c", "A", 2, 90, -101.0),
        ("a", "B", 2, 50, -101.0), ("a", "C", 2, 49, -101.0), ("a", "D", 1, 90, -101.0),
    )
    now = {(r.hex_id, r.cell_id): r.alert_level for r in alerts.current(df, DAY).collect()}
    # The third bad row of cell A in order of hour and hexagon makes it critical.
    assert now == {("b", "A"): "current_hole", ("c", "A"): "critical", ("a", "B"): "current_hole"}
    ahead = forecasts(
        spark,
        ("a", "A", 2, 60, 100.0, -101.0, -102.0),  # not after the latest hour
        ("a", "B", 3, 60, 100.0, -90.0, -101.0),
        ("a", "C", 14, 1, 100.0, -101.0, -102.0),  # the last hour of the horizon
        ("a", "D", 15, 1, 100.0, -101.0, -102.0),
        ("a", "E", 5, 1, 100.0, -99.0, -99.5),
    )
    soon = {
        r.cell_id: (r.alert_level, r.hour_label) for r in alerts.upcoming(df, ahead, DAY).collect()
    }
    assert soon == {"B": ("sudden_degradation", "03:00"), "C": ("continued_hole", "14:00")}
    report = alerts.report(df, ahead, DAY)
    assert report.groupBy("kind").count().orderBy("kind").collect() == [
        ("current", 3), ("forecast", 2),
    ]
    # No measured hour: the forecast is taken from midnight on.
    early = alerts.upcoming(df.limit(0), ahead, DAY, Thresholds(alert_horizon_hours=3))
    assert {r.cell_id for r in early.collect()} == {"A", "B"}


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_cell_run_against_brute_force(spark, n):
    import random

    rng = random.Random(n)
    rows, seen = [], set()
    for _ in range(900):
        # One cell has most rows; stretches of hexagons are long, short and missing.
        cell = rng.choice("AAAAAB")
        hex_id = rng.choice([f"{rng.choice(['-1077', '-1', '12345'])}:{rng.randrange(40)}", "7:7"])
        at = (hex_id if rng.random() > 0.01 else None, cell, rng.choice([0, 1, 2, 5, 9]))
        if at not in seen:
            seen.add(at)
            rows.append((*at, 1, rng.choice([-101.0, -101.0, -90.0])))
    got = alerts.bad_run_by_cell(facts(spark, *rows), Thresholds(critical_hours=n)).collect()
    assert len(got) == len(rows)
    want = {}
    for cell in "AB":
        own = [r for r in rows if r[1] == cell]
        own.sort(key=lambda r: (r[2], r[0] is not None, r[0] or ""))
        for i, r in enumerate(own):
            want[r[:3]] = sum(x[4] < -100 for x in own[max(0, i + 1 - n) : i + 1])
    assert {(r.hex_id, r.cell_id, r.event_hour): r.bad_hours for r in got} == want


def test_risk_list(spark):
    ahead = forecasts(
        spark, ("a", "A", 5, 60, 100.0, -95.0, -106.0), ("a", "B", 5, 60, 100.0, -95.0, -96.0)
    ).union(forecasts(spark, ("a", "A", 5, 60, 100.0, -95.0, -106.0), day=BEFORE))
    cells = spark.createDataFrame([("A", 1.0, 2.0)], "cell_id string, station_lat double, station_lng double")
    hexes = spark.createDataFrame(
        [("a", 3.0, 4.0)], "hex_id string, hex_center_lat double, hex_center_lng double"
    )
    row = serving.risk_list(ahead, cells, hexes, DAY).collect()
    assert len(row) == 1
    assert (row[0].cell_id, row[0].cell_lat, row[0].hex_center_lng) == ("A", 1.0, 4.0)
    assert row[0].risk_type == "degradation_risk"


def test_week_comparison(spark):
    both = facts(spark, ("a", "A", 1, 5, -90.0), ("b", "A", 1, 5, -95.0)).union(
        facts(spark, ("a", "A", 1, 4, -95.0), day=BEFORE)
    )
    rows = serving.week_comparison(both, DAY, BEFORE).orderBy("hex_id").collect()
    assert [(r.health_status, r.last_week_health_status) for r in rows] == [
        ("good", "normal"), ("normal", None),
    ]
