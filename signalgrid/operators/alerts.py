"""Alert lists: current holes and forecast risks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalgrid.functions import hour_label, record_time
from signalgrid.operators.serving import as_of, degradation_test, on_day
from signalgrid.settings import (
    CONTINUED_HOLE,
    CRITICAL,
    CURRENT_HOLE,
    SUDDEN_DEGRADATION,
    Thresholds,
)


def latest_hour(facts: DataFrame, date: str) -> Column:
    """The last measured hour of a day, 0 if there is none."""
    return F.coalesce(on_day(facts, date).agg(F.max("event_hour")).scalar(), F.lit(0))


def bad_run_by_cell(day: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Add how many of a cell's last ``critical_hours`` rows of the day, by hour and then by
    hexagon, were bad.

    A cell may own a large part of all rows, so its day is cut into short stretches: an hour
    and the first coordinate of the hexagon, whose hexagons are neighbours in the order. A row that
    has enough rows before it in its stretch is done there. The others look back over the
    ends of stretches only, at most ``2 * (critical_hours - 1)`` rows each.
    """
    n = limits.critical_hours
    bad = F.when(F.col("avg_rsrp") < limits.hole_rsrp, 1).otherwise(0)
    stretch = ["cell_id", "event_date", "event_hour", "_part"]
    ahead = Window.partitionBy(*stretch).orderBy("hex_id")
    back = Window.partitionBy(*stretch).orderBy(F.col("hex_id").desc())
    placed = day.withColumn("_part", F.substring_index("hex_id", ":", 1)).withColumns(
        {
            "_place": F.row_number().over(ahead),
            "_rest": F.row_number().over(back),
            "bad_hours": F.sum(bad).over(ahead.rowsBetween(1 - n, 0)),
        }
    )
    settled = placed.where(F.col("_place") >= n)
    ends = placed.where((F.col("_place") < n) | (F.col("_rest") < n))
    whole = Window.partitionBy("cell_id", "event_date").orderBy("event_hour", "hex_id")
    crossing = ends.withColumn("bad_hours", F.sum(bad).over(whole.rowsBetween(1 - n, 0))).where(
        F.col("_place") < n
    )
    return settled.unionByName(crossing).drop("_part", "_place", "_rest")


def current(facts: DataFrame, date: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """Bad and busy rows of the latest hour."""
    runs = bad_run_by_cell(on_day(facts, date), limits)
    level = F.when(F.col("bad_hours") >= limits.critical_hours, CRITICAL).otherwise(CURRENT_HOLE)
    return runs.where(
        (F.col("event_hour") == latest_hour(facts, date))
        & (F.col("avg_rsrp") < limits.hole_rsrp)
        & (F.col("user_density_count") >= limits.dense_users)
    ).select(
        "cell_id",
        "hex_id",
        "avg_rsrp",
        "user_density_count",
        F.lit("current").alias("kind"),
        level.alias("alert_level"),
        hour_label(F.col("event_hour")).alias("hour_label"),
    )


def upcoming(
    facts: DataFrame,
    forecast: DataFrame,
    date: str,
    limits: Thresholds = Thresholds(),
    hour: int | None = None,
) -> DataFrame:
    """Forecast risks in the hours after the latest measured one (up to ``hour``)."""
    now = record_time(F.lit(date).cast("date"), latest_hour(as_of(facts, date, hour), date))
    horizon = now + F.make_dt_interval(F.lit(0), F.lit(limits.alert_horizon_hours))
    risk, hole = degradation_test(limits), F.col("forecast_rsrp") < limits.hole_rsrp
    return forecast.where(
        (F.col("forecast_time") > now) & (F.col("forecast_time") <= horizon) & (risk | hole)
    ).select(
        "cell_id",
        "hex_id",
        F.col("forecast_rsrp").alias("avg_rsrp"),
        F.col("forecast_density").cast("bigint").alias("user_density_count"),
        F.lit("forecast").alias("kind"),
        F.when(risk, SUDDEN_DEGRADATION).otherwise(CONTINUED_HOLE).alias("alert_level"),
        hour_label(F.col("forecast_hour")).alias("hour_label"),
    )


def report(
    facts: DataFrame,
    forecast: DataFrame,
    date: str,
    limits: Thresholds = Thresholds(),
    hour: int | None = None,
) -> DataFrame:
    """Both lists in one; ``kind`` tells them apart. ``hour`` is the last one measured."""
    return current(as_of(facts, date, hour), date, limits).unionByName(
        upcoming(facts, forecast, date, limits, hour)
    )
