"""Views for the map and the charts: status, warnings, trends, indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalgrid.functions import iso_weekday, load_band, record_time
from signalgrid.functions.clock import hour_label
from signalgrid.operators.enrich import star_join
from signalgrid.settings import (
    CONTINUED_HOLE,
    CRITICAL,
    DEGRADATION_RISK,
    GOOD,
    NEEDS_OPTIMISATION,
    NO_FORECAST,
    NORMAL,
    SAFE,
    WATCH,
    Thresholds,
)

LATEST, HOUR, DAY = "latest", "hour", "day"


# ---- slices and filters -----------------------------------------------------------------


def on_day(df: DataFrame, date: str, column: str = "event_date") -> DataFrame:
    """One day; compares the partition column itself, so folders are pruned."""
    return df.where(F.col(column) == F.lit(date).cast("date"))


def as_of(facts: DataFrame, date: str, hour: int | None) -> DataFrame:
    """The facts as they stood after an hour of ``date``; all of them without one."""
    if hour is None:
        return facts
    day = F.lit(date).cast("date")
    earlier = F.col("event_date") < day
    return facts.where(earlier | ((F.col("event_date") == day) & (F.col("event_hour") <= hour)))


def slice_hours(
    df: DataFrame, mode: str = DAY, hour: int | None = None, column: str = "event_hour"
) -> DataFrame:
    """The latest hour with data, a given hour, or everything."""
    if mode == LATEST:
        # A scalar subquery: found by Spark inside the same query.
        return df.where(F.col(column) == df.agg(F.max(column)).scalar())
    if mode == HOUR:
        return df.where(F.col(column) == hour)
    if mode == DAY:
        return df
    raise ValueError(f"unknown slice {mode!r}")


def serving_filter(
    df: DataFrame,
    hex_id: str | Column | None = None,
    cell_id: str | Column | None = None,
    status: str | None = None,
    below_rsrp: float | None = None,
) -> DataFrame:
    """Optional conditions; those not given are not applied."""
    if hex_id is not None:
        df = df.where(F.col("hex_id") == hex_id)
    if cell_id is not None:
        df = df.where(F.col("cell_id") == cell_id)
    if status is not None:
        df = df.where(F.col("health_status") == status)
    if below_rsrp is not None:
        df = df.where(F.col("avg_rsrp") < below_rsrp)
    return df


def filter_options(facts: DataFrame, forecast: DataFrame, date: str) -> DataFrame:
    """The (hexagon, cell) pairs to choose from: those measured on the day, or if there are
    none, those forecast for it."""
    measured = on_day(facts, date).select("hex_id", "cell_id").distinct()
    expected = on_day(forecast, date, "forecast_date").select("hex_id", "cell_id").distinct()
    nothing = measured.agg(F.count(F.lit(1)) == 0).scalar()
    return measured.unionByName(expected.where(nothing))


def coerce(df: DataFrame) -> DataFrame:
    """Display types: unreadable numbers become null, a missing distance or load 0."""
    numbers = ["cell_lat", "cell_lng", "hex_center_lat", "hex_center_lng", "avg_rsrp", "p10_rsrp"]

    def number(name: str) -> Column:
        # Text like "NaN" reads as a number that is none.
        return F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double"))

    columns = {c: number(c) for c in numbers if c in df.columns}
    columns["avg_distance_km"] = F.coalesce(number("avg_distance_km"), F.lit(0.0))
    columns["user_density"] = F.coalesce(number("user_density").try_cast("bigint"), F.lit(0))
    columns["record_time"] = F.date_format("record_time", "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(columns)


# ---- change over time -------------------------------------------------------------------


def _series_day(*keys: str) -> list[str]:
    # A day of one series has at most 24 rows, so no window group can grow.
    return [*keys, "event_date"]


def density_change(facts: DataFrame) -> DataFrame:
    """Add the change in users against the previous row of the day; the first row compares
    with 0."""
    order = Window.partitionBy(*_series_day("cell_id", "hex_id")).orderBy("event_hour")
    users = F.col("user_density_count")
    return facts.withColumn("density_diff", users - F.lag(users, 1, 0).over(order))


def bad_hour_run(facts: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Add how many of the last ``critical_hours`` rows of the day were bad. Rows count, not
    hours: a missing hour does not break a run."""
    recent = (
        Window.partitionBy(*_series_day("cell_id", "hex_id"))
        .orderBy("event_hour")
        .rowsBetween(1 - limits.critical_hours, 0)
    )
    bad = F.when(F.col("avg_rsrp") < limits.hole_rsrp, 1).otherwise(0)
    return facts.withColumn("bad_hours", F.sum(bad).over(recent).cast("int"))


# ---- status and warnings ----------------------------------------------------------------


def measured_status(limits: Thresholds = Thresholds()) -> Column:
    """Health of a measured hour; the first condition that holds decides."""
    hole = F.col("avg_rsrp") < limits.hole_rsrp
    return (
        F.when(F.col("bad_hours") >= limits.critical_hours, CRITICAL)
        .when(hole & (F.col("user_density_count") >= limits.dense_users), NEEDS_OPTIMISATION)
        .when(hole & (F.col("density_diff") < 0), WATCH)
        .when(F.col("avg_rsrp") >= limits.good_rsrp, GOOD)
        .otherwise(NORMAL)
    )


def degradation_test(limits: Thresholds = Thresholds()) -> Column:
    """The level may fall far and the load is high for what is usual."""
    drop = F.col("forecast_rsrp") - F.col("forecast_rsrp_lower")
    heavy = F.col("forecast_density") > F.col("forecast_upper") * limits.risk_load_share
    return (drop > limits.risk_drop_db) & heavy


def warning_label(limits: Thresholds = Thresholds()) -> Column:
    return (
        F.when(F.col("forecast_rsrp").isNull(), NO_FORECAST)
        .when(degradation_test(limits), DEGRADATION_RISK)
        .when(F.col("forecast_rsrp") < limits.hole_rsrp, CONTINUED_HOLE)
        .otherwise(SAFE)
    )


def health_status(
    facts: DataFrame,
    date: str,
    mode: str = DAY,
    hour: int | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """The day's facts with their health status.

    Runs and changes look at the whole day before it is cut to the chosen hours.
    """
    day = bad_hour_run(density_change(on_day(facts, date)), limits)
    status = day.withColumn("health_status", measured_status(limits))
    return slice_hours(status, mode, hour).withColumn(
        "record_time", record_time(F.col("event_date"), F.col("event_hour"))
    )


def hour_before(forecast: DataFrame) -> DataFrame:
    """Forecasts by the date and hour before theirs, which leaves an equi join with facts."""
    one_hour = F.make_dt_interval(F.lit(0), F.lit(1))
    moved = F.col("forecast_time") - one_hour
    return forecast.select(
        "hex_id",
        "cell_id",
        F.to_date(moved).alias("event_date"),
        F.hour(moved).alias("event_hour"),
        "forecast_density",
        "forecast_upper",
        "forecast_rsrp",
        "forecast_rsrp_lower",
    )


def next_hour_forecast(facts: DataFrame, forecast: DataFrame) -> DataFrame:
    """Facts with the forecast for the hour after theirs."""
    return facts.join(hour_before(forecast), ["hex_id", "cell_id", "event_date", "event_hour"], "left")


def early_warning(
    facts: DataFrame, forecast: DataFrame, limits: Thresholds = Thresholds()
) -> DataFrame:
    """Facts with the warning for the next hour."""
    return next_hour_forecast(facts, forecast).withColumn("early_warning", warning_label(limits))


def map_view(
    facts: DataFrame,
    forecast: DataFrame,
    cells: DataFrame,
    hexes: DataFrame,
    date: str,
    mode: str = DAY,
    hour: int | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """The map of measured hours: positions, status, warning."""
    status = health_status(facts, date, mode, hour, limits)
    return star_join(early_warning(status, forecast, limits), cells, hexes)


def week_comparison(
    facts: DataFrame,
    date: str,
    last_week: str,
    mode: str = DAY,
    hour: int | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Status of a day next to that of the same weekday before, hour by hour; rows of either
    day alone stay. The chosen hours hold for both days, the latest being that of ``date``."""
    columns = ["health_status", "avg_rsrp", "user_density_count"]
    now = health_status(facts, date, mode, hour, limits).select(
        "hex_id", "cell_id", "event_hour", *columns
    )
    before = health_status(facts, last_week, DAY, None, limits).select(
        "hex_id", "cell_id", "event_hour", *(F.col(c).alias(f"last_week_{c}") for c in columns)
    )
    if mode == LATEST:
        newest = on_day(facts, date).agg(F.max("event_hour")).scalar()
        before = before.where(F.col("event_hour") == newest)
    elif mode == HOUR:
        before = before.where(F.col("event_hour") == hour)
    return now.join(before, ["hex_id", "cell_id", "event_hour"], "full")


def last_week_map(
    facts: DataFrame,
    cells: DataFrame,
    hexes: DataFrame,
    date: str,
    last_week: str,
    mode: str = DAY,
    hour: int | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """The map layer of the same weekday before: all its rows, or those of the chosen hour or
    of the latest hour measured on ``date``."""
    rows = health_status(facts, last_week, DAY, None, limits)
    if mode == LATEST:
        rows = rows.where(F.col("event_hour") == on_day(facts, date).agg(F.max("event_hour")).scalar())
    else:
        rows = slice_hours(rows, mode, hour)
    return star_join(rows, cells, hexes)


def forecast_status(
    forecast: DataFrame,
    date: str,
    mode: str = DAY,
    hour: int | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Health status of forecast hours. The view of a whole day leaves out what is fine."""
    drop = F.col("forecast_rsrp") - F.col("forecast_rsrp_lower")
    status = (
        F.when(
            (drop > limits.optimise_drop_db)
            & (F.col("forecast_density") >= limits.dense_users),
            NEEDS_OPTIMISATION,
        )
        .when(F.col("forecast_rsrp_upper") < limits.hole_rsrp, WATCH)
        .when(F.col("forecast_rsrp") >= limits.good_rsrp, GOOD)
        .otherwise(NORMAL)
    )
    day = slice_hours(on_day(forecast, date, "forecast_date"), mode, hour, "forecast_hour")
    labelled = day.withColumns(
        {"health_status": status, "early_warning": warning_label(limits)}
    )
    if mode == DAY:
        labelled = labelled.where(~F.col("health_status").isin(NORMAL, GOOD))
    return labelled


def forecast_map(
    forecast: DataFrame,
    cells: DataFrame,
    hexes: DataFrame,
    date: str,
    mode: str = DAY,
    hour: int | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """The map of forecast hours, in the columns of the map of measured ones: expected users,
    level and its lower bound; there is no distance."""
    status = forecast_status(forecast, date, mode, hour, limits)
    return star_join(status, cells, hexes).select(
        "hex_id",
        "cell_id",
        "cell_lat",
        "cell_lng",
        "hex_center_lat",
        "hex_center_lng",
        F.col("forecast_time").alias("record_time"),
        F.col("forecast_density").alias("user_density"),
        F.round("forecast_rsrp", 2).alias("avg_rsrp"),
        F.lit(0.0).alias("avg_distance_km"),
        F.col("forecast_rsrp_lower").alias("p10_rsrp"),
        "health_status",
        "early_warning",
    )


def risk_list(
    forecast: DataFrame,
    cells: DataFrame,
    hexes: DataFrame,
    since: str,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Forecast hours from a day on that may degrade, with their positions."""
    risky = forecast.where(
        (F.col("forecast_date") >= F.lit(since).cast("date")) & degradation_test(limits)
    )
    return star_join(risky, cells, hexes).withColumn("risk_type", F.lit(DEGRADATION_RISK))


def is_hole() -> Column:
    """Rows drawn as coverage holes, by status or by warning."""
    return F.col("health_status").isin(NEEDS_OPTIMISATION, CRITICAL) | F.col(
        "early_warning"
    ).isin(DEGRADATION_RISK, CONTINUED_HOLE)


def hole_split(view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the live layer and rows of the hole layer."""
    flagged = F.coalesce(is_hole(), F.lit(False))
    return view.where(~flagged), view.where(flagged)


def severity_counts(view: DataFrame, risks: DataFrame) -> DataFrame:
    """How many rows are critical, holes, or at risk, and which banner follows."""
    status = F.col("health_status")
    counts = view.agg(
        F.count_if(status == CRITICAL).alias("critical_rows"),
        F.count_if(status == NEEDS_OPTIMISATION).alias("hole_rows"),
        F.coalesce(F.every(F.col("early_warning") == NO_FORECAST), F.lit(False)).alias(
            "_blind"
        ),
    ).withColumn("risk_rows", risks.agg(F.count(F.lit(1))).scalar())
    return counts.withColumns(
        {
            "status_banner": F.when(F.col("critical_rows") > 0, CRITICAL)
            .when(F.col("hole_rows") > 0, NEEDS_OPTIMISATION)
            .otherwise(SAFE),
            "forecast_banner": F.when(F.col("risk_rows") > 0, DEGRADATION_RISK)
            .when(F.col("_blind"), NO_FORECAST)
            .otherwise(SAFE),
        }
    ).drop("_blind")


def slice_centroid(view: DataFrame, by_cell: bool) -> DataFrame:
    """Where to centre the map on a chosen cell or hexagon."""
    kind = "cell" if by_cell else "hex_center"
    return view.agg(
        F.avg(f"{kind}_lat").alias("focus_lat"), F.avg(f"{kind}_lng").alias("focus_lng")
    )


# ---- indicators -------------------------------------------------------------------------


def kpi_week_over_week(
    facts: DataFrame, date: str, last_week: str, mode: str = DAY, hour: int | None = None
) -> DataFrame:
    """Users, mean level and latest hour of a slice, against the same slice a week ago.

    Both days come from one pass. A change is null if last week has nothing to compare.
    """
    day, week = F.lit(date).cast("date"), F.lit(last_week).cast("date")
    both = facts.where(F.col("event_date").isin(day, week))
    if mode == LATEST:
        newest = on_day(facts, date).agg(F.max("event_hour")).scalar()
        both = both.where(F.col("event_hour") == newest)
    else:
        both = slice_hours(both, mode, hour)
    now, before = F.col("event_date") == day, F.col("event_date") == week
    users, rsrp = F.col("user_density_count"), F.col("avg_rsrp")
    totals = both.agg(
        F.coalesce(F.sum(F.when(now, users)), F.lit(0)).alias("total_users"),
        F.avg(F.when(now, rsrp)).alias("mean_rsrp"),
        F.max(F.when(now, F.col("event_hour"))).alias("latest_hour"),
        F.sum(F.when(before, users)).alias("last_week_users"),
        F.avg(F.when(before, rsrp)).alias("last_week_rsrp"),
    )
    return totals.withColumns(
        {
            "density_delta": F.when(
                F.col("last_week_users") > 0, F.col("total_users") - F.col("last_week_users")
            ),
            "rsrp_delta": F.when(
                F.col("last_week_rsrp") != 0, F.col("mean_rsrp") - F.col("last_week_rsrp")
            ),
        }
    )


def trend_history(facts: DataFrame, date: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """The day by hour: users, mean level, number of poor rows."""
    return (
        on_day(facts, date)
        .groupBy("event_date", "event_hour")
        .agg(
            F.sum("user_density_count").alias("total_density"),
            F.avg("avg_rsrp").alias("mean_rsrp"),
            F.count_if(F.col("avg_rsrp") < limits.weak_rsrp).alias("poor_quality_cells"),
        )
        .withColumn("record_time", record_time(F.col("event_date"), F.col("event_hour")))
        .drop("event_date", "event_hour")
    )


def trend_forecast(forecast: DataFrame, date: str) -> DataFrame:
    """The forecast of a day by hour."""
    return (
        on_day(forecast, date, "forecast_date")
        .groupBy(F.date_trunc("hour", "forecast_time").cast("timestamp_ntz").alias("record_time"))
        .agg(
            F.sum("forecast_density").alias("forecast_density"),
            F.sum("forecast_upper").alias("forecast_upper"),
            F.avg("forecast_rsrp").alias("mean_rsrp"),
            F.avg("forecast_rsrp_lower").alias("lower_rsrp"),
            F.avg("forecast_rsrp_upper").alias("upper_rsrp"),
        )
    )


def trend_spliced(
    facts: DataFrame,
    forecast: DataFrame,
    date: str,
    limits: Thresholds = Thresholds(),
    hour: int | None = None,
) -> DataFrame:
    """The measured hours of a day (up to ``hour``), then the forecast for the rest of it.

    Measured rows are their own bounds; forecast rows repeat the last measured number of
    poor rows, or 0 if nothing was measured.
    """
    measured = trend_history(as_of(facts, date, hour), date, limits).withColumns(
        {
            "upper_density": F.col("total_density").cast("double"),
            "lower_rsrp": F.col("mean_rsrp"),
            "upper_rsrp": F.col("mean_rsrp"),
            "is_forecast": F.lit(False),
        }
    )
    last_time = measured.agg(F.max("record_time")).scalar()
    last_poor = measured.agg(F.max_by("poor_quality_cells", "record_time")).scalar()
    expected = (
        trend_forecast(forecast, date)
        .where(F.coalesce(F.col("record_time") > last_time, F.lit(True)))
        .withColumnsRenamed(
            {"forecast_density": "total_density", "forecast_upper": "upper_density"}
        )
        .withColumns(
            {
                "poor_quality_cells": F.coalesce(last_poor, F.lit(0)).cast("bigint"),
                "is_forecast": F.lit(True),
            }
        )
    )
    return measured.unionByName(expected).withColumn(
        "hour_label", hour_label(F.hour("record_time"))
    )


def load_heatmap(facts: DataFrame, date: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """Mean users by weekday and hour over the last four weeks, on a full 7 x 24 grid."""
    last = F.lit(date).cast("date")
    load = (
        facts.where(F.col("event_date").between(F.date_sub(last, limits.heatmap_days), last))
        .groupBy(iso_weekday(F.col("event_date")).alias("dow_num"), "event_hour")
        .agg(F.avg("user_density_count").alias("_load"))
    )
    slot = F.col("id")
    grid = facts.sparkSession.range(7 * 24).select(
        (F.floor(slot / 24) + 1).cast("int").alias("dow_num"),
        (slot % 24).cast("int").alias("event_hour"),
        F.floor(slot / 168).alias("_grid"),
    )
    filled = grid.join(load, ["dow_num", "event_hour"], "left").select(
        "dow_num", "event_hour", F.coalesce("_load", F.lit(0.0)).alias("avg_density"), "_grid"
    )
    # The grid always has 168 rows; one task takes their maximum.
    busiest = F.max("avg_density").over(Window.partitionBy("_grid"))
    return filled.withColumn("load_band", load_band(F.col("avg_density"), busiest)).drop("_grid")
