"""24-hour forecasts per series, and their error metrics.

A series is one value of the key columns; its history has one row per hour, so it is never
longer than the lookback.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from signalgrid.functions import clip, percent_error, record_time
from signalgrid.operators import additive
from signalgrid.schemas import FORECAST_VALUES
from signalgrid.sources.tables import upsert

SERIES = ("hex_id", "cell_id")
TARGETS = ("user_density_count", "avg_rsrp")

# Fixed values.
LOOKBACK_DAYS = 7
MIN_HISTORY = 24
HORIZON_HOURS = 24
BAND_Z = 1.2816  # half width of an 80 % band in standard deviations
RSRP_RANGE = (-140.0, -40.0)


def history(
    facts: DataFrame,
    until: str,
    days: int = LOOKBACK_DAYS,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """The training rows: the ``days`` days before ``until``, without incomplete rows.

    The window is a plain range on the partition column. One row per series and hour: if
    the series is coarser than the fact, hours are combined (users summed, levels weighted
    by users).
    """
    last = F.lit(until).cast("date")
    window = facts.where(
        (F.col("event_date") >= F.date_sub(last, days)) & (F.col("event_date") < last)
    )
    prepared = window.select(
        *series,
        record_time(F.col("event_date"), F.col("event_hour")).alias("record_time"),
        *TARGETS,
    ).dropna(subset=[*series, "record_time", *TARGETS])
    if set(SERIES) <= set(series):
        return prepared
    users, rsrp = F.col("user_density_count"), F.col("avg_rsrp")
    return prepared.groupBy(*series, "record_time").agg(
        F.sum(users).alias("user_density_count"),
        (F.sum(rsrp * users) / F.sum(users)).alias("avg_rsrp"),
    )


def _hours_since(start: Column, moment: Column) -> Column:
    """Hours from the start of a day; from calendar fields, so no time zone plays a part."""
    return (F.datediff(F.to_date(moment), start) * 24 + F.hour(moment)).cast("double")


def seasonal(
    training: DataFrame, until: str, series: Sequence[str] = SERIES, digits: int | None = None
) -> DataFrame:
    """Linear trend plus hour-of-day effect, with a band from the residuals.

    The fit needs only means, variances and covariances per series and hour of day, so the
    history is read once and reduced to at most 24 rows per series before anything is
    joined; no row goes back to be compared with its fit. Series with less than a day of
    history give nothing. Each forecast starts after the series' own last hour.
    """
    origin = F.date_sub(F.lit(until).cast("date"), LOOKBACK_DAYS)
    t = F.col("t")
    timed = training.withColumns(
        {
            "t": _hours_since(origin, F.col("record_time")),
            "hod": F.hour("record_time"),
            "users": F.col("user_density_count").cast("double"),
            "rsrp": F.col("avg_rsrp"),
        }
    )
    measures = []
    for y in ("users", "rsrp"):
        measures += [
            F.avg(y).alias(f"{y}_mean"),
            F.var_pop(y).alias(f"{y}_var"),
            F.covar_pop(t, F.col(y)).alias(f"{y}_cov"),
        ]
    hourly = timed.groupBy(*series, "hod").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(t).alias("t_mean"),
        F.var_pop(t).alias("t_var"),
        F.max("record_time").alias("last_time"),
        *measures,
    )
    n, tm = F.col("n"), F.col("t_mean")
    totals = [
        F.sum("n").alias("rows"),
        (F.sum(n * tm) / F.sum(n)).alias("t_bar"),
        F.sum(n * (F.col("t_var") + tm * tm)).alias("tt"),
        F.max("last_time").alias("last_time"),
    ]
    slots = [n.alias("n"), F.col("hod").alias("hod"), tm.alias("t"), F.col("t_var").alias("tv")]
    for y in ("users", "rsrp"):
        mean = F.col(f"{y}_mean")
        totals += [
            (F.sum(n * mean) / F.sum(n)).alias(f"{y}_bar"),
            F.sum(n * (F.col(f"{y}_cov") + tm * mean)).alias(f"{y}_ty"),
        ]
        slots += [
            mean.alias(f"{y}_m"),
            F.col(f"{y}_var").alias(f"{y}_v"),
            F.col(f"{y}_cov").alias(f"{y}_c"),
        ]
    fitted = (
        hourly.groupBy(*series)
        # At most 24 slots per series.
        .agg(*totals, F.collect_list(F.struct(*slots)).alias("slots"))
        .where(F.col("rows") >= MIN_HISTORY)
    )
    rows, t_bar = F.col("rows"), F.col("t_bar")

    def slope(y: str) -> Column:
        joint = F.col(f"{y}_ty") - rows * t_bar * F.col(f"{y}_bar")
        return joint / (F.col("tt") - rows * t_bar * t_bar)

    def hour_effects(y: str) -> Column:
        # What the mean of an hour of day lies above the trend.
        base, b = F.col(f"{y}_base"), F.col(f"{y}_slope")
        return F.map_from_entries(
            F.transform("slots", lambda s: F.struct(s["hod"], s[f"{y}_m"] - base - b * s["t"]))
        )

    def deviation(y: str) -> Column:
        # Residuals sum to 0 within each hour of day, so their squares follow from the
        # slots' own variances.
        b = F.col(f"{y}_slope")
        squares = F.aggregate(
            "slots",
            F.lit(0.0),
            lambda total, s: total + s["n"] * (s[f"{y}_v"] - 2 * b * s[f"{y}_c"] + b * b * s["tv"]),
        )
        return F.sqrt(F.greatest(squares, F.lit(0.0)) / (rows - 1))

    targets = ("users", "rsrp")
    fitted = fitted.withColumns({f"{y}_slope": slope(y) for y in targets})
    fitted = fitted.withColumns(
        {f"{y}_base": F.col(f"{y}_bar") - F.col(f"{y}_slope") * t_bar for y in targets}
    )
    fitted = fitted.withColumns(
        {f"{y}_effect": hour_effects(y) for y in targets}
        | {f"{y}_sd": deviation(y) for y in targets}
    )
    ahead = fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(HORIZON_HOURS))))
    ahead = ahead.withColumn(
        "forecast_time",
        F.col("last_time") + F.make_dt_interval(F.lit(0), F.col("step")),
    ).withColumns(
        {
            "t": _hours_since(origin, F.col("forecast_time")),
            "hod": F.hour("forecast_time"),
        }
    )

    def value(y: str, width: float = 0.0) -> Column:
        effect = F.coalesce(F.try_element_at(F.col(f"{y}_effect"), F.col("hod")), F.lit(0.0))
        centre = F.col(f"{y}_base") + F.col(f"{y}_slope") * t + effect
        return centre + width * F.col(f"{y}_sd") if width else centre

    raw = ahead.select(
        *series,
        "forecast_time",
        value("users").alias("forecast_density"),
        value("users", -BAND_Z).alias("forecast_lower"),
        value("users", BAND_Z).alias("forecast_upper"),
        value("rsrp").alias("forecast_rsrp"),
        value("rsrp", -BAND_Z).alias("forecast_rsrp_lower"),
        value("rsrp", BAND_Z).alias("forecast_rsrp_upper"),
    )
    return finish(raw, digits)


def finish(raw: DataFrame, digits: int | None = None) -> DataFrame:
    """Clip to physical ranges, round the load to whole users (the other values to ``digits``
    if given), add the partition columns."""
    clipped = {
        name: clip(F.col(name), 0.0) if "rsrp" not in name else clip(F.col(name), *RSRP_RANGE)
        for name in FORECAST_VALUES
    }
    if digits is not None:
        clipped = {name: F.round(value, digits) for name, value in clipped.items()}
    return (
        raw.withColumns(clipped)
        .withColumn("forecast_density", F.round("forecast_density").cast("int"))
        .withColumn("forecast_date", F.to_date("forecast_time"))
        .withColumn("forecast_hour", F.hour("forecast_time"))
    )


def additive_forecast(
    training: DataFrame,
    until: str,
    series: Sequence[str] = SERIES,
    digits: int | None = None,
    days: int = LOOKBACK_DAYS,
    changes: int = 0,
) -> DataFrame:
    """Trend with ``changes`` possible change points plus daily Fourier terms, fitted from sums.

    The history is read once and reduced to one row per series (see ``additive``). Series with less
    than a day of history give nothing; each forecast starts after the series' own last hour and
    goes on with the last slope. The band comes from the residuals.
    """
    origin = F.date_sub(F.lit(until).cast("date"), days)
    timed = training.select(
        *series,
        _hours_since(origin, F.col("record_time")).alias("t"),
        F.col("record_time").alias("last_time"),
        F.col("user_density_count").cast("double").alias("users"),
        F.col("avg_rsrp").cast("double").alias("rsrp"),
    )
    targets, window = ("users", "rsrp"), days * 24.0
    sums = additive.gram_sums(timed, series, targets, window, changes).where(F.col("n") >= MIN_HISTORY)
    ahead = additive.forecast_from_sums(sums, series, targets, window, changes, HORIZON_HOURS)

    def band(y: str, width: float) -> Column:
        return F.col(y) + width * F.col(f"{y}_sd")

    raw = ahead.select(
        *series,
        (F.col("last_time") + F.make_dt_interval(F.lit(0), F.col("step"))).alias("forecast_time"),
        F.col("users").alias("forecast_density"),
        band("users", -BAND_Z).alias("forecast_lower"),
        band("users", BAND_Z).alias("forecast_upper"),
        F.col("rsrp").alias("forecast_rsrp"),
        band("rsrp", -BAND_Z).alias("forecast_rsrp_lower"),
        band("rsrp", BAND_Z).alias("forecast_rsrp_upper"),
    )
    return finish(raw, digits)


def fourier(
    training: DataFrame,
    until: str,
    series: Sequence[str] = SERIES,
    digits: int | None = None,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Straight trend plus daily Fourier terms."""
    return additive_forecast(training, until, series, digits, days)


def changepoints(
    training: DataFrame,
    until: str,
    series: Sequence[str] = SERIES,
    digits: int | None = None,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Trend whose slope changes at few of some points, plus daily Fourier terms."""
    return additive_forecast(training, until, series, digits, days, changes=additive.CHANGES)


# ---- store ------------------------------------------------------------------------------


def add_to_store(
    stored: DataFrame, ahead: DataFrame, series: Sequence[str] = SERIES
) -> DataFrame:
    """The forecast hours that ``ahead`` touches, after it is added: of a series and hour the
    new value, of all others what was stored. Series may end at different hours, so the hours
    of one run also hold other series' forecasts of earlier runs.

    The list of hours is broadcast: a run's has at most one per hour of lookback and horizon.
    """
    hours = ahead.select("forecast_date", "forecast_hour").distinct()
    there = stored.join(F.broadcast(hours), ["forecast_date", "forecast_hour"], "left_semi")
    return upsert(there, ahead, [*series, "forecast_time"])


# ---- evaluation -------------------------------------------------------------------------


def metrics(
    facts: DataFrame,
    forecast: DataFrame,
    date: str,
    series: Sequence[str] = SERIES,
    digits: int | None = 2,
) -> DataFrame:
    """Errors of a day's forecast per series, over the hours that have both values; not
    rounded if ``digits`` is None."""
    day = F.lit(date).cast("date")
    actual = facts.where(F.col("event_date") == day).select(
        *series,
        F.col("event_hour").alias("_hour"),
        F.col("user_density_count").alias("actual_density"),
        F.col("avg_rsrp").alias("actual_rsrp"),
    )
    predicted = forecast.where(F.col("forecast_date") == day).select(
        *series, F.col("forecast_hour").alias("_hour"), "forecast_density", "forecast_rsrp"
    )
    pairs = actual.join(predicted, [*series, "_hour"])
    load = F.col("actual_density") - F.col("forecast_density")
    level = F.col("actual_rsrp") - F.col("forecast_rsrp")

    def rounded(value: Column, name: str) -> Column:
        return (value if digits is None else F.round(value, digits)).alias(name)

    return pairs.groupBy(*series).agg(
        F.lit(date).cast("date").alias("eval_date"),
        rounded(F.avg(F.abs(load)), "mae_density"),
        rounded(F.sqrt(F.avg(load * load)), "rmse_density"),
        rounded(F.avg(percent_error(F.col("actual_density"), load)), "mape_density"),
        rounded(F.avg(F.abs(level)), "mae_rsrp"),
        rounded(F.sqrt(F.avg(level * level)), "rmse_rsrp"),
        F.count(F.lit(1)).alias("total_matched_records"),
    )


def worst(evaluation: DataFrame, n: int = 100, series: Sequence[str] = SERIES) -> DataFrame:
    """The ``n`` series with the highest load error, ties by key."""
    return evaluation.orderBy(F.col("mape_density").desc(), *series).limit(n)
