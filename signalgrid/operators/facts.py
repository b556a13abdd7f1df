"""The hourly fact: one row per hexagon, cell and hour."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalgrid.functions import HexGrid, share
from signalgrid.operators.enrich import with_distance
from signalgrid.schemas import EVENT_HOUR
from signalgrid.settings import Thresholds


def kpis(digits: int = 2, ratio_digits: int = 4, limits: Thresholds = Thresholds()) -> list[Column]:
    """The measures of the fact. ``user_density_count`` counts rows, not devices."""
    return [
        F.count(F.lit(1)).alias("user_density_count"),
        F.round(F.avg("p_cell_rsrp"), digits).alias("avg_rsrp"),
        F.percentile_approx("p_cell_rsrp", 0.1).alias("p10_rsrp"),
        F.round(F.avg("distance_to_cell_km"), digits).alias("avg_distance_km"),
        F.round(share(F.col("p_cell_rsrp") < limits.weak_rsrp), ratio_digits).alias(
            "weak_signal_ratio"
        ),
    ]


# Our own choice: exact up to so many rows a group, beyond that a rank error of about 0.3 %.
SKETCH_SIZE = 1024


def _levels(
    measurements: DataFrame, cells: DataFrame, grid: HexGrid, hour: Sequence[str]
) -> DataFrame:
    """Measurements by hexagon, cell and hour with their ``level``, null where it is missing or NaN."""
    located = with_distance(measurements, cells, sentinel=False)
    level = F.col("p_cell_rsrp").cast("double")
    return grid.assign(located).select(
        # Adding 0 turns a negative zero into zero, which is the same level.
        "hex_q", "hex_r", "cell_id", *hour, F.when(~F.isnan(level), level + F.lit(0.0)).alias("level")
    )


def sketched(
    measurements: DataFrame,
    cells: DataFrame,
    grid: HexGrid = HexGrid(),
    hour: Sequence[str] = EVENT_HOUR,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Per hexagon, cell and hour: rows, rows with a level, and a quantile sketch of the levels
    (null without any) that can be merged: a low percentile of an hour cannot be rolled up to a day.

    A sketch (KLL) of ``size`` holds all values of a group of up to that many rows; of a bigger one
    the rank of a quantile is off by :func:`rank_error`, whatever the number of rows. Sketches
    are built before the shuffle, so a hot group costs one row a task.
    """
    return (
        _levels(measurements, cells, grid, hour)
        .groupBy("hex_q", "hex_r", "cell_id", *hour)
        .agg(
            F.count(F.lit(1)).alias("user_density_count"),
            F.count("level").alias("level_count"),
            F.kll_sketch_agg_double("level", size).alias("rsrp_sketch"),
        )
        .withColumn("rsrp_sketch", F.when(F.col("level_count") > 0, F.col("rsrp_sketch")))
        .withColumn("hex_id", grid.text_id(F.col("hex_q"), F.col("hex_r")))
        .select("hex_id", "cell_id", *hour, "user_density_count", "level_count", "rsrp_sketch")
    )


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a quantile may be off, at 99 % confidence; 0 for groups of up to
    ``size`` rows. The published fit for KLL sketches."""
    return 2.296 / size**0.9723


def roll_up(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored sketches of hours, merged by ``keys`` (a day, a hexagon, a cell); no measurement is
    read again."""
    return facts.groupBy(*keys).agg(
        F.sum("user_density_count").alias("user_density_count"),
        F.sum("level_count").alias("level_count"),
        F.kll_merge_agg_double("rsrp_sketch").alias("rsrp_sketch"),
    )


def level_quantile(rank: float = 0.1, sketch: str = "rsrp_sketch", count: str = "level_count") -> Column:
    """The least level that a share ``rank`` of the rows does not exceed; null without rows."""
    return F.when(F.col(count) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(rank))))


def level_counts(
    measurements: DataFrame,
    cells: DataFrame,
    grid: HexGrid = HexGrid(),
    hour: Sequence[str] = EVENT_HOUR,
) -> DataFrame:
    """Rows per hexagon, cell, hour and known level, counted before the shuffle. What a sketch of
    a bigger group has lost: with these a quantile of a day is exact (:func:`exact_quantile`)."""
    return (
        _levels(measurements, cells, grid, hour)
        .where("level IS NOT NULL")
        .groupBy("hex_q", "hex_r", "cell_id", *hour, "level")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("hex_id", grid.text_id(F.col("hex_q"), F.col("hex_r")))
        .select("hex_id", "cell_id", *hour, "level", "row_count")
    )


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null keys meet too."""
    named = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    on = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys))
    return left.join(named, on, how).drop(*(f"_{key}" for key in keys))


def exact_quantile(
    rolled: DataFrame,
    counts: DataFrame,
    keys: Sequence[str],
    rank: float = 0.1,
    name: str = "level",
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """``rolled`` sketches (by ``keys``) with column ``name``, the least level that a share ``rank``
    of the rows does not exceed, exact for groups of any size; null without levels.

    The sketch tells about where the level lies, two rank errors to either side. Sums of the stored
    level counts tell whether it lies below, inside or above that range, and only the levels of
    that part are ranked. A sketch that is far off makes the part longer, never the level wrong.
    """
    off = 2 * rank_error(size)
    near = rolled.select(
        *keys,
        level_quantile(max(rank - off, 0.0)).alias("_low"),
        level_quantile(min(rank + off, 1.0)).alias("_high"),
    )
    sums = lambda where: F.coalesce(F.sum(F.when(where, F.col("row_count"))), F.lit(0))
    wanted = F.greatest(F.ceil(F.col("_all") * F.lit(Decimal(str(rank)))), F.lit(1))
    below, inside = F.col("_wanted") <= F.col("_below"), F.col("_wanted") <= F.col("_upto")
    parts = (
        _joined(counts, near, keys)
        .groupBy(*keys, "_low", "_high")
        .agg(
            F.sum("row_count").alias("_all"),
            sums(F.col("level") < F.col("_low")).alias("_below"),
            sums(F.col("level") <= F.col("_high")).alias("_upto"),
        )
        .withColumn("_wanted", wanted)
        .withColumn("_part", F.when(below, -1).when(inside, 0).otherwise(1))
        .withColumn("_left", F.col("_wanted") - F.when(below, 0).when(inside, F.col("_below")).otherwise(F.col("_upto")))
        .select(*keys, "_low", "_high", "_part", "_left")
    )
    part = F.when(F.col("level") < F.col("_low"), -1).when(F.col("level") <= F.col("_high"), 0).otherwise(1)
    ranked = (
        _joined(counts, parts, keys)
        .where(part == F.col("_part"))
        .groupBy(*keys, "_left", "level")
        .agg(F.sum("row_count").alias("row_count"))
        .withColumn("_upto", F.sum("row_count").over(Window.partitionBy(*keys).orderBy("level")))
    )
    found = ranked.where("_upto >= _left").groupBy(*keys).agg(F.min("level").alias(name))
    return _joined(rolled, found, keys, "left")


def hourly(
    measurements: DataFrame,
    cells: DataFrame,
    grid: HexGrid = HexGrid(),
    hour: Sequence[str] = EVENT_HOUR,
    digits: int = 2,
    ratio_digits: int = 4,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Aggregate measurements to facts in one shuffle.

    Groups go by the two integers of the hexagon; its text form is built once per fact.
    Partial aggregates run before the shuffle, so a hot cell or hour costs one row per
    group and task.
    """
    located = with_distance(measurements, cells, sentinel=False)
    placed = grid.assign(located).select(
        "hex_q", "hex_r", "cell_id", *hour, "p_cell_rsrp", "distance_to_cell_km"
    )
    groups = placed.groupBy("hex_q", "hex_r", "cell_id", *hour)
    return (
        groups.agg(*kpis(digits, ratio_digits, limits))
        .withColumn("hex_id", grid.text_id(F.col("hex_q"), F.col("hex_r")))
        .select(
            "hex_id",
            "cell_id",
            *hour,
            "user_density_count",
            "avg_rsrp",
            "p10_rsrp",
            "avg_distance_km",
            "weak_signal_ratio",
        )
    )
