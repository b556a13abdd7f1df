"""Facts kept up by what changed: parts that can be added and taken away again.

A part counts the rows of one hexagon, cell, hour and level, and sums their distances as decimals.
Parts of the same group add up exactly in any order, and a row that a newer version replaces goes
with a negative count, so late rows need neither the other rows of their hour nor a new hexagon
for them. All measures of the fact follow from the parts, the low percentile too: a quantile
sketch could be merged, but nothing taken out of it.

A group has as many parts as its rows have different levels, a few hundred at the resolution that
devices report. A missing or NaN level counts as a row without a level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from signalgrid.functions import HexGrid
from signalgrid.operators.enrich import with_distance
from signalgrid.operators.late import MERGE_KEYS, affected_partitions, in_partitions, newest_versions
from signalgrid.schemas import EVENT_HOUR
from signalgrid.settings import Thresholds
from signalgrid.sources.tables import materialise, read_table, replace_partitions

GROUP = ("hex_q", "hex_r", "cell_id")
COUNTED = ("row_count", "distance_count", "distance_sum")
#: A nanometre is the last digit; sums have room for more rows than a count.
KILOMETRES = "decimal(17,12)"


def parts(
    measurements: DataFrame,
    cells: DataFrame,
    grid: HexGrid = HexGrid(),
    hour: Sequence[str] = EVENT_HOUR,
) -> DataFrame:
    """The parts of measurements, in one shuffle with partial aggregates before it."""
    placed = grid.assign(with_distance(measurements, cells, sentinel=False))
    level, distance = F.col("p_cell_rsrp").cast("double"), F.col("distance_to_cell_km")
    narrow = placed.select(
        *GROUP,
        *hour,
        # Adding 0 turns a negative zero into zero, which is the same level.
        F.when(~F.isnan(level), level + F.lit(0.0)).alias("level"),
        distance.try_cast(KILOMETRES).alias("km"),
    )
    return _added(
        narrow.select(
            *GROUP,
            *hour,
            "level",
            F.lit(1).cast("long").alias("row_count"),
            F.col("km").isNotNull().cast("long").alias("distance_count"),
            F.coalesce("km", F.lit(0).cast(KILOMETRES)).cast("decimal(38,12)").alias("distance_sum"),
        ),
        hour,
    )


def _added(rows: DataFrame, hour: Sequence[str]) -> DataFrame:
    return rows.groupBy(*GROUP, *hour, "level").agg(
        *(F.sum(name).cast(rows.schema[name].dataType).alias(name) for name in COUNTED)
    )


def replaced(
    silver: DataFrame, arrivals: DataFrame, keys: Sequence[str] = MERGE_KEYS
) -> DataFrame:
    """The stored rows that arrivals are newer versions of. Only the arrivals' hours are read, and
    nothing but the keys decides, so a columnar table gives few columns and few rows."""
    hours = affected_partitions(arrivals)
    return in_partitions(silver, hours).join(arrivals.select(*keys).distinct(), list(keys), "left_semi")


def changes(
    silver: DataFrame,
    arrivals: DataFrame,
    cells: DataFrame,
    grid: HexGrid = HexGrid(),
    keys: Sequence[str] = MERGE_KEYS,
    newest: Sequence[str] = (),
) -> DataFrame:
    """What an upsert of ``arrivals`` into ``silver`` does to the parts: the newest versions are
    added, the rows they replace taken away. ``silver`` is the table before the upsert."""
    coming = newest_versions(arrivals, newest, keys)
    added = parts(coming, cells, grid)
    taken = parts(replaced(silver, coming, keys), cells, grid)
    signed = taken.withColumns({name: (-F.col(name)).cast(taken.schema[name].dataType) for name in COUNTED})
    return _added(added.unionByName(signed), EVENT_HOUR).where(
        " or ".join(f"{name} <> 0" for name in COUNTED)
    )


def add(stored: DataFrame, changed: DataFrame, hour: Sequence[str] = EVENT_HOUR) -> DataFrame:
    """Parts with changes added; a part without rows is gone."""
    columns = [*GROUP, *hour, "level", *COUNTED]
    both = stored.select(*columns).unionByName(changed.select(*columns))
    return _added(both, hour).where("row_count <> 0")


def add_to_table(path: str, changed: DataFrame, partition_by: Sequence[str] = EVENT_HOUR) -> DataFrame:
    """Add changes to stored parts; only partitions with changes are read and written. Returns
    the (partition) values that changed, whose facts are to be built anew.

    Unlike an upsert this is not to be repeated: changes that were added are added again. A job
    that may run twice takes them from ``silver`` before its own merge, and keeps that order.
    """
    spark = changed.sparkSession
    changed = materialise(changed)
    touched = materialise(changed.select(*partition_by).distinct())
    stored = read_table(spark, path).join(F.broadcast(touched), list(partition_by), "left_semi")
    after = materialise(add(stored, changed))
    # A partition that lost its last row must be emptied too: none can, as arrivals replace.
    replace_partitions(after, path, partition_by)
    return touched


def to_facts(
    stored: DataFrame,
    grid: HexGrid = HexGrid(),
    hour: Sequence[str] = EVENT_HOUR,
    digits: int = 2,
    ratio_digits: int = 4,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """The facts of parts, column by column what ``facts.hourly`` gives on their rows.

    ``hour`` may also be coarser than that of the parts: parts of hours add up to days.
    """
    totals = _added(stored, hour)
    group = Window.partitionBy(*GROUP, *hour)
    known = F.when(F.col("level").isNotNull(), F.col("row_count"))
    ranked = totals.select(
        "*",
        F.sum(known).over(group.orderBy("level")).alias("up_to"),
        F.sum(known).over(group).alias("levels"),
    )
    low = F.when(F.col("up_to") * 10 >= F.col("levels"), F.col("level"))
    weak = F.when(F.col("level") < limits.weak_rsrp, F.col("row_count")).otherwise(F.lit(0))
    rows = F.sum("row_count")
    return (
        ranked.groupBy(*GROUP, *hour)
        .agg(
            rows.alias("user_density_count"),
            F.round(F.try_divide(F.sum(F.col("level") * known), F.sum(known)), digits).alias("avg_rsrp"),
            F.min(low).alias("p10_rsrp"),
            F.round(
                F.try_divide(F.sum("distance_sum").cast("double"), F.sum("distance_count").cast("double")), digits
            ).alias("avg_distance_km"),
            F.round(F.try_divide(F.sum(weak).cast("double"), rows.cast("double")), ratio_digits).alias("weak_signal_ratio"),
        )
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
