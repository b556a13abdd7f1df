"""Rows that arrive after their hour: set aside, merge, rebuild."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from signalgrid.functions import HexGrid
from signalgrid.operators.facts import hourly
from signalgrid.operators.lookups import first_per_key, lookup_join, newest_per_key
from signalgrid.operators.quality import not_late
from signalgrid.schemas import COPY_KEYS, EVENT_HOUR
from signalgrid.sources.tables import upsert

MERGE_KEYS = (*EVENT_HOUR, "device_code", "time_ms")


def flag_late(df: DataFrame) -> DataFrame:
    """Add ``is_late``; a row without event time cannot be placed and counts as on time."""
    return df.withColumn("is_late", ~not_late())


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """On-time rows and late rows."""
    flagged = flag_late(df)
    return (
        flagged.where(~F.col("is_late")).drop("is_late"),
        flagged.where(F.col("is_late")).drop("is_late"),
    )


def dedup_late(late: DataFrame, time: str = "time_ms", order: Sequence[str] = ()) -> DataFrame:
    """One row per measurement and event time."""
    return first_per_key(late, [*COPY_KEYS, time], order)


def affected_partitions(late: DataFrame, hour: Sequence[str] = EVENT_HOUR) -> DataFrame:
    """The hours that late rows belong to."""
    return late.select(*hour).distinct()


def in_partitions(df: DataFrame, hours: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows inside (or, with ``left_anti``, outside) a list of hours.

    The list is broadcast: it has one row per hour at most, 88,000 for ten years. On a
    partitioned table the semi join then prunes folders at run time.
    """
    return lookup_join(df, F.broadcast(hours), EVENT_HOUR, how)


def newest_versions(
    late: DataFrame, order: Sequence[str], keys: Sequence[str] = MERGE_KEYS
) -> DataFrame:
    """Of the versions of a late measurement the last by ``order``."""
    return newest_per_key(late, keys, order)


def merge(
    silver: DataFrame,
    late: DataFrame,
    keys: Sequence[str] = MERGE_KEYS,
    newest: Sequence[str] = (),
    hours: DataFrame | None = None,
) -> DataFrame:
    """The affected hours of ``silver`` with the late rows merged in; other hours are
    neither read nor returned. ``hours`` are the affected ones if they are known already."""
    hours = hours if hours is not None else affected_partitions(late)
    return upsert(in_partitions(silver, hours), late, keys, newest)


def merge_all(
    silver: DataFrame,
    late: DataFrame,
    keys: Sequence[str] = MERGE_KEYS,
    newest: Sequence[str] = (),
) -> DataFrame:
    """The whole table after the merge: hours without late rows go through it unchanged, so
    it reads the table and the late rows once each."""
    return upsert(silver, late, keys, newest)


def rebuild_affected(
    merged: DataFrame,
    late: DataFrame,
    cells: DataFrame,
    grid: HexGrid = HexGrid(),
    hours: DataFrame | None = None,
    **options,
) -> DataFrame:
    """The facts of the affected hours only, from silver rows after the merge."""
    hours = hours if hours is not None else affected_partitions(late)
    return hourly(in_partitions(merged, hours), cells, grid, **options)
