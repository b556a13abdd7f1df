"""The jobs of the hourly and daily schedules, as functions over a folder of tables.

Each job reads tables, chains operators lazily and acts at its writes. Empty input ends a
job without a write.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalgrid.functions import HexGrid
from signalgrid.operators import dimensions, facts, forecast, late, lookups, quality
from signalgrid.schemas import BATCH, EVENT_HOUR
from signalgrid.settings import Limits, Thresholds
from signalgrid.sources import landing, tables
from signalgrid.sources.tables import materialise, read_partition, read_table, replace_partitions


class QualityGateError(ValueError):
    """A batch scored below the gate. Its rows and report have been written."""


@dataclass(frozen=True)
class Lake:
    """Where the tables are."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in LOCATIONS:
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{LOCATIONS[name]}"


# Folders and names of the tables, which an existing lake already has.
LOCATIONS = {
    "landing": "landing",
    "mdt_raw": "bronze/mdt_raw",
    "cell_raw": "bronze/cell_raw",
    "mdt_clean": "silver/mdt_clean",
    "dirty_data": "silver/dirty_data",
    "late_arrival": "silver/late_arrival_data",
    "late_merged": "silver/late_merged",
    "quality_report": "silver/quality_report",
    "dim_cell": "gold/dim_cell",
    "dim_hex": "gold/dim_hex",
    "dim_date": "gold/dim_date",
    "fact_hourly": "gold/fact_mdt_hourly",
    "forecast": "gold/fact_forecast_hourly",
    "evaluation": "gold/fact_model_evaluation",
    "affected": "silver/affected_partitions",
}

GOLD_TABLES = {
    "fact_mdt_hourly": "fact_hourly",
    "dim_cell": "dim_cell",
    "dim_hex": "dim_hex",
    "dim_date": "dim_date",
    "quality_report": "quality_report",
}
FORECAST_TABLES = {
    "fact_forecast_hourly": "forecast",
    "fact_model_evaluation": "evaluation",
}

# The box of the hexagon dimension and the span of the date dimension.
COUNTRY_LAT = (8.0, 24.0)
COUNTRY_LNG = (102.1, 109.5)
DATE_SPAN = ("2020-01-01", "2030-12-31")


def _date(day: str) -> dt.date:
    return dt.date.fromisoformat(day)


# ---- dimensions -------------------------------------------------------------------------


def build_date_dim(spark: SparkSession, lake: Lake, span: tuple[str, str] = DATE_SPAN) -> None:
    tables.write_table(dimensions.date_dim(dimensions.span(spark, *span)), lake.dim_date, files=1)


def build_hex_dim(
    spark: SparkSession,
    lake: Lake,
    grid: HexGrid = HexGrid(),
    lat: tuple[float, float] = COUNTRY_LAT,
    lng: tuple[float, float] = COUNTRY_LNG,
    files: int = 50,
) -> None:
    hexes = dimensions.hex_dim(dimensions.box(spark, lat, lng), grid, tasks=files)
    # The rows are already spread over that many tasks.
    hexes.write.mode("overwrite").parquet(lake.dim_hex)


def ingest_cells(spark: SparkSession, lake: Lake, path: str) -> None:
    """Keep the cell file as it came, and upsert it into the cell dimension."""
    raw = landing.read_cells(spark, path)
    tables.write_table(raw, lake.cell_raw)
    tables.upsert_table(
        dimensions.cell_dim(read_table(spark, lake.cell_raw)), lake.dim_cell, ["cell_id"]
    )


# ---- hourly -----------------------------------------------------------------------------


def ingest_measurements(
    spark: SparkSession, lake: Lake, date: str, hour: int, path: str | None = None
) -> bool:
    """Landing file to bronze. Running an hour again replaces it."""
    raw = landing.read_measurements(spark, path or landing.landing_path(lake.landing, date, hour))
    if not raw.columns:
        return False
    batch = {"batch_date": _date(date), "batch_hour": hour}
    replace_partitions(
        landing.derive_partitions(raw, date, hour), lake.mdt_raw, BATCH, owned=[batch]
    )
    return True


def check_quality(
    spark: SparkSession,
    lake: Lake,
    date: str,
    hour: int,
    limits: Limits = Limits(),
    gate: float = Thresholds.gate_percent,
) -> bool:
    """Split an hour into clean, quarantined and late rows and write its report.

    Running an hour again replaces it; late rows that had been merged into it are merged
    again.

    Raises :class:`QualityGateError` after writing if the rule score is too low.
    """
    batch = {"batch_date": _date(date), "batch_hour": hour}
    raw = read_partition(read_table(spark, lake.mdt_raw, merge=True), **batch)
    if raw.isEmpty():
        return False
    stored_cells = read_table(spark, lake.dim_cell)
    few = lookups.fits(stored_cells)
    cells = stored_cells.hint("broadcast" if few else "merge")
    on_time, behind = late.split(raw)
    # Only cells with a station have valid distances, so the statistics of one batch have at
    # most as many rows as the dimension.
    rated = materialise(
        quality.classify(on_time, cells, by=BATCH, limits=limits, broadcast_stats=few)
    )
    own = {"event_date": batch["batch_date"], "event_hour": hour}
    clean, dirty = quality.split(rated)
    clean = quality.stamp(clean)
    if tables.table_exists(spark, lake.late_merged):
        again = read_partition(read_table(spark, lake.late_merged, merge=True), **own)
        clean = tables.upsert(clean, again, late.MERGE_KEYS, LATE_ORDER).drop(*BATCH)
    # Set aside first: a run that stops after this finds the late rows again.
    replace_partitions(behind, lake.late_arrival, BATCH, owned=[batch])
    replace_partitions(clean, lake.mdt_clean, EVENT_HOUR, [own])
    replace_partitions(quality.stamp(dirty), lake.dirty_data, EVENT_HOUR, [own])
    scored = quality.report(
        raw, cells, limits=limits, late_apart=True, broadcast_stats=few
    ).withColumn("created_at", F.current_timestamp())
    replace_partitions(scored, lake.quality_report, BATCH)
    written = read_partition(read_table(spark, lake.quality_report), **batch)
    below = quality.failing(written, gate).first()
    if below is not None:
        raise QualityGateError(f"{date} {hour:02d}h scored {below.success_rate:.2f} % < {gate} %")
    return True


def build_facts(
    spark: SparkSession, lake: Lake, date: str, hour: int, grid: HexGrid = HexGrid()
) -> bool:
    own = {"event_date": _date(date), "event_hour": hour}
    clean = read_partition(read_table(spark, lake.mdt_clean, merge=True), **own)
    if clean.isEmpty():
        return False
    hourly = facts.hourly(clean, lookups.sized(read_table(spark, lake.dim_cell)), grid)
    replace_partitions(hourly, lake.fact_hourly, EVENT_HOUR, owned=[own])
    return True


# ---- late rows --------------------------------------------------------------------------

#: Of several versions of a late measurement, the one from the newest batch counts.
LATE_ORDER = [*BATCH, "processed_at"]


def merge_late(
    spark: SparkSession, lake: Lake, limits: Limits = Limits(), grid: HexGrid = HexGrid()
) -> bool:
    """Merge quarantined late rows into the clean table, rebuild the facts of their hours,
    then empty the quarantine of what was read. Late rows that another hour's check writes
    meanwhile stay for the next merge.

    Only hours with late rows are read and written. Rows still pass the quality rules before
    they are merged, by the distance statistics of their whole hour. What is merged is also
    kept by itself, for a later run of the hour. After a crash the job can run again: the
    merge changes nothing the second time, rejected rows may be listed twice.
    """
    if not tables.table_exists(spark, lake.late_arrival):
        return False
    behind = read_table(spark, lake.late_arrival, merge=True)
    # As planned now: what is written while the merge runs is not among them.
    files = behind.inputFiles()
    if behind.isEmpty():
        return False
    cells = lookups.sized(read_table(spark, lake.dim_cell))
    waiting = late.affected_partitions(behind)
    stored = [
        late.in_partitions(read_table(spark, path, merge=True), waiting).select(
            *EVENT_HOUR, "cell_code", "lat", "lng"
        )
        for path in (lake.mdt_clean, lake.dirty_data)
        if tables.table_exists(spark, path)
    ]
    rated = quality.classify(
        late.dedup_late(behind),
        cells,
        by=EVENT_HOUR,
        limits=limits,
        known=reduce(DataFrame.unionByName, stored) if stored else None,
    )
    clean, dirty = quality.split(rated, drop=())
    arrivals = materialise(quality.stamp(clean))
    rejected = materialise(quality.stamp(dirty).drop(*BATCH))
    hours = materialise(late.affected_partitions(arrivals))
    kept = late.newest_versions(arrivals, LATE_ORDER)
    if tables.table_exists(spark, lake.late_merged):
        before = read_table(spark, lake.late_merged, merge=True)
        kept = late.newest_versions(
            tables.align_union(late.in_partitions(before, hours), kept), LATE_ORDER
        )
    kept = materialise(kept)
    replace_partitions(kept, lake.late_merged, EVENT_HOUR)
    hours.coalesce(1).write.mode("overwrite").json(lake.affected)
    # A first late row may come before any other row of the table.
    silver = (
        read_table(spark, lake.mdt_clean, merge=True)
        if tables.table_exists(spark, lake.mdt_clean)
        else kept.drop(*BATCH).limit(0)
    )
    merged = late.merge(silver, kept, newest=LATE_ORDER, hours=hours)
    merged = materialise(merged.drop(*BATCH))
    replace_partitions(merged, lake.mdt_clean, EVENT_HOUR)
    tables.append(rejected, lake.dirty_data, EVENT_HOUR)
    replace_partitions(facts.hourly(merged, cells, grid), lake.fact_hourly, EVENT_HOUR)
    tables.remove_files(spark, files)
    return True


# ---- daily ------------------------------------------------------------------------------


def run_forecast(
    spark: SparkSession,
    lake: Lake,
    date: str,
    days: int = forecast.LOOKBACK_DAYS,
    model: Callable[..., DataFrame] = forecast.seasonal,
) -> bool:
    """Forecast the 24 hours after each series' last hour before ``date``, by ``model``:
    ``forecast.seasonal``, ``fourier`` or ``changepoints``.

    A forecast replaces only an earlier one of the same series and hour; all others stay for
    evaluation, also where they share an hour with a new one.
    """
    training = forecast.history(read_table(spark, lake.fact_hourly), date, days)
    if training.isEmpty():
        return False
    ahead = model(training, date)
    if tables.table_exists(spark, lake.forecast):
        ahead = materialise(ahead)
        stored = read_table(spark, lake.forecast, merge=True)
        # The result reads the hours it replaces.
        ahead = materialise(forecast.add_to_store(stored, ahead))
    replace_partitions(ahead, lake.forecast, ["forecast_date", "forecast_hour"])
    return True


def evaluate_day(spark: SparkSession, lake: Lake, date: str) -> bool:
    scores = forecast.metrics(
        read_table(spark, lake.fact_hourly), read_table(spark, lake.forecast), date
    )
    if scores.isEmpty():
        return False
    replace_partitions(scores, lake.evaluation, ["eval_date"])
    return True


def register_tables(
    spark: SparkSession, lake: Lake, names: dict[str, str] | None = None, replace: bool = False
) -> dict[str, bool]:
    """Register the tables in the session catalog; False marks a location without data."""
    names = names or GOLD_TABLES | FORECAST_TABLES
    return {
        name: tables.register(spark, name, getattr(lake, location), replace)
        for name, location in names.items()
    }

