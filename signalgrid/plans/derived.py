"""Measurements, cells and the tables built on them, derived from the driver's ``events``.

Every event becomes a measurement; no row is left out. The remainders of ``event_id`` only
decide which rows carry a defect (missing or wrong position, odd spelling, second copy,
late arrival, ...), so that each rule and each branch has rows to work on.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalgrid.functions import HexGrid
from signalgrid.operators import dimensions, facts, forecast, late, quality
from signalgrid.settings import Limits, Thresholds, tune

EVENTS = """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
    props string"""

# Parameters of the registered queries.
EDGE_KM = 0.174
DAILY_EDGE_KM = 40.0
SERVING_EDGE_KM = 4.0  # coarse, so that hours of a hexagon hold several devices
GRID = HexGrid(edge_km=EDGE_KM)
SERVING_GRID = HexGrid(edge_km=SERVING_EDGE_KM)
DAY = "2024-01-24"
LAST_WEEK = "2024-01-17"
DAY_BEFORE = "2024-01-23"
BUSY_DAY = "2024-01-28"  # its latest hour has alerts
AFTER_LAST = "2024-01-31"  # nothing is measured on this day
NOON = 11  # the last hour that has been measured in the queries that look ahead
LIMITS = Thresholds(dense_users=3)
# A millimetre: both engines then agree whatever the order they summed a mean in.
ROW_LIMITS = Limits(tolerance_km=1e-6)
DIGITS = 6
FOCUS_CELL = "CCLICK"

# Text that means the same in Spark and in the checking engine.
MEASUREMENT_FIELDS = {
    "event_id": "event_id",
    "device_code": "CAST(user_id AS STRING)",
    "ts": "ts",
    "lat": """CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 107 = 0 THEN 0.0e0
        ELSE 21.0e0 + CAST(event_id % 61 AS DOUBLE) * 0.001e0
          + CASE WHEN event_id % 199 = 0 THEN 1.0e0
                 WHEN event_id % 211 = 0 THEN 0.2e0 ELSE 0.0e0 END END""",
    "lng": "105.80e0 + CAST(event_id % 53 AS DOUBLE) * 0.001e0",
    "cell_code": """CASE WHEN event_id % 2 = 0 THEN 'c ' || event_type
        ELSE 'C' || upper(event_type) END""",
    "p_cell_rsrp": "-140.0e0 + value",
    "p_cell_rsrq": """CASE WHEN event_id % 103 = 0 THEN NULL
        ELSE CAST(-20 + event_id % 20 AS DOUBLE) END""",
    "event_date": "CAST(ts AS DATE)",
    "event_hour": "CAST(extract(hour FROM ts) AS INT)",
    "batch_date": """CAST(ts + CASE WHEN event_id % 40 = 0 THEN INTERVAL '1' HOUR
        ELSE INTERVAL '0' HOUR END AS DATE)""",
    "batch_hour": """CAST(extract(hour FROM ts + CASE WHEN event_id % 40 = 0
        THEN INTERVAL '1' HOUR ELSE INTERVAL '0' HOUR END) AS INT)""",
}
ODD_TIME = """CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 89 = 0
    THEN time_ms * 1000 ELSE time_ms END"""
COPIES = "CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END"

CELL_VALUES = """SELECT
  CASE WHEN i = 1 THEN 'c ' || t ELSE 'C' || upper(t) END AS cell_code,
  21.02e0 + i * 0.01e0 AS x, 105.80e0 + i * 0.01e0 AS y,
  'ST' || CAST(i AS STRING) AS station_code, CAST((i * 72) % 360 AS DOUBLE) AS azimuth,
  'HANOI' AS province_name, 'D' || CAST(i AS STRING) AS district_name
FROM (VALUES ('click', 1), ('error', 2), ('purchase', 3), ('signup', 4)) v(t, i)"""

# One configuration record per event, as if each device reported its cell's settings: many
# records per cell, two spellings, an azimuth that changes. 'view' cells have no record.
STATION_NUMBER = """CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
    WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END"""
CELL_FIELDS = {
    "cell_code": MEASUREMENT_FIELDS["cell_code"],
    "x": "21.02e0 + i * 0.01e0",
    "y": "105.80e0 + i * 0.01e0",
    "station_code": "'ST' || CAST(i AS STRING)",
    "azimuth": "CAST((i * 72 + event_id % 7) % 360 AS DOUBLE)",
    "province_name": "'HANOI'",
    "district_name": "'D' || CAST(i AS STRING)",
    "loaded_at": "ts",
    "event_id": "event_id",
}


def select_list(fields: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in fields.items()]


class Tables:
    """The derived tables of one data folder, built lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    @cached_property
    def events(self) -> DataFrame:
        # With its schema, so that no job looks for it.
        return self.spark.read.schema(EVENTS).parquet(f"{self.folder}/events.parquet")

    @cached_property
    def measurements(self) -> DataFrame:
        return as_measurements(self.events)

    @cached_property
    def cell_records(self) -> DataFrame:
        return (
            self.events.withColumn("i", F.expr(STATION_NUMBER))
            .where(F.col("i").isNotNull())
            .selectExpr(*select_list(CELL_FIELDS))
        )

    @cached_property
    def cells(self) -> DataFrame:
        # Broadcast: one row per type of event.
        return F.broadcast(dimensions.cell_dim(self.spark.sql(CELL_VALUES)))

    @cached_property
    def hexes(self) -> DataFrame:
        return dimensions.hex_dim(dimensions.covered_box(self.measurements), GRID)

    @cached_property
    def serving_hexes(self) -> DataFrame:
        # Broadcast: the country has some 70,000 hexagons of this size.
        return F.broadcast(
            dimensions.hex_dim(dimensions.covered_box(self.measurements), SERVING_GRID, tasks=8)
        )

    @cached_property
    def facts(self) -> DataFrame:
        return facts.hourly(self.measurements, self.cells, SERVING_GRID, digits=DIGITS)

    @cached_property
    def training(self) -> DataFrame:
        return forecast.history(self.facts, DAY)

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast.seasonal(self.training, DAY, digits=DIGITS)

    @cached_property
    def classified(self) -> DataFrame:
        return quality.classify(
            self.measurements, self.cells, order=["ts", "event_id"], limits=ROW_LIMITS
        )

    @cached_property
    def reports(self) -> DataFrame:
        return quality.report(self.measurements, self.cells, limits=ROW_LIMITS)

    @cached_property
    def silver(self) -> DataFrame:
        """On-time measurements, one row per merge key."""
        on_time, _ = late.split(with_time_ms(self.measurements))
        return quality.dedup(on_time, late.MERGE_KEYS)

    @cached_property
    def late_rows(self) -> DataFrame:
        """Late measurements, and corrected versions of some rows that were on time."""
        on_time, arrived_late = late.split(with_time_ms(self.measurements))
        corrected = on_time.where("event_id % 40 = 20").withColumn(
            "p_cell_rsrp", F.col("p_cell_rsrp") - 1
        )
        return late.dedup_late(arrived_late.unionByName(corrected))


def as_measurements(events: DataFrame) -> DataFrame:
    """Measurements of an events frame, batch or stream."""
    repeated = events.withColumn("copy", F.expr(f"explode(sequence(1, {COPIES}))"))
    return repeated.selectExpr(*select_list(MEASUREMENT_FIELDS))


def with_odd_times(measurements: DataFrame) -> DataFrame:
    """Some event times missing, some in microseconds."""
    return measurements.withColumn("time_ms", F.expr(ODD_TIME))


def with_time_ms(measurements: DataFrame) -> DataFrame:
    """The event time as epoch milliseconds, as landing files have it."""
    days = F.datediff(F.to_date("ts"), F.lit("1970-01-01"))
    minutes = days.cast("bigint") * 1440 + F.hour("ts") * 60 + F.minute("ts")
    millis = F.floor(F.extract(F.lit("SECOND"), F.col("ts")) * 1000)
    return measurements.withColumn("time_ms", (minutes * 60000 + millis).cast("bigint"))
