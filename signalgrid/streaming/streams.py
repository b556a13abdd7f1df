"""Structured Streaming versions of the batch steps.

Streams take measurements with an ``event_time`` column of type ``timestamp``, because
watermarks need one; its wall clock is the local one, under a UTC session zone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from signalgrid.functions import HexGrid
from signalgrid.operators import late, lookups
from signalgrid.operators.enrich import with_distance
from signalgrid.operators.facts import kpis
from signalgrid.schemas import COPY_KEYS, EVENT_HOUR, MEASUREMENT_COLUMNS
from signalgrid.settings import LOCAL_ZONE, Thresholds
from signalgrid.sources.landing import derive_partitions, typed
from signalgrid.sources.tables import (
    align_union,
    materialise,
    read_table,
    replace_partitions,
    table_exists,
    upsert,
)

WATERMARK = "10 minutes"
STAMP = r"mdt_(\d{8})(\d{2})\.csv"


def with_event_time(measurements: DataFrame, local: str = "ts") -> DataFrame:
    return measurements.withColumn("event_time", F.col(local).cast("timestamp"))


def read_landing(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str] = tuple(MEASUREMENT_COLUMNS),
    archive: str | None = None,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Hourly landing files as a stream; each file is taken once.

    ``columns`` is the header of the files, since a stream cannot look into them first. The
    batch hour comes from the file name. With ``archive`` a finished file is moved there.
    """
    schema = ", ".join(f"`{name}` string" for name in columns)
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        # A file whose header has other names or another order fails instead of going by place.
        .option("enforceSchema", False)
        .option("pathGlobFilter", "mdt_*.csv")
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.csv(folder).withColumn("_file", F.col("_metadata.file_name"))
    known = {k: v for k, v in MEASUREMENT_COLUMNS.items() if k in columns}
    return derive_partitions(
        typed(rows, known),
        F.try_to_date(F.regexp_extract("_file", STAMP, 1), "yyyyMMdd"),
        F.regexp_extract("_file", STAMP, 2).try_cast("int"),
        zone,
    ).drop("_file")


def hourly_facts(
    measurements: DataFrame,
    cells: DataFrame,
    grid: HexGrid = HexGrid(),
    watermark: str = WATERMARK,
    digits: int = 2,
    ratio_digits: int = 4,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """The hourly fact over a stream: an hour comes out once the watermark has passed it."""
    located = grid.assign(with_distance(measurements, cells, sentinel=False))
    hours = F.window("event_time", "1 hour")
    return (
        located.withWatermark("event_time", watermark)
        .groupBy(hours.alias("hour"), "hex_q", "hex_r", "cell_id")
        .agg(*kpis(digits, ratio_digits, limits))
        .select(
            grid.text_id(F.col("hex_q"), F.col("hex_r")).alias("hex_id"),
            "cell_id",
            F.col("hour.start").cast("timestamp_ntz").alias("hour_start"),
            "user_density_count",
            "avg_rsrp",
            "p10_rsrp",
            "avg_distance_km",
            "weak_signal_ratio",
        )
    )


def dedup(
    measurements: DataFrame, watermark: str = WATERMARK, keys: Sequence[str] = COPY_KEYS
) -> DataFrame:
    """Drop copies that follow their first within the watermark."""
    return measurements.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(
        list(keys)
    )


def repair(
    silver: str,
    quarantine: str,
    newest: Sequence[str] = (),
    on_merged: Callable[[DataFrame], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step: on-time rows go to silver, late rows are set aside and then
    merged into the hours they belong to.

    Every write replaces whole partitions with a result that contains them, so a batch that
    runs twice after a failure changes nothing. Rows without a whole merge key (no
    ``time_ms``, say) have no versions: all stay, and carry the number of their batch, by
    which a second run replaces them. Numbers belong to one checkpoint. ``on_merged`` gets
    the merged hours, for the facts to be rebuilt.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # Written once: a batch may be read from its source several times otherwise.
        flagged = materialise(late.flag_late(batch))
        aside = flagged.where("is_late").drop("is_late")
        replace_partitions(
            aside.withColumn("ingest_batch", F.lit(number)), quarantine, ["ingest_batch"]
        )
        rows = flagged.drop("is_late")
        whole = reduce(and_, (F.col(key).isNotNull() for key in late.MERGE_KEYS))
        merged = lookups.newest_per_key(rows.where(whole), late.MERGE_KEYS, newest)
        if table_exists(spark, silver):
            stored = read_table(spark, silver, merge=True)
            stored = late.in_partitions(stored, late.affected_partitions(rows))
            if "ingest_batch" in stored.columns:
                stored = stored.where(~F.col("ingest_batch").eqNullSafe(F.lit(number)))
            merged = upsert(stored, merged, late.MERGE_KEYS, newest)
        loose = rows.where(~whole).withColumn("ingest_batch", F.lit(number))
        # The merge reads the hours it replaces.
        settled = materialise(align_union(merged, loose))
        replace_partitions(settled, silver, EVENT_HOUR)
        if on_merged is not None:
            on_merged(settled)

    return step


def run_available(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    step: Callable[[DataFrame, int], None] | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Process what has arrived, then stop; the checkpoint remembers how far that was.

    Writes to a Parquet table (each row once) or hands the batches to ``step``.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    )
    if step is not None:
        query = writer.foreachBatch(step).start()
    else:
        query = (
            writer.outputMode("append")
            .format("parquet")
            .partitionBy(*partition_by)
            .start(path)
        )
    if wait:
        query.awaitTermination()
    return query
