"""Landing files: one headered CSV of measurements per hour, one of cells."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from signalgrid.functions import local_time
from signalgrid.schemas import CELL_COLUMNS, MEASUREMENT_COLUMNS
from signalgrid.settings import LOCAL_ZONE


#: A quoted field, in which commas are text.
_QUOTED = r'"(\\.|[^"\\])*"'


def landing_path(root: str, date: dt.date | str, hour: int) -> str:
    """``<root>/mdt_YYYYMMDDHH.csv``"""
    day = dt.date.fromisoformat(str(date))
    return f"{root.rstrip('/')}/mdt_{day:%Y%m%d}{int(hour):02d}.csv"


def typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Give text columns their types. Bad text becomes null, a missing column is added as
    null, and columns that are not listed stay as they are."""
    out = {
        name: F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        for name, kind in columns.items()
    }
    return df.withColumns(out)


def _read_text_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # Names come from the header line, so column order and extra columns are free; nothing
    # is inferred, so the data is read once only.
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_measurements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Measurements with types; ``time_ms`` is there only if the header names it."""
    raw = _read_text_columns(spark, path)
    columns = dict(MEASUREMENT_COLUMNS)
    if "time_ms" not in raw.columns:
        del columns["time_ms"]
    return typed(raw, columns)


def read_checked(
    spark: SparkSession, path: str | list[str], columns: dict[str, str]
) -> tuple[DataFrame, DataFrame]:
    """The well-formed lines of landing files, typed, and the malformed ones as (line, fields,
    expected, reason, file); every line is in one of the two.

    A plain read cuts lines that are too long and fills up lines that are too short, unseen; both
    shift or lose values. Here the number of fields must be that of the header (of the first
    file; one with another header fails). A value that is no number is no malformed line: it
    becomes null, as in a plain read. ``time_ms`` is there only if the header names it.
    """
    names = _read_text_columns(spark, path).columns
    broken = "_line"
    while broken in names:
        broken += "_"
    shape = StructType([StructField(name, StringType()) for name in (*names, broken)])
    read = (
        spark.read.schema(shape)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", broken)
        # A reader of some columns does not count the fields of a line.
        .option("columnPruning", False)
        .csv(path)
    )
    # Always true: Spark reads no corrupt record without a column beside it.
    first = F.col(f"`{names[0]}`")
    read = read.where(first.isNull() | (F.length(first) >= 0))
    good = read.where(F.col(broken).isNull()).drop(broken)
    line = F.col(broken)
    fields = F.size(F.split(F.regexp_replace(line, _QUOTED, ""), ",", -1))
    rejected = read.where(line.isNotNull()).select(
        line.alias("line"),
        fields.alias("fields"),
        F.lit(len(names)).alias("expected"),
        F.when(fields > len(names), "too many fields")
        .when(fields < len(names), "too few fields")
        .otherwise("unreadable")
        .alias("reason"),
        F.col("_metadata.file_path").alias("file"),
    )
    known = {name: kind for name, kind in columns.items() if name != "time_ms" or name in names}
    return typed(good, known), rejected


def read_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return typed(_read_text_columns(spark, path), CELL_COLUMNS)


def _column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def derive_partitions(
    df: DataFrame,
    batch_date: str | Column,
    batch_hour: int | Column,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Add event time (local date, hour and ``date-hour`` key) next to the batch's own.

    Where there is no ``time_ms``, in the whole file or in one row, the batch stands in.
    """
    arrived_date = _column(batch_date).cast("date")
    arrived_hour = _column(batch_hour).cast("int")
    event_date, event_hour = arrived_date, arrived_hour
    if "time_ms" in df.columns:
        moment = local_time(F.col("time_ms"), zone)
        event_date = F.coalesce(F.to_date(moment), arrived_date)
        event_hour = F.coalesce(F.hour(moment), arrived_hour)
    return df.withColumns(
        {
            "event_date": event_date,
            "event_hour": event_hour,
            "date_hour": F.concat(
                F.date_format(event_date, "yyyy-MM-dd"),
                F.lit("-"),
                F.lpad(event_hour.cast("string"), 2, "0"),
            ),
            "batch_date": arrived_date,
            "batch_hour": arrived_hour,
        }
    )
