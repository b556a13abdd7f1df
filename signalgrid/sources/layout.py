"""Layouts that make reads cheaper: files along a curve through space and time, and buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from signalgrid.sources.tables import file_system

BITS = 20


def with_coordinates(df: DataFrame, hex_id: str = "hex_id") -> DataFrame:
    """Add ``hex_q`` and ``hex_r`` (bigint) from the text form of a hexagon; null stays null."""
    parts = F.split(hex_id, ":")
    return df.withColumns(
        {"hex_q": F.get(parts, 0).try_cast("bigint"), "hex_r": F.get(parts, 1).try_cast("bigint")}
    )


def curve_key(columns: Sequence[str], bits: int = BITS) -> Column:
    """Place on the Z-order curve through whole-number columns: their bits, interleaved.

    Numbers from ``-2**(bits-1)`` up to ``2**(bits-1) - 1`` keep their order; what lies outside counts as the
    nearest of these. Null if any column is null. At most 63 bits in all.
    """
    if not 0 < bits * len(columns) <= 63:
        raise ValueError("a key has from one to 63 bits")
    half = 1 << (bits - 1)
    total = None
    for at, name in enumerate(columns):
        held = F.least(F.greatest(F.col(name).cast("bigint"), F.lit(-half)), F.lit(half - 1)) + half
        held = F.when(F.col(name).isNotNull(), held)
        for bit in range(bits):
            one = F.shiftleft(F.shiftright(held, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(columns) + at)
            total = one if total is None else total.bitwiseOR(one)
    return total


def write_clustered(
    df: DataFrame,
    path: str,
    coordinates: Sequence[str],
    files: int,
    partition_by: Sequence[str] = (),
    bits: int = BITS,
) -> None:
    """Overwrite a table with files that each hold a short stretch of the curve through
    ``coordinates``, so conditions on any of them skip most files by their footers.

    One range shuffle. A place with many rows (a hot hexagon) is cut by a hash of the row, so it may
    fill several files. Rows with a null coordinate stand together at the start.
    """
    place = curve_key(coordinates, bits)
    dealt = df.withColumns({"_curve": place, "_deal": F.xxhash64(*df.columns)})
    (
        dealt.repartitionByRange(files, *partition_by, "_curve", "_deal")
        .sortWithinPartitions(*partition_by, "_curve")
        .drop("_curve", "_deal")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def within(**ranges: tuple[int, int]) -> Column:
    """Condition on inclusive ranges of coordinates, as plain comparisons that reach the footers."""
    return reduce(Column.__and__, (F.col(name).between(*edges) for name, edges in ranges.items()))


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
) -> None:
    """Overwrite catalog table ``name`` with buckets by ``keys``, one file a bucket (and partition).

    Two tables with as many buckets join on exactly these keys without a shuffle, and each aggregates by them,
    alone or with other columns, without one. (A join on more columns than the keys
    would need ``spark.sql.requireAllClusterKeysForCoPartition`` off, for the whole session.)

    A bucket is never cut: the keys are to be those of single rows, such as a series and its
    hour, or of groups that time bounds, such as a series. The old table is dropped first, so
    ``df`` may not read from it.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    place, files = file_system(spark, path)
    files.delete(place(path), True)
    (
        df.repartition(buckets, *keys)
        .write.option("path", path)
        # Kept with the table: an insert replaces the partitions it has rows for.
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .format("parquet")
        .saveAsTable(name)
    )


def replace_bucketed(df: DataFrame, name: str, buckets: int, keys: Sequence[str]) -> None:
    """Replace the partitions of a bucketed table that occur in ``df``; others stay. Columns go by
    name; ``buckets`` and ``keys`` are those of the table."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).repartition(buckets, *keys).write.mode("overwrite").insertInto(name)
