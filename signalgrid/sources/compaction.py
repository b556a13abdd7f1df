"""Merging the small files of a Parquet table, folder by folder, by their sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from signalgrid.sources.tables import file_system, remove_files

TARGET = 128 << 20


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files of a table: folder, file (as a URI) and bytes. Only listed, not read."""
    name = F.col("_metadata.file_path")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.regexp_extract(name, "^(.*)/[^/]*$", 1).alias("folder"),
            name.alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
        )
    )


def plan_bins(files: DataFrame, target: int = TARGET, small: int | None = None) -> DataFrame:
    """The files to merge, with the number ``bin`` of their bin in their folder.

    Files below ``small`` bytes (half the target by default) are filled into bins in order of
    size, each until it reaches the target: a bin holds less than ``target + small``. A bin of
    one file is left out, so a table that is compact already gives no rows.
    """
    small = target // 2 if small is None else small
    before = Window.partitionBy("folder").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    filled = files.where(F.col("bytes") < small).withColumn(
        "bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target)
    )
    beside = F.count("*").over(Window.partitionBy("folder", "bin"))
    return filled.withColumn("_beside", beside).where("_beside > 1").drop("_beside")


def compact_table(
    spark: SparkSession,
    path: str,
    target: int = TARGET,
    small: int | None = None,
    sort_by: Sequence[str] = (),
) -> int:
    """Merge small files into files of about ``target`` bytes; the number of files written.

    Larger files are neither read nor moved, and rows stay in their partition folder, whatever the
    spelling of its values. Columns that only some of the files have are null for the rows of the
    others. ``sort_by`` orders the rows of each new file. One shuffle, a bin a task.

    New files are written in full next to the table (``<path>.compact``) with a list of what they
    replace; only then are the old ones deleted and the new ones moved in. If that is cut off,
    :func:`finish_compaction` (or the next call) carries it to its end; no row is lost or doubled,
    but a reader in between may miss some. Not for a table that another job writes to meanwhile:
    files it adds are left alone, files it deletes would come back.
    """
    path = path.rstrip("/")
    finish_compaction(spark, path)
    # One row per small file: no more than the file listing any read of the table holds.
    planned = plan_bins(table_files(spark, path), target, small).collect()
    if not planned:
        return 0
    numbers: dict[tuple[str, int], int] = {}
    for row in planned:
        numbers.setdefault((row["folder"], row["bin"]), len(numbers))
    bins = spark.createDataFrame(
        [(row["file"], row["folder"], numbers[row["folder"], row["bin"]]) for row in planned],
        "_file string, _folder string, _bin int",
    )
    to_uri = spark.sparkContext._jvm.java.net.URI
    place, _ = file_system(spark, path)
    # No partition discovery: folders are taken from the list, columns from the files alone.
    rows = (
        spark.read.option("recursiveFileLookup", True)
        .option("mergeSchema", True)
        .parquet(*(place(to_uri(row["file"])).toString() for row in planned))
    )
    (
        rows.withColumn("_file", F.col("_metadata.file_path"))
        .join(bins.select("_file", "_bin"), "_file")
        .drop("_file")
        .repartitionById(len(numbers), "_bin")
        .sortWithinPartitions("_bin", *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("_bin")
        .parquet(f"{path}.compact/rows")
    )
    # Written last: its mark of success says that all new files are there.
    bins.coalesce(1).write.mode("overwrite").parquet(f"{path}.compact/plan")
    finish_compaction(spark, path)
    return len(numbers)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Carry a compaction that was cut off to its end, or drop what it had not written in full."""
    path = path.rstrip("/")
    stage = f"{path}.compact"
    place, files = file_system(spark, path)
    if not files.exists(place(stage)):
        return
    done = place(f"{stage}/plan/_SUCCESS")
    if files.exists(done):
        plan = spark.read.parquet(f"{stage}/plan").collect()
        remove_files(spark, (row["_file"] for row in plan))
        to_uri = spark.sparkContext._jvm.java.net.URI
        for number, folder in sorted({(row["_bin"], row["_folder"]) for row in plan}):
            written = place(f"{stage}/rows/_bin={number}")
            if not files.exists(written):
                continue
            into = place(to_uri(folder))
            files.mkdirs(into)
            for status in files.listStatus(written):
                name = status.getPath().getName()
                if name.endswith(".parquet") and not files.rename(status.getPath(), place(into, name)):
                    raise OSError(f"could not move {name} into {folder}")
        files.delete(done, False)
        spark.catalog.refreshByPath(path)
    files.delete(place(stage), True)
