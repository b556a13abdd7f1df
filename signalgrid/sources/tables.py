"""Parquet tables: read, overwrite, replace partitions, upsert, register.

A table is a folder of Parquet files, partitioned by date and hour where it grows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from signalgrid.operators.lookups import newest_per_key


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one that ``spark.checkpoint.dir`` names; it goes when
    the driver ends.

    Only a local session may go without the setting; it gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    path = f"{shared.rstrip('/')}/signalgrid-{uuid.uuid4().hex}"
    place, files = file_system(spark, path)
    files.mkdirs(place(path))
    files.deleteOnExit(place(path))
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and go on from there, so that what follows
    neither recomputes the plan nor reads the tables it came from."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, merge: bool = False
) -> DataFrame:
    """Read a table. ``merge`` unites the columns of older and newer files; ``schema`` also
    makes a table without any file readable."""
    reader = spark.read.option("mergeSchema", merge)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a location holds readable data."""
    try:
        read_table(spark, path)
    except AnalysisException as error:
        # Anything else (rights, a broken file) is no absence, and must not be taken for one.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_partition(df: DataFrame, **equal: object) -> DataFrame:
    """The rows of one partition; a pair ``(from, to)`` takes an inclusive range.

    Plain comparisons on the partition columns, so Catalyst lists only their folders.
    """
    for name, wanted in equal.items():
        if isinstance(wanted, tuple):
            df = df.where(F.col(name).between(*(F.lit(edge) for edge in wanted)))
        else:
            df = df.where(F.col(name) == F.lit(wanted))
    return df


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), files: int | None = None
) -> None:
    """Overwrite a whole table. ``files`` asks for that many files per write; without it a
    partitioned table gets its rows rebalanced by partition, hot partitions split."""
    if files is not None:
        df = df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    owned: Iterable[Mapping[str, object]] = (),
) -> None:
    """Replace the partitions that occur in ``df`` and leave all others alone.

    ``owned`` lists partitions the caller answers for even if it has no rows for them (an
    hour that came out empty on a rerun): those are emptied.
    """
    df.hint("rebalance", *partition_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).parquet(path)
    nothing = df.drop(*partition_by).limit(0)
    for spec in owned:
        if read_partition(df, **spec).isEmpty():
            folder = "/".join(f"{name}={spec[name]}" for name in partition_by)
            nothing.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def align_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append with schema evolution: a column missing on one side is null there."""
    return old.unionByName(new, allowMissingColumns=True)


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()
) -> DataFrame:
    """Merge on ``keys``: matching rows are replaced whole, the others inserted.

    Of several new rows with one key the last by ``newest`` counts. A null key matches
    nothing, as in ``MERGE``.
    """
    source = newest_per_key(new, keys, newest)
    kept = old.join(source.select(*keys), list(keys), "left_anti")
    return align_union(kept, source)


def upsert_table(
    new: DataFrame, path: str, keys: Sequence[str], newest: Sequence[str] = ()
) -> None:
    """Upsert into a stored table of one folder; creates it on the first load."""
    spark = new.sparkSession
    finish_swap(spark, path)
    if table_exists(spark, path):
        merged = upsert(read_table(spark, path), new, keys, newest)
    else:
        merged = newest_per_key(new, keys, newest)
    swap_table(merged, path)


def file_system(spark: SparkSession, path: str):
    """The class of paths, and the file system that holds one."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place, place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def swap_table(df: DataFrame, path: str) -> None:
    """Replace a whole table by a complete new folder: at any moment the old or the new rows
    are there in full, in ``path`` or next to it (see :func:`finish_swap`)."""
    spark, path = df.sparkSession, path.rstrip("/")
    place, files = file_system(spark, path)
    write_table(df, f"{path}.next")
    files.delete(place(f"{path}.last"), True)
    if files.exists(place(path)):
        files.rename(place(path), place(f"{path}.last"))
    files.rename(place(f"{path}.next"), place(path))
    files.delete(place(f"{path}.last"), True)
    spark.catalog.refreshByPath(path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Carry a swap that was cut off to its end: of the folders next to a table that is not
    there, the new one if it was written in full, else the old one."""
    path = path.rstrip("/")
    place, files = file_system(spark, path)
    if files.exists(place(path)):
        return
    for name in (f"{path}.next", f"{path}.last"):
        if files.exists(place(f"{name}/_SUCCESS")):
            files.rename(place(name), place(path))
            return


def truncate(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> None:
    """Empty a table. One without partitions keeps its columns; a partitioned one keeps only
    its folder, and the next write brings the columns back."""
    schema = read_table(spark, path).schema
    write_table(spark.createDataFrame([], schema), path, partition_by)


def remove_files(spark: SparkSession, names: Iterable[str]) -> None:
    """Delete these files (as ``DataFrame.inputFiles`` names them) and nothing else of their
    tables; one that is gone already is no error."""
    to_uri = spark.sparkContext._jvm.java.net.URI
    for name in names:
        place, files = file_system(spark, name)
        files.delete(place(to_uri(name)), False)


def register(spark: SparkSession, name: str, path: str, replace: bool = False) -> bool:
    """Make a table known to the session catalog under ``name``.

    Leaves a known table alone unless ``replace``; a location without data is skipped and
    reported as False.
    """
    if not table_exists(spark, path):
        return False
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    known = spark.catalog.tableExists(name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    partitioned = any(column.isPartition for column in spark.catalog.listColumns(name))
    if partitioned:
        spark.catalog.recoverPartitions(name)
    elif known:
        spark.catalog.refreshTable(name)
    return True
