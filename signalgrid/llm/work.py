"""Cutting lineage: intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from signalgrid.sources.tables import file_system, work_folder


def drop_folder(spark: SparkSession, path: str) -> None:
    place, files = file_system(spark, path)
    files.delete(place(path), True)


#: Drops a finished execution's shuffle files; nobody reads those of a settled plan again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, settings: Mapping[str, str] = {}, options: Mapping[str, str] = {}) -> tuple[DataFrame, str]:
    """Write ``df`` once and go on from the written table; returns it and its folder.

    What follows recomputes nothing of ``df``, whichever executors are lost. The folder goes
    when the driver ends; a caller that is sure no plan reads it any more drops it earlier.
    ``settings`` of the session hold while it is written; ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/rows"
    settings = {CLEANUP: "true", **settings}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df.write.options(**options).parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path), path
