"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from signalgrid.llm.work import drop_folder, settle


def _nearest(links: DataFrame) -> DataFrame:
    """The least neighbour or self of each ``u``; partial sums keep hot nodes apart."""
    return links.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v"), F.col("u")))
    # Large star: every greater neighbour goes to the least node around.
    large = (
        both.join(_nearest(both), "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
    )
    # Small star: the lesser neighbours and the node itself go to the least of them.
    low = _nearest(large)
    small = large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return small.union(low.select("u", F.col("low").alias("v"))).distinct()


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the least node that can be reached, for each node with a link.

    Nodes may be numbers or strings. Links with a null end and links to oneself say nothing.
    Nodes without links have no row. Each round reads and writes the link table; a hub's
    links are one side of a join whose other side has one row per node, so adaptive execution
    can split them.
    """
    spark = links.sparkSession
    now, folder = settle(
        links.where(f"{left} <> {right}")
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .distinct()
    )

    def mark(table: DataFrame) -> tuple:
        row = table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    known = mark(now)
    while known[0]:
        after, newer = settle(_round(now))
        drop_folder(spark, folder)
        now, folder = after, newer
        if (state := mark(now)) == known:
            break
        known = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v"), F.col("v")).distinct()
    )


def numbered(classes: DataFrame) -> DataFrame:
    """The settled classes with a number of their own as ``node``, whatever their ids."""
    return settle(classes.withColumn("node", F.monotonically_increasing_id()))[0]


def with_least_id(classes: DataFrame, links: DataFrame, left: str, right: str) -> DataFrame:
    """Numbered classes (node, id, ...) with ``component``: the least id of the classes that links
    between nodes reach, itself included. Classes without an id carry links on; the component is
    null only if no class in it has an id."""
    parts = connected_components(links, left, right).withColumnsRenamed({"node": "_node", "component": "_part"})
    inside = parts.join(classes.select("node", "id"), F.col("_node") == F.col("node")).select("_node", "_part", "id")
    least = inside.groupBy(F.col("_part").alias("_of")).agg(F.min("id").alias("_least"))
    reached = inside.join(least, F.col("_part") == F.col("_of")).select("_node", "_least")
    # The lesser of both passes over a null.
    return (
        classes.join(reached, F.col("node") == F.col("_node"), "left")
        .withColumn("component", F.least("id", "_least"))
        .drop("_node", "_least")
    )
