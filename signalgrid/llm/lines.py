"""Removal of boilerplate lines by the number of distinct sites they spread over.

A line (without blanks at its ends) that stands on at least ``MIN_SITES`` sites is boilerplate and
goes from every document, whatever its share of it. A text that stands, equal as a whole, on several
sites counts as one text of the least of them (in byte order), so copying a document spreads none
of its lines. A document that has no other lines is left with an empty text.

The spread of a line is a HyperLogLog sketch of its sites, built over the lines themselves and
merged by aggregation, so the rows of a line that is everywhere never meet. Only lines that stand
``MIN_SITES`` times can have that many sites, so only those get a sketch. Lines whose estimate is
within ``MARGIN`` of the threshold are counted exactly. Only DataFrame functions run here.

Blank lines count for nothing and stay. Null texts stay null. Rows without a site share one unnamed
site. Rows of one id are told apart by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalgrid.llm.work import settle

MIN_SITES = 10
#: Share around the threshold within which estimates are replaced by exact counts; the sketch's
#: standard error is 1.6 %.
MARGIN = 0.2
LOG_K = 12

BLANKS = " \t\r"
KEY = ["first", "second"]
#: Rows of keys that are sent to every task; more are joined by a shuffle.
SMALL = 200_000


def _lines(text: str | Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(docs: DataFrame, id_column: str, site: str, text: str) -> DataFrame:
    """(id, mark, place, site, first, second) of each line that is not blank; ``mark`` is a hash of
    its text, ``first`` and ``second`` are independent hashes of the line."""
    rows = docs.select(
        F.col(id_column),
        F.xxhash64(text).alias("mark"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(_lines(text)).alias("place", "line"),
    )
    line = F.btrim("line", F.lit(BLANKS))
    return rows.where(F.length(line) > 0).select(
        id_column, "mark", "place", "site", F.xxhash64(line).alias("first"), F.xxhash64(F.lit(1), line).alias("second")
    )


def _small(table: DataFrame) -> DataFrame:
    """A written table, sent to every task if it is small."""
    return F.broadcast(table) if table.count() <= SMALL else table


def copied(docs: DataFrame, site: str, text: str) -> DataFrame:
    """(mark, home) of the texts that stand on several sites; ``home`` is the least of these."""
    rows = docs.where(F.length(text) > 0).select(
        F.xxhash64(text).alias("mark"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site")
    )
    sites = rows.groupBy("mark").agg(F.min("site").alias("home"), F.max("site").alias("last"))
    return sites.where("home < last").select("mark", "home")


def widespread(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """Keys of the lines that stand on at least ``min_sites`` distinct sites."""
    often, _ = settle(lines.groupBy(*KEY).count().where(F.col("count") >= min_sites).select(*KEY))
    often = lines.join(_small(often), KEY, "left_semi")
    estimates, _ = settle(
        often.groupBy(*KEY).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites"))
    )
    sure = estimates.where(F.col("sites") > min_sites * (1 + margin)).select(*KEY)
    near, _ = settle(
        estimates.where(F.col("sites").between(min_sites * (1 - margin), min_sites * (1 + margin))).select(*KEY)
    )
    exact = (
        lines.join(_small(near), KEY, "left_semi")
        # A line's rows of one site become one in each task before they are dealt out.
        .groupBy(*KEY, "site")
        .agg(F.lit(1).alias("one"))
        .groupBy(*KEY)
        .agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select(*KEY)
    )
    return sure.union(exact)


def drop_boilerplate(
    docs: DataFrame,
    id_column: str = "doc_id",
    site: str = "source",
    text: str = "text",
    min_sites: int = MIN_SITES,
    removed: str = "lines_removed",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and their number added as ``removed``.

    Every row stays, with its columns; one that is named like ``removed`` is replaced.
    """
    lines, _ = settle(line_table(docs, id_column, site, text))
    homes, _ = settle(copied(docs, site, text))
    placed = lines.join(_small(homes), "mark", "left").withColumn("site", F.coalesce("home", "site")).drop("home")
    found, _ = settle(widespread(placed, min_sites))
    places = (
        lines.join(_small(found), KEY, "left_semi")
        .groupBy(F.col(id_column).alias("hit_id"), F.col("mark").alias("hit_mark"))
        .agg(F.collect_set("place").alias("hit_places"))
    )
    own = docs.select(F.struct("*").alias("doc"), F.col(id_column).alias("own_id"), F.xxhash64(text).alias("own_mark"))
    joined = own.join(
        places, F.col("own_id").eqNullSafe(F.col("hit_id")) & (F.col("own_mark") == F.col("hit_mark")), "left"
    )
    old = F.col("doc")[text]
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "hit_places")
    kept = F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n")
    return (
        joined.withColumn("lines", F.when(F.col("hit_places").isNotNull(), _lines(old)))
        .withColumn("kept", kept)
        .select(
            *(
                (F.coalesce("kept", old) if name == text else F.col("doc")[name]).alias(name)
                for name in docs.columns
                if name != removed
            ),
            F.when(F.col("hit_places").isNotNull(), F.size("hit_places")).otherwise(0).cast("long").alias(removed),
        )
    )
