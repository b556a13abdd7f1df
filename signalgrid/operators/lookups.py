"""Joins against small tables, and one-row-per-key without a hot task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# About 200 MB of narrow dimension rows on each executor.
MAX_BROADCAST_ROWS = 2_000_000
# Half a megabyte of bitmap in each task.
COPY_BITS = 1 << 22


def fits(stored: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a stored table is small enough to send to every executor. Counts its rows,
    which on a Parquet table reads footers only; for the edge of a job, not for operators."""
    return stored.count() <= rows


def sized(stored: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A stored lookup marked with how to join it, by its counted size."""
    return stored.hint("broadcast" if fits(stored, rows) else "merge")


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    take: Mapping[str, str] | None = None,
) -> DataFrame:
    """Join a big table with a lookup. No job runs here: whoever knows the size of the lookup
    marks it (:func:`sized`), else Spark's estimate decides. Without a broadcast both sides
    are shuffled, and adaptive execution splits the partitions of hot keys.

    ``take`` picks columns of the lookup and names them; by default all come along.
    """
    if take is not None:
        lookup = lookup.select(*on, *(F.col(c).alias(name) for c, name in take.items()))
    return left.join(lookup, list(on), how)


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = F.struct(*order, *rest)
    if not order and not rest:
        return df.select(*keys).distinct()
    # An aggregate rather than a window: each task reduces its own rows to one per key
    # before the shuffle, so a key with a third of all rows costs nothing extra.
    return (
        df.groupBy(*keys).agg(pick(ranked).alias("_row")).select(*keys, "_row.*").select(df.columns)
    )


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row per key by ``order``, ties by the remaining columns."""
    return _one_per_key(df, keys, order, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row per key by ``order``, ties by the remaining columns."""
    return _one_per_key(df, keys, order, F.min)


def maybe_copied(df: DataFrame, keys: Sequence[str], bits: int = COPY_BITS) -> Column:
    """A condition on rows of ``df`` that holds for all whose keys occur more than once, and for
    about one in ``bits`` of the others for each copied key.

    Hashes of the keys are counted in a narrow shuffle; those that come again set bits of a bitmap
    of fixed size, which goes to every task as a scalar subquery. Hashes that collide or share a
    bit only let a few more rows through. No job runs while the plan is built.
    """
    hashed = F.xxhash64(*keys)
    again = df.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    place = F.pmod("_hash", F.lit(bits))
    words = again.select(
        F.shiftright(place, 6).alias("_word"),
        # Shifts take the place within a word.
        F.expr(f"shiftleft(1L, cast(pmod(_hash, {bits}L) % 64 AS int))").alias("_set"),
    )
    all_words = df.sparkSession.range(0, bits // 64, 1, 1).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_set"))
    one = (
        words.union(all_words)
        .groupBy("_word")
        .agg(F.bit_or("_set").alias("_set"))
        .agg(F.array_sort(F.collect_list(F.struct("_word", "_set")))["_set"].alias("_bitmap"))
    )
    own = F.pmod(hashed, F.lit(bits))
    return F.getbit(F.get(one.scalar(), F.shiftright(own, 6).cast("int")), (own % 64).cast("int")) == 1


def flag_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "is_first_copy",
    bits: int = COPY_BITS,
) -> DataFrame:
    """Mark the first row per key and keep all rows; ties beyond ``order`` go by the other columns.

    Rows whose key is nowhere else are their own first: a bitmap of the hashes of copied keys
    (:func:`maybe_copied`) tells them, and they are never shuffled. Only what it lets through is
    compared. ``bits`` costs an eighth of its number in bytes; some 16 for each copied key keep
    nearly all other rows out, fewer only shuffle more of them.

    ``df`` is read three times and must give the same rows each time: a stored table, or steps
    that depend on nothing but their input.
    """
    suspect = maybe_copied(df, keys, bits)
    marked = df.withColumn("_suspect", suspect)
    alone = marked.where(~F.col("_suspect")).drop("_suspect").withColumn(name, F.lit(True))
    return alone.unionByName(_flag_among(marked.where("_suspect").drop("_suspect"), keys, order, name))


def _flag_among(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Mark the first row per key and keep all rows.

    Two steps, so that no task gets all copies of a hot key: the copies that came from one
    input partition settle their first among themselves, then only those firsts meet. Rows
    that lost stay spread over their old partitions. The outcome does not depend on how the
    input was split; while it runs, the split must be that of a stored input.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranking = [*order, *rest]
    split = df.withColumn("_split", F.spark_partition_id())
    local = split.withColumn(
        "_local",
        F.row_number().over(Window.partitionBy(*keys, "_split").orderBy(*ranking)),
    ).withColumn("_group", F.when(F.col("_local") > 1, F.col("_split")))
    return local.withColumn(
        name,
        (F.col("_local") == 1)
        & (
            F.row_number().over(Window.partitionBy(*keys, "_group").orderBy(*ranking)) == 1
        ),
    ).drop("_split", "_local", "_group")
