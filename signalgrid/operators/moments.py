"""Count, mean and squared deviations of a value, stored by hour and merged to longer spans.

Merging adds ``n * (mean - common mean)**2`` of each part to the parts' own squares, the parallel
form of the variance, so nothing is lost to cancellation. Parts with a negative count and
negative squares take rows out again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from signalgrid.operators.quality import plausible_distance
from signalgrid.schemas import BATCH
from signalgrid.settings import Limits


def moments(rows: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys, n, mean, squares) of a value that is not missing; groups without one have n 0."""
    known = F.when(~F.isnan(value), value)
    n = F.count(known)
    return rows.groupBy(*keys).agg(
        n.alias("n"), F.avg(known).alias("mean"), (F.var_pop(known) * n).alias("squares")
    )


def negative(parts: DataFrame) -> DataFrame:
    """Parts that take their rows out of what they are merged with."""
    return parts.withColumns({"n": -F.col("n"), "squares": -F.col("squares")})


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts merged by ``keys`` (one at least): one aggregate for the common means, one for the squares around
    them. Both combine before their shuffle, so a key with many parts is no hot task."""
    means = parts.groupBy(*keys).agg(
        F.sum("n").alias("_n"), F.sum(F.col("n") * F.col("mean")).alias("_sum")
    )
    means = means.select(
        *(F.col(key).alias(f"_{key}") for key in keys), "_n", F.try_divide("_sum", F.col("_n").cast("double")).alias("_mean")
    )
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    apart = F.col("mean") - F.col("_mean")
    return parts.join(means, reduce(and_, same)).groupBy(*keys).agg(
        F.max("_n").alias("n"),
        F.max("_mean").alias("mean"),
        F.greatest(F.sum(F.col("squares") + F.col("n") * apart * apart), F.lit(0.0)).alias("squares"),
    )


def sample_deviation(n: str = "n", squares: str = "squares") -> Column:
    """Null for fewer than two values."""
    return F.when(F.col(n) > 1, F.sqrt(F.col(squares) / (F.col(n) - 1)))


def distance_moments(
    located: DataFrame,
    by: Sequence[str] = BATCH,
    scope: str = "valid",
    limits: Limits = Limits(),
) -> DataFrame:
    """Moments of the distance per batch and cell, to be stored with the hour."""
    return moments(located, [*by, "cell_id"], plausible_distance(scope, limits))


def distance_stats(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What ``quality.distance_stats`` gives on all rows, from their stored moments."""
    return merged(parts, [*by, "cell_id"]).select(
        *by, "cell_id", F.col("mean").alias("mean_distance_km"), sample_deviation().alias("sd_distance_km")
    )
