"""Additive forecasts from sums: a trend, straight or bending at change points, plus daily terms.

The model of Taylor & Letham, "Forecasting at Scale" (2018): a trend whose slope may change at
given points, few of which are used, and Fourier terms of the day. A least-squares fit needs the
history only through its Gram sums (sums of products of terms, and of terms and targets), so Spark
reduces each series to one row of sums with partial aggregates; no history is shipped to a task or
grouped in Python. From there each fit is a fixed number of rounds of coordinate descent, done for
all rows of an Arrow batch at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations_with_replacement
from math import pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

# Fixed values.
FOURIER_ORDER = 4
HOURS_A_DAY = 24
RIDGE = 0.1  # on every term, so that no fit is undetermined
# Not fixed by the original: our own choices.
CHANGES = 6
CHANGE_SHARE = 0.8  # change points lie in this share of the window
CHANGE_PENALTY = 0.002  # on a slope change, per row and standard deviation of the target
ROUNDS = 60


def change_points(changes: int) -> list[float]:
    """Evenly over the first part of the window, as shares of it."""
    return [CHANGE_SHARE * k / (changes + 1) for k in range(1, changes + 1)]


def terms(share: Column, hour: Column, changes: int) -> list[Column]:
    """Terms of one row: time as a share of the window, what it lies past each change point,
    sine and cosine of the hour of day."""
    bends = [F.greatest(share - F.lit(point), F.lit(0.0)) for point in change_points(changes)]
    angles = [hour * F.lit(2 * pi * k / HOURS_A_DAY) for k in range(1, FOURIER_ORDER + 1)]
    return [share, *bends, *(F.sin(a) for a in angles), *(F.cos(a) for a in angles)]


def design(hours: np.ndarray, window: float, changes: int) -> np.ndarray:
    """The same terms (last axis) of hours since the start of the window, itself a midnight."""
    share = hours[..., None] / window
    angle = 2 * np.pi * hours[..., None] / HOURS_A_DAY * np.arange(1, FOURIER_ORDER + 1)
    bends = np.maximum(share - np.array(change_points(changes)), 0.0)
    return np.concatenate([share, bends, np.sin(angle), np.cos(angle)], axis=-1)


def gram_sums(
    timed: DataFrame, series: Sequence[str], targets: Sequence[str], window: float, changes: int
) -> DataFrame:
    """One row per series: ``n``, ``x`` (sums of terms), ``xx`` (sums of products of two terms, the
    upper triangle by rows), and for each target its sum, sum of squares and sums with terms.

    ``timed`` has ``t``, hours since the start of the window. Rows of a series combine before the
    shuffle, so a series with a third of all rows costs one row of sums a task.
    """
    made = terms(F.col("t") / F.lit(float(window)), F.pmod("t", F.lit(float(HOURS_A_DAY))), changes)
    names = [f"_x{i}" for i in range(len(made))]
    rows = timed.select(
        *series, "last_time", *targets, "t", *(term.alias(name) for term, name in zip(made, names))
    )
    sums = [
        F.count(F.lit(1)).cast("double").alias("n"),
        F.max("last_time").alias("last_time"),
        F.max("t").alias("last_t"),
        F.array(*(F.sum(x) for x in names)).alias("x"),
        F.array(
            *(F.sum(F.col(a) * F.col(b)) for a, b in combinations_with_replacement(names, 2))
        ).alias("xx"),
    ]
    for y in targets:
        sums += [
            F.sum(y).alias(f"{y}_sum"),
            F.sum(F.col(y) * F.col(y)).alias(f"{y}_squares"),
            F.array(*(F.sum(F.col(x) * F.col(y)) for x in names)).alias(f"{y}_x"),
        ]
    return rows.groupBy(*series).agg(*sums)


def descend(
    gram: np.ndarray, products: np.ndarray, penalty: np.ndarray, rounds: int = ROUNDS
) -> np.ndarray:
    """Weights (fits x terms) that lessen squares plus ridge plus ``penalty`` (fits x terms) on
    their absolute values, by ``rounds`` rounds of coordinate descent from 0."""
    weights = np.zeros_like(products)
    for _ in range(rounds):
        for j in range(products.shape[1]):
            own = gram[:, j, j]
            left = products[:, j] - (np.einsum("fi,fi->f", gram[:, j], weights) - own * weights[:, j])
            weights[:, j] = np.sign(left) * np.maximum(np.abs(left) - penalty[:, j], 0.0) / (own + RIDGE)
    return weights


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _fit(batch: pa.RecordBatch, target: str, window: float, changes: int, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres (series x hours ahead) and standard deviations of the residuals."""
    number = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
    n, size = number("n"), batch.column("x").value_lengths()[0].as_py()
    x_mean, y_mean = _matrix(batch, "x") / n[:, None], number(f"{target}_sum") / n
    gram = np.zeros((batch.num_rows, size, size))
    upper = np.triu_indices(size)
    gram[:, upper[0], upper[1]] = gram[:, upper[1], upper[0]] = _matrix(batch, "xx")
    gram -= n[:, None, None] * x_mean[:, :, None] * x_mean[:, None, :]
    variance = number(f"{target}_squares") / n - y_mean * y_mean
    # A target that never changes has rounding for a variance.
    flat = variance <= 1e-12 * y_mean * y_mean
    scale = np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, variance)))
    products = (_matrix(batch, f"{target}_x") - n[:, None] * x_mean * y_mean[:, None]) / scale[:, None]
    products[flat] = 0.0
    penalty = np.zeros_like(products)
    penalty[:, 1 : 1 + changes] = CHANGE_PENALTY * n[:, None]
    weights = descend(gram, products, penalty)
    squares = np.where(flat, 0.0, n) - 2 * (weights * products).sum(axis=1)
    squares += np.einsum("fi,fij,fj->f", weights, gram, weights)
    spread = scale * np.sqrt(np.maximum(squares, 0.0) / np.maximum(n - 1, 1.0))
    hours = number("last_t")[:, None] + np.arange(1, ahead + 1)
    moved = design(hours, window, changes) - x_mean[:, None, :]
    return y_mean[:, None] + scale[:, None] * np.einsum("fhi,fi->fh", moved, weights), spread


def forecast_from_sums(
    sums: DataFrame, series: Sequence[str], targets: Sequence[str], window: float, changes: int, ahead: int
) -> DataFrame:
    """(series, last_time, step from 1, and for each target its centre and ``_sd``)."""
    keys = [sums.schema[name] for name in (*series, "last_time")]
    lists = [StructField(y, ArrayType(DoubleType())) for y in targets]
    spreads = [StructField(f"{y}_sd", DoubleType()) for y in targets]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fits = [_fit(batch, y, window, changes, ahead) for y in targets]
            edges = pa.array(np.arange(batch.num_rows + 1) * ahead, pa.int32())
            centres = [pa.ListArray.from_arrays(edges, pa.array(centre.ravel())) for centre, _ in fits]
            columns = [batch.column(key.name) for key in keys] + centres + [pa.array(sd) for _, sd in fits]
            yield pa.record_batch(columns, [field.name for field in (*keys, *lists, *spreads)])

    fitted = sums.mapInArrow(run, StructType([*keys, *lists, *spreads]))
    steps = fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(ahead))))
    return steps.select(
        *series,
        "last_time",
        "step",
        *(F.element_at(y, F.col("step")).alias(y) for y in targets),
        *(f"{y}_sd" for y in targets),
    )
