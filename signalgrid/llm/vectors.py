"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Unit vectors are projected on ``PROJECTIONS`` random directions. Two vectors at the cosine
threshold lie within a window of ``WINDOW`` around each other on almost every direction; the least
number of such collisions is calibrated by the binomial law to a recall of ``RECALL``. Pairs that
reach it are verified by their cosine in double precision.

Candidates meet in cells: the first ``AXES`` projections are cut into stretches, and a vector also
goes to neighbouring cells it is within ``HALO`` of. In its own cell, a vector is a query: the
cell's candidates are sorted by one projection; for those within ``HALO`` of the query on it,
collisions in the query's windows are counted over all projections. Cells with many vectors are
dealt out in pairs of blocks, so no task holds more than two blocks. A halo of four standard
deviations of a pair at the threshold, on three axes and the sorted one, keeps 99.97 % of such
pairs; closer pairs are all but sure.

Equal vectors of a label are one class with a size. Vectors that are null, zero or hold null or
non-finite components, and those without a label, link with nothing; vectors of different
lengths do not link. Rows of one id count as different vectors, and may link with each other. A row
whose id is null is linked, counted and passed through as any other, but is nobody's component: its
own is null unless a linked row has an id. An empty table gives an empty one.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signalgrid.llm.arrays import star_edges
from signalgrid.llm.components import numbered, with_least_id
from signalgrid.llm.work import settle

COSINE = 0.98
PROJECTIONS = 16
WINDOW = 0.5
RECALL = 0.99999
AXES = 3
STRETCH = 2.0
HALO = 0.8
BLOCK = 2048
SEED = 11


def least_collisions(count: int, window: float, cosine: float, recall: float) -> int:
    """Collisions among ``count`` directions that a pair at the threshold reaches with
    probability ``recall``: its difference on each is normal with variance 2 - 2 cosine."""
    chance = erf(window / sqrt(2 * (2 - 2 * cosine)))
    reached = 0.0
    for hits in range(count, 0, -1):
        reached += comb(count, hits) * chance**hits * (1 - chance) ** (count - hits)
        if reached >= recall:
            return hits
    return 0


def _unit(column: pa.Array, size: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    # Scaled first, so that no square runs over or under.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _directions(size: int, count: int) -> np.ndarray:
    """Random directions of length ``sqrt(size)``, at right angles as far as there are that
    many; a unit vector's projections then have variance one."""
    made = np.random.default_rng([SEED, size]).normal(size=(size, count))
    made[:, :size] = np.linalg.qr(made[:, :size])[0]
    return made / np.sqrt((made * made).sum(axis=0)) * sqrt(size)


def _cells(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row for each cell that a vector goes to; ``own`` marks the one it is a query in."""
    sizes = batch.column("vector").value_lengths().to_numpy()
    rows, cells, owns = [], [], []
    for size in np.unique(sizes).tolist():
        chosen = np.flatnonzero(sizes == size)
        unit = _unit(batch.column("vector").take(pa.array(chosen)), size)
        place = unit @ _directions(size, PROJECTIONS)[:, :AXES]
        home = np.floor(place / STRETCH).astype(np.int64)
        inside = place - home * STRETCH
        row, cell, own = chosen, np.zeros(len(chosen), np.int64), np.ones(len(chosen), bool)
        index = np.arange(len(chosen))
        for axis in range(AXES):
            parts = []
            for step, goes in (
                (0, np.ones(len(index), bool)),
                (-1, inside[index, axis] <= HALO),
                (1, STRETCH - inside[index, axis] <= HALO),
            ):
                moved = cell[goes] * 4096 + home[index[goes], axis] + step + 2048
                parts.append((index[goes], moved, own[goes] & (step == 0)))
            index, cell, own = (np.concatenate(x) for x in zip(*parts))
        rows.append(row[index])
        cells.append(cell)
        owns.append(own)
    row = np.concatenate(rows) if rows else np.empty(0, np.int64)
    kept = batch.select(["label", "vector", "node", "members"]).take(pa.array(row, pa.int64()))
    return pa.record_batch(
        [
            *kept.columns,
            pa.array(sizes[row].astype(np.int32)),
            pa.array(np.concatenate(cells) if cells else row, pa.int64()),
            pa.array(np.concatenate(owns) if owns else row.astype(bool)),
        ],
        ["label", "vector", "node", "members", "size", "cell", "own"],
    )


def _compare(table: pa.Table, cosine: float, need: int) -> pa.Table:
    """Links of one pair of blocks: (node, null, members linked) and (node, other, null)."""
    table = table.combine_chunks()
    size = table.column("size")[0].as_py()
    column = table.column("vector").combine_chunks()
    unit = _unit(column if isinstance(column, pa.Array) else column.chunk(0), size)
    place = unit @ _directions(size, PROJECTIONS)
    nodes = table.column("node").to_numpy()
    members = table.column("members").to_numpy()
    asks = np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False))
    answers = np.flatnonzero(table.column("answers").to_numpy(zero_copy_only=False))
    # The last projection orders both sides; what is farther than a halo on it is no candidate.
    asks = asks[np.argsort(place[asks, -1], kind="stable")]
    answers = answers[np.argsort(place[answers, -1], kind="stable")]
    line = place[answers, -1]
    linked = np.zeros(len(asks), np.int64)
    left, right = [], []
    for begin in range(0, len(asks), 256):
        part = asks[begin : begin + 256]
        low = np.searchsorted(line, place[part[0], -1] - HALO, side="left")
        high = np.searchsorted(line, place[part[-1], -1] + HALO, side="right")
        near = answers[low:high]
        hits = np.zeros((len(part), len(near)), np.int8)
        for axis in range(PROJECTIONS):
            hits += np.abs(place[part, axis][:, None] - place[near, axis][None]) <= WINDOW
        a, b = np.nonzero(hits >= need)
        good = (nodes[part[a]] != nodes[near[b]]) & (
            np.einsum("ij,ij->i", unit[part[a]], unit[near[b]]) >= cosine
        )
        a, b = a[good], b[good]
        linked[begin : begin + len(part)] = np.bincount(a, members[near[b]], len(part)).astype(np.int64)
        left.append(nodes[part[a]])
        right.append(nodes[near[b]])
    some = linked > 0
    u, v = star_edges(np.concatenate(left), np.concatenate(right)) if left else (nodes[:0], nodes[:0])
    return pa.table(
        {
            "node": pa.array(np.concatenate([nodes[asks[some]], u]), pa.int64()),
            "other": pa.chunked_array([pa.nulls(int(some.sum()), pa.int64()), pa.array(v, pa.int64())]),
            "linked": pa.chunked_array([pa.array(linked[some]), pa.nulls(len(u), pa.int64())]),
        }
    )


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    need = least_collisions(PROJECTIONS, WINDOW, cosine, RECALL)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(id_column).alias("id"),
        F.when(finite & F.exists(vector, lambda x: x != 0), F.col(vector)).alias("vector"),
        F.col(label).alias("label"),
    )
    usable = F.col("vector").isNotNull() & F.col("label").isNotNull()
    # Numbers, not ids, stand for classes: ids may be null, or shared by different vectors.
    classes = numbered(
        rows.where(usable).groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("members"))
    )
    kind = classes.schema["vector"].dataType.simpleString()
    label_kind = classes.schema["label"].dataType.simpleString()

    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                yield _cells(batch)

    placed, _ = settle(
        classes.drop("id").mapInArrow(
            cells,
            f"label {label_kind}, vector {kind}, node long, members long, size int, cell long, own boolean",
        )
    )
    key = ["label", "size", "cell"]
    hot = (
        placed.groupBy(*key)
        .count()
        .where(F.col("count") > block)
        .select(*key, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    dealt = (
        placed.join(hot, key, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("at", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        # As a query in row ``at`` of the pairs of blocks, as a candidate in column ``at``.
        .withColumn(
            "goes",
            F.explode(
                F.when(F.col("step") == F.col("at"), F.array(F.struct(F.col("at").alias("i"), F.col("at").alias("j"))))
                .when(
                    F.col("own"),
                    F.array(
                        F.struct(F.col("at").alias("i"), F.col("step").alias("j")),
                        F.struct(F.col("step").alias("i"), F.col("at").alias("j")),
                    ),
                )
                .otherwise(F.array(F.struct(F.col("step").alias("i"), F.col("at").alias("j"))))
            ),
        )
        .select(
            *key,
            "goes.i",
            "goes.j",
            "vector",
            "node",
            "members",
            (F.col("own") & (F.col("goes.i") == F.col("at"))).alias("asks"),
            (F.col("goes.j") == F.col("at")).alias("answers"),
        )
    )
    # Dealt by pair of blocks: by cell alone, a hot cell's pairs would meet in one task.
    links, _ = settle(
        dealt.repartition(*key, "i", "j").groupBy(*key, "i", "j").applyInArrow(
            lambda table: _compare(table, cosine, need), "node long, other long, linked long"
        )
    )
    counts = links.where("linked is not null").groupBy(F.col("node").alias("own_node")).agg(F.sum("linked").alias("linked"))
    known = (
        with_least_id(classes, links.where("other is not null"), "node", "other")
        .join(counts, F.col("node") == F.col("own_node"), "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("vector").alias("of_vector"),
            (F.col("members") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            "component",
        )
    )
    return rows.join(
        known, (F.col("label") == F.col("of_label")) & (F.col("vector") == F.col("of_vector")), "left"
    ).select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(False)).alias("kept"),
    )
