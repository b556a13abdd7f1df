"""Vectors as four one-byte codes, the nearest codebook entries found by Orchard's search.

Components become integers, vectors are cut into ``PARTS`` equal parts, and each part position has a
codebook of ``ENTRIES`` entries that ``ROUNDS`` rounds of averaging move. All arithmetic is on
integers, so results do not depend on how rows are dealt out.

The search keeps, for every entry, all entries sorted by their distance from it. A part reads the
list of its current entry, ``STRIDE`` entries at a time; when one of them is nearer (or as near with
a lower index) it goes on with the list of that one. Entries it has met are marked and not measured
again. It stops where the list passes twice its current distance: whatever lies beyond is farther
away by the triangle inequality.

A round is one pass over the written integer table: each task adds up its own rows per entry, so
what is dealt out and what the driver gets is bounded by the codebooks, whatever the rows.

Rows whose vector is null or holds null or non-finite components are dropped. Components are held
within ``LIMIT`` (values of 4096 and more), which keeps squares in 64 bits. Vectors shorter than the
longest count as filled up with zeros, and the longest to a multiple of ``PARTS``; empty vectors are
all zeros. With fewer rows than entries the codebooks are shorter. Rows that repeat an id count as
rows of their own, ties by their components; a null id comes after all others. Null labels are one
label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signalgrid.llm.work import settle

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
STRIDE = 16
LIMIT = 1 << 22
#: Components that a task measures at once.
SLICE = 1 << 19
#: Labels up to this number are sent to every task; more are joined by a shuffle.
FEW_LABELS = 100_000


class Orchard:
    """Nearest entry of a codebook (entries x components, integers) for many parts at once."""

    def __init__(self, book: np.ndarray):
        self.book = book
        squares = (book * book).sum(axis=1)
        between = squares[:, None] + squares[None] - 2 * (book @ book.T)
        self.lists = np.argsort(between, axis=1, kind="stable")
        self.away = np.take_along_axis(between, self.lists, axis=1)
        # A first guess lies close on the axis along which the entries differ most.
        self.axis = int(np.argmax(book.max(axis=0) - book.min(axis=0))) if book.shape[1] else -1
        self.sorted = np.argsort(book[:, self.axis], kind="stable") if self.axis >= 0 else None

    def _guess(self, parts: np.ndarray) -> np.ndarray:
        if self.sorted is None:
            return np.zeros(len(parts), np.int64)
        line = self.book[self.sorted, self.axis]
        spot = np.minimum(np.searchsorted(line, parts[:, self.axis]), len(line) - 1)
        return self.sorted[spot]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each part, ties to the lower index."""
        entries = len(self.book)
        best = self._guess(parts)
        gap = ((parts - self.book[best]) ** 2).sum(axis=1)
        marked = np.zeros((len(parts), entries), bool)
        marked[np.arange(len(parts)), best] = True
        at = np.zeros(len(parts), np.int64)
        live = np.arange(len(parts))
        while len(live):
            spots = at[live][:, None] + np.arange(STRIDE)
            listed = spots < entries
            spots = np.minimum(spots, entries - 1)
            now = best[live][:, None]
            entry = self.lists[now, spots]
            listed &= self.away[now, spots] <= 4 * gap[live][:, None]
            fresh = listed & ~marked[live[:, None], entry]
            who, where = np.nonzero(fresh)
            met = entry[who, where]
            who = live[who]
            marked[who, met] = True
            distance = np.full(entry.shape, np.iinfo(np.int64).max)
            distance[fresh] = ((parts[who] - self.book[met]) ** 2).sum(axis=1)
            low = distance.min(axis=1)
            first = np.where(distance == low[:, None], entry, entries).min(axis=1)
            better = (low < gap[live]) | ((low == gap[live]) & (first < best[live]))
            moved = live[better]
            best[moved], gap[moved] = first[better], low[better]
            at[live] = np.where(better, 0, at[live] + STRIDE)
            live = live[better | listed[:, -1]]
        return best, gap


def whole_numbers(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, label, whole) of the rows that are kept; ``whole`` are the floors of the scaled components."""
    number = lambda x: x.cast("double")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))
    held = lambda x: F.greatest(F.least(number(x) * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))
    return vectors.where(finite).select(
        F.col(id_column).alias("id"),
        F.col(label).alias("label"),
        F.transform(vector, lambda x: F.floor(held(x)).cast("int")).alias("whole"),
    )


def _matrices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x width) of slices of bounded size."""
    column = batch.column("whole")
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    step = max(1, SLICE // max(width, 1))
    for begin in range(0, len(sizes), step):
        own = sizes[begin : begin + step]
        matrix = np.zeros((len(own), width), np.int64)
        inside = np.arange(width) < own[:, None]
        matrix[inside] = flat[edges[begin] : edges[begin + len(own)]]
        yield begin, matrix


def _sums(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of all rows of a task: count (place -1) and sum of each component, per part and entry."""
    parts, entries, size = books.shape
    finders = [Orchard(book) for book in books]
    total = np.zeros((parts, entries, size + 1), np.int64)
    for batch in batches:
        for _, matrix in _matrices(batch, parts * size):
            for part, finder in enumerate(finders):
                own = matrix[:, part * size : (part + 1) * size]
                nearest, _ = finder.nearest(own)
                total[part, :, 0] += np.bincount(nearest, minlength=entries)
                for place in range(size):
                    # Sums of a slice are far below 2 ** 53, so whole in double precision.
                    total[part, :, place + 1] += np.bincount(nearest, own[:, place], entries).astype(np.int64)
    used = np.flatnonzero(np.repeat(total[:, :, 0], size + 1))
    yield pa.record_batch([pa.array(used), pa.array(total.ravel()[used])], ["spot", "total"])


def _codes(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, _, size = books.shape
    finders = [Orchard(book) for book in books]
    for batch in batches:
        code = np.zeros((batch.num_rows, parts), np.uint8)
        error = np.zeros(batch.num_rows, np.int64)
        for begin, matrix in _matrices(batch, parts * size):
            for part, finder in enumerate(finders):
                nearest, gap = finder.nearest(matrix[:, part * size : (part + 1) * size])
                code[begin : begin + len(matrix), part] = nearest
                error[begin : begin + len(matrix)] += gap
        text = pa.array([row.tobytes().hex() for row in code], pa.string())
        yield pa.record_batch([batch.column("id"), batch.column("label"), text, pa.array(error)], ["id", "label", "code", "error"])


def learn(whole: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x components) from a table of :func:`whole_numbers`, at most
    256 entries. The driver gets the first ``entries`` rows and, each round, the entries' sums."""
    longest = whole.agg(F.max(F.size("whole"))).first()[0] or 0
    size = -(-longest // PARTS)
    first = whole.orderBy(F.col("id").asc_nulls_last(), "whole").select("whole").limit(entries).collect()
    start = np.zeros((len(first), PARTS * size), np.int64)
    for row, (values,) in enumerate(first):
        start[row, : len(values)] = values
    books = np.ascontiguousarray(start.reshape(len(first), PARTS, size).transpose(1, 0, 2))
    for _ in range(rounds if len(first) else 0):
        task = lambda batches, books=books: _sums(batches, books)
        sums = whole.select("whole").mapInArrow(task, "spot long, total long")
        total = np.zeros(PARTS * len(first) * (size + 1), np.int64)
        for spot, value in sums.groupBy("spot").agg(F.sum("total")).collect():
            total[spot] = value
        total = total.reshape(PARTS, len(first), size + 1)
        counts = total[:, :, :1]
        books = np.where(counts > 0, total[:, :, 1:] // np.maximum(counts, 1), books)
    return books


def encode(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of a table of :func:`whole_numbers`: two hex digits for each part,
    and the squared distance from the entries they name."""
    kinds = {field.name: field.dataType.simpleString() for field in whole.schema}
    task = lambda batches: _codes(batches, books)
    return whole.mapInArrow(task, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """``codes`` with ``near``, the scaled components that a code stands for; null for a null code.
    A column ``near`` of the input is replaced."""
    parts, entries, _ = books.shape
    flat = [[int(x) for x in entry] for book in books for entry in book]
    table = F.from_json(F.lit(str(flat)), "array<array<int>>")
    at = lambda part: F.conv(F.substring(code, 2 * part + 1, 2), 16, 10).cast("int") + part * entries
    return codes.withColumn("near", F.flatten(F.array(*(F.get(table, at(part)) for part in range(parts)))))


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector (id, code, error, label_error), and the codebooks; label_error is
    the error summed over its label, null beyond 64 bits."""
    whole, _ = settle(whole_numbers(vectors, id_column, vector, label))
    books = learn(whole)
    coded, _ = settle(encode(whole, books))
    totals, _ = settle(coded.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error")))
    if totals.count() <= FEW_LABELS:
        totals = F.broadcast(totals)
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select(F.col("id").alias(id_column), "code", "error", "label_error"), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(books_text(books).encode()).hexdigest()
