"""Arrow columns as numpy arrays, and words of many texts at once.

Texts of one batch lie one behind the other in a byte buffer; ``offsets[i]:offsets[i + 1]`` is
text ``i``. A null counts as an empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

U64 = np.uint64


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buffer of UTF-8 bytes, offsets) of a string column."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece hold about ``limit`` bytes; a longer text is a
    piece of its own."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def map_pieces(
    df: DataFrame,
    column: str,
    make: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    limit: int = 4 << 20,
) -> DataFrame:
    """Run ``make`` on pieces of bounded size inside the tasks, without a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column, limit):
                yield make(piece)

    return df.mapInArrow(run, schema)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of SplitMix64)."""
    values = (values ^ (values >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U64(27))) * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes for which ``inside[byte]``; runs end with their text."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mask = np.zeros(len(data) + 1, bool)
    np.take(inside, data, out=mask[:-1])
    begins = mask[:-1].copy()
    begins[1:] &= ~mask[:-2]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = mask[first]
    starts = np.flatnonzero(begins)
    ends_at = mask[:-1].copy()
    ends_at[:-1] &= ~mask[1:-1]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends_at[last] = mask[last]
    return starts, np.flatnonzero(ends_at) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, fold: bool = False) -> np.ndarray:
    """64-bit hash of each word; ``fold`` makes A-Z and a-z alike."""
    if not len(starts):
        return np.empty(0, U64)
    table = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=U64) | U64(1)
    if fold:
        table[65:91] = table[97:123]
    longest = int((ends - starts).max())
    powers = np.ones(longest, U64)
    powers[1:] = U64(0x9E3779B97F4A7C15)
    powers = np.cumprod(powers, dtype=U64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    # Position of each word byte within its word, over the word bytes alone.
    within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = table[data[within + np.repeat(starts, lengths)]] * powers[within]
    return mix(np.add.reduceat(values, firsts))


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: the group of each member and its place in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


def star_edges(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Reduce links to one link per node, to the least node of its group."""
    nodes, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    left, right = flat[: len(left)], flat[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
        if np.array_equal(before, label) and np.array_equal(label[left], label[right]):
            break
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]
