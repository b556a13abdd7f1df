"""SimHash near-duplicates over a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints with at most ``MAX_BITS`` = 4
differing bits differ in at most four bytes, so at least four positional bytes are shared. The
index holds posting lists of three positional bytes each: of any four positions, some three are
a list of ``COVER``, so every such pair meets in a list. Within a list the shared positional
bytes of a pair are tallied over all eight positions, pairs below four are dropped, and the rest
are verified bit by bit. Links leave a task as one link per fingerprint and group, never as all
pairs; lists with many members are dealt out in pairs of blocks.

Null and empty texts have fingerprint zero, linked like any other. A null ``doc_id`` is
fingerprinted but is nobody's representative. Rows with the same ``doc_id`` each get a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from signalgrid.llm.arrays import map_pieces, spread, star_edges, text_bytes
from signalgrid.llm.components import numbered, with_least_id
from signalgrid.llm.work import settle

WORDS = 4
SEED = 42
MAX_BITS = 4
BLOCK = 2048

_PARTS = ((0, 1, 2), (3, 4, 5), (6, 7))
#: Triples of byte positions such that any four positions hold one of them.
COVER = [triple for part in _PARTS for triple in combinations(part, 3)] + [
    (*pair, other)
    for part, following in zip(_PARTS, (*_PARTS[1:], _PARTS[0]))
    for pair in combinations(part, 2)
    for other in following
]

#: For each byte value a number whose eight bytes are its bits, highest bit first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def shingle_hashes(text: bytes, words: int, seed: int) -> list[int]:
    """Hashes of the word shingles of one text, repeats included."""
    found = text.lower().split()
    if not found:
        return []
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(found), seed)]
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(found) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text (``counts`` hashes each) the 64-bit number of bits set in over half of them."""
    result = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return result
    sizes = counts[some]
    # Sums of at most 255 hashes fit the eight one-byte counters of a number.
    chunks = -(-sizes // 255)
    owner, place = spread(chunks)
    firsts = (np.cumsum(sizes) - sizes)[owner] + place * 255
    lanes = _BITS[hashes.astype(">u8").view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, firsts, axis=0).view(np.uint8).reshape(-1, 64)
    totals = np.add.reduceat(sums, np.cumsum(chunks) - chunks, axis=0, dtype=np.int64)
    bits = (totals * 2 > sizes[:, None]).astype(np.uint8)
    result[some] = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return result


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint as a signed 64-bit number) of every row, by a pass without a shuffle."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column(text))
        raw = data.tobytes()
        hashes: list[int] = []
        counts = np.zeros(batch.num_rows, np.int64)
        for i in range(batch.num_rows):
            own = shingle_hashes(raw[offsets[i] : offsets[i + 1]], WORDS, SEED)
            counts[i] = len(own)
            hashes += own
        prints = majority(np.array(hashes, np.uint64), counts)
        return pa.record_batch(
            [batch.column(id_column), pa.array(prints.view(np.int64))], [id_column, "print"]
        )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_pieces(
        docs.select(id_column, text), text, make, f"{id_column} {kind}, print long", limit=2 << 20
    )


def _lists(prints: DataFrame) -> DataFrame:
    """One row per fingerprint and posting list: key, print, node."""

    def byte(place: int):
        return F.shiftrightunsigned("print", 56 - 8 * place).bitwiseAND(F.lit(255))

    keys = [
        F.lit(number << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c)
        for number, (a, b, c) in enumerate(COVER)
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "print", "node")


def _dealt(lists: DataFrame, block: int) -> DataFrame:
    """Adds ``i, j``: lists of more than ``block`` members are dealt out in pairs of blocks."""
    hot = (
        lists.groupBy("key")
        .count()
        .where(F.col("count") > block)
        .select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    return (
        lists.join(hot, "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "print", "node")
    )


def _links_of_runs(key: np.ndarray, prints: np.ndarray, nodes: np.ndarray, runs: np.ndarray):
    """Verified links inside runs of one list (``runs``: first row of each), vectorised by lag."""
    stops = np.append(runs[1:], len(key))
    last = np.repeat(stops, stops - runs)
    found_a, found_b = [], []
    active = np.flatnonzero(np.arange(len(key)) + 1 < last)
    lag = 1
    while len(active):
        differ = prints[active] ^ prints[active + lag]
        tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        candidate = tally >= 8 - MAX_BITS
        good = candidate.copy()
        good[candidate] = np.bitwise_count(differ[candidate]) <= MAX_BITS
        found_a.append(nodes[active[good]])
        found_b.append(nodes[active[good] + lag])
        lag += 1
        active = active[active + lag < last[active]]
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return star_edges(np.concatenate(found_a), np.concatenate(found_b))


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by list and block pair; whole runs are handled, the last is carried on."""
    rest: pa.Table | None = None

    def links(table: pa.Table) -> pa.RecordBatch:
        key, i, j, prints, nodes = (
            table.column(name).to_numpy() for name in ("key", "i", "j", "print", "node")
        )
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        a, b = _links_of_runs(key, prints.view(np.uint64), nodes, np.flatnonzero(new))
        return pa.record_batch([pa.array(a), pa.array(b)], ["u", "v"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        key, i, j = (table.column(name).to_numpy() for name in ("key", "i", "j"))
        if not len(key):
            continue
        last = (key == key[-1]) & (i == i[-1]) & (j == j[-1])
        cut = len(key) - int(last.sum())
        rest = table.slice(cut)
        if cut:
            yield links(table.slice(0, cut))
    if rest is not None:
        yield links(rest)


def near_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v) links between rows (print, node) with distinct prints, enough to connect every
    group of prints that differ in at most ``MAX_BITS`` bits."""
    dealt = _dealt(_lists(prints), block)
    return (
        dealt.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(_scan, "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (least id reachable).

    Rows without an id link as any other; their component is null if no row in it has an id. An
    empty table gives an empty one.
    """
    prints, _ = settle(fingerprints(docs, id_column, text))
    classes = numbered(prints.groupBy("print").agg(F.min(id_column).alias("id")))
    placed = with_least_id(classes, near_links(classes.drop("id"), block), "u", "v").select(
        F.col("print").alias("own"), F.col("component").alias("component_id")
    )
    return prints.join(placed, prints["print"] == placed["own"], "left").select(
        id_column, F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
