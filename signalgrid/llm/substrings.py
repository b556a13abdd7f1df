"""Removal of repeated passages, with windows gathered as super-k-mers.

A window is ``WINDOW`` consecutive words of one text. Its minimiser is the least hash among its
``GRAM``-word pieces; consecutive windows with one minimiser travel as one packed string to the
bucket of that minimiser, where the windows are sorted and counted. Equal windows have equal
minimisers, so each is counted in exactly one bucket.

Skew: windows that repeat inside one piece of the input are reported there and go on once, marked
as known, so a passage that a third of all texts share reaches its bucket once per piece. A
bucket is read as a sorted stream; only its distinct windows stay in memory, as hashes.

Packed strings are compressed with a small dictionary made from ``SAMPLE`` texts; it bears on
their size alone.

Windows are compared by two independent 64-bit hashes of their words. Null texts have no words.
Rows are told apart by id and text, so ids may be null or repeated: a repeated row is another
place where its windows start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from signalgrid.llm.arrays import map_pieces, mix, pieces, text_bytes, word_hashes, word_spans
from signalgrid.llm.work import settle

WINDOW = 35
GRAM = 5
#: Texts, and characters of each, that the dictionary of the packed strings is made from.
SAMPLE = (2000, 2000)
DICTIONARY = 65_536

_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def _rolling(values: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Hash of each run of ``size`` values, by differences of a running sum modulo 2**64."""
    count = len(values) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)

    def powers(base: int) -> np.ndarray:
        result = np.full(len(values), base, np.uint64)
        result[0] = 1
        return np.cumprod(result, dtype=np.uint64)

    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(pow(factor, -1, 1 << 64)), dtype=np.uint64, out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(factor)[:count])


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each run of ``size`` values."""
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (size - width)], values[size - width :])


class _Windows:
    """Words and windows of the texts of a column. ``at``: first word of each window."""

    def __init__(self, column: pa.Array, window: int):
        self.data, offsets = text_bytes(column)
        self.starts, self.ends = word_spans(self.data, offsets, ~_SPACES)
        bounds = np.searchsorted(self.starts, offsets)
        self.words = np.diff(bounds)
        self.hashes = word_hashes(self.data, self.starts, self.ends, 1)
        other = word_hashes(self.data, self.starts, self.ends, 2)
        sizes = np.maximum(self.words - window + 1, 0)
        self.row = np.repeat(np.arange(len(column)), sizes)
        self.place = np.arange(len(self.row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.at = bounds[:-1][self.row] + self.place
        if len(self.at):
            self.first = _rolling(self.hashes, window, 0xD6E8FEB86659FD93)[self.at]
            self.second = _rolling(other, window, 0xA0761D6478BD642F)[self.at]
        else:
            self.first = self.second = np.empty(0, np.uint64)


def _groups(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts equal windows together (earliest first), and the start of each group."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _runs(row: np.ndarray, place: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs of neighbouring places of a row, ``same`` alike in each."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    for values in same:
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new), np.flatnonzero(np.append(new[1:], np.ones(min(len(row), 1), bool)))


def packing_dictionary(docs: DataFrame, text: str) -> bytes:
    """Dictionary for short strings of these texts; empty if there is too little text."""
    rows = docs.where(F.length(text) > 0).select(F.substring(text, 1, SAMPLE[1])).limit(SAMPLE[0])
    samples = [row[0][i : i + 300].encode() for row in rows.collect() for i in range(0, len(row[0]), 300)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=False, write_dict_id=False
    )


def _gather(
    batch: pa.RecordBatch,
    id_column: str,
    text: str,
    window: int,
    gram: int,
    packer: zstandard.ZstdCompressor,
) -> pa.RecordBatch:
    """Super-k-mers of a piece of input, and the passages that repeat inside it."""
    found = _Windows(batch.column(text), window)
    total = len(found.at)
    order, heads = _groups(found.first, found.second)
    repeated = np.zeros(total, bool)
    repeated[heads] = np.diff(np.append(heads, total)) > 1
    known = np.zeros(total, bool)
    known[order] = np.repeat(repeated[heads], np.diff(np.append(heads, total))) if total else False
    goes_on = np.zeros(total, bool)
    goes_on[order[heads]] = True

    told = np.flatnonzero(known)
    a, b = _runs(found.row[told], found.place[told])
    rows = [found.row[told[a]]]
    places = [found.place[told[a]]]
    stops = [found.place[told[b]] + window]

    bucket = np.empty(0, np.uint64)
    if total:
        grams = _rolling(found.hashes, gram, 0x9FB21C651E98DF25)
        bucket = _least(grams, window - gram + 1)[found.at]
    sent = np.flatnonzero(goes_on)
    c, d = _runs(found.row[sent], found.place[sent], bucket[sent], known[sent])
    c, d = sent[c], sent[d]
    raw = found.data.tobytes()
    froms, tos = found.starts[found.at[c]].tolist(), found.ends[found.at[d] + window - 1].tolist()
    packed = [None] * len(a) + [packer.compress(raw[x:y]) for x, y in zip(froms, tos)]
    rows.append(found.row[c])
    places.append(found.place[c])
    stops.append(found.place[d] + window)
    row, place = np.concatenate(rows), np.concatenate(places)
    # Passages that are settled here go to any bucket; a scramble deals them out.
    key = np.concatenate([mix((place[: len(a)] + 1).astype(np.uint64)), bucket[c]])
    return pa.record_batch(
        [
            pa.array(key.view(np.int64)),
            pa.array(np.concatenate([np.ones(len(a), bool), known[c]])),
            batch.column(id_column).take(pa.array(row)),
            batch.column("mark").take(pa.array(row)),
            pa.array(place),
            pa.array(np.concatenate(stops)),
            pa.array(packed, pa.binary()),
        ],
        ["bucket", "known", id_column, "mark", "start", "stop", "packed"],
    )


class _Counter:
    """Counts the windows of a stream of super-k-mers sorted by bucket."""

    def __init__(self, id_column: str, window: int, dictionary: bytes):
        self.id_column, self.window = id_column, window
        self.unpack = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(dictionary)).decompress
        self.kept: dict[str, np.ndarray] | None = None
        self.owners: pa.Table | None = None

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = [self.id_column, "mark"]
        settled = batch.filter(pc.is_null(batch.column("packed")))
        yield settled.select([*names, "start", "stop"])
        batch = batch.filter(pc.is_valid(batch.column("packed")))
        if not batch.num_rows:
            return
        texts = [self.unpack(packed) for packed in batch.column("packed").to_pylist()]
        found = _Windows(pa.array(texts, pa.binary()).cast(pa.string()), self.window)
        now = {
            "first": found.first,
            "second": found.second,
            "owner": found.row,
            "place": batch.column("start").to_numpy()[found.row] + found.place,
            "known": batch.column("known").to_numpy(zero_copy_only=False)[found.row],
            "bucket": batch.column("bucket").to_numpy()[found.row],
        }
        owners = pa.Table.from_batches([batch.select(names)])
        if self.kept is not None:
            now["owner"] = now["owner"] + self.owners.num_rows
            now = {name: np.concatenate([self.kept[name], now[name]]) for name in now}
            owners = pa.concat_tables([self.owners, owners])
        order, heads = _groups(now["first"], now["second"])
        sizes = np.diff(np.append(heads, len(order)))
        known = np.logical_or.reduceat(now["known"][order], heads) | (sizes > 1)
        tell = np.repeat(sizes > 1, sizes) & ~now["known"][order]
        told = order[tell]
        told = told[np.lexsort((now["place"][told], now["owner"][told]))]
        a, b = _runs(now["owner"][told], now["place"][told])
        ids = owners.take(pa.array(now["owner"][told[a]]))
        yield pa.record_batch(
            [
                *(ids.column(name).combine_chunks() for name in names),
                pa.array(now["place"][told[a]]),
                pa.array(now["place"][told[b]] + self.window),
            ],
            [*names, "start", "stop"],
        )
        # Only the last bucket may go on; of its equal windows one is enough.
        heads_at = order[heads]
        stay = now["bucket"][heads_at] == now["bucket"][-1]
        self.kept = {name: values[heads_at[stay]] for name, values in now.items()}
        self.kept["known"] = known[stay]
        used, self.kept["owner"] = np.unique(self.kept["owner"], return_inverse=True)
        self.owners = owners.take(pa.array(used))


def repeated_spans(
    docs: DataFrame, id_column: str, text: str, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Word spans (id, mark, start, stop) covered by windows that also start elsewhere.

    ``docs`` has a column ``mark`` that tells rows of one id apart.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    dictionary = packing_dictionary(docs, text)

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _packer(dictionary)
        for batch in batches:
            for piece in pieces(batch, text, 4 << 20):
                yield _gather(piece, id_column, text, window, gram, packer)

    gathered = docs.select(id_column, "mark", text).mapInArrow(
        gather,
        f"bucket long, known boolean, {id_column} {kind}, mark long, start long, stop long, packed binary",
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(id_column, window, dictionary)
        for batch in batches:
            for piece in pieces(batch, "packed", 1 << 20):
                yield from counter.add(piece)

    return (
        gathered.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(count, f"{id_column} {kind}, mark long, start long, stop long")
    )


def _keep(batch: pa.RecordBatch, id_column: str, text: str) -> pa.RecordBatch:
    """Texts without their spans."""
    data, offsets = text_bytes(batch.column(text))
    raw = data.tobytes()
    totals, gone, kept = [], [], []
    for i, spans in enumerate(batch.column("spans").to_pylist()):
        words = raw[offsets[i] : offsets[i + 1]].split()
        totals.append(len(words))
        if spans:
            covered = np.zeros(len(words) + 1, np.int64)
            for span in spans:
                covered[span["start"]] += 1
                covered[span["stop"]] -= 1
            stays = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
            words = [words[j] for j in stays.tolist()]
        gone.append(totals[-1] - len(words))
        kept.append(b" ".join(words))
    return pa.record_batch(
        [
            batch.column(id_column),
            pa.array(totals, pa.int64()),
            pa.array(gone, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        [id_column, "n_words", "n_removed", "kept"],
    )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per document: id, n_words, n_removed and kept (words left, one space between).

    A text of fewer than ``window`` words loses none. Tables without rows give none.
    """
    if not 1 <= gram <= window:
        raise ValueError("a minimiser has from one to as many words as a window")
    docs = docs.select(id_column, text).withColumn("mark", F.xxhash64(text))
    spans, _ = settle(
        repeated_spans(docs, id_column, text, window, gram)
        .groupBy(id_column, "mark")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    left, right = docs.alias("d"), spans.alias("s")
    joined = left.join(
        right, F.expr(f"d.{id_column} <=> s.{id_column} and d.mark = s.mark"), "left"
    ).select(f"d.{id_column}", f"d.{text}", "s.spans")
    kind = docs.schema[id_column].dataType.simpleString()
    return map_pieces(
        joined,
        text,
        lambda batch: _keep(batch, id_column, text),
        f"{id_column} {kind}, n_words long, n_removed long, kept string",
    )
