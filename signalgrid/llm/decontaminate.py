"""Benchmark decontamination by winnowing.

Of the ``k``-word pieces (grams) in every sliding window of ``window - k + 1`` grams the least
hash is kept as a fingerprint, so any two texts that share ``window`` words in a row share a
fingerprint inside them. Fingerprints of documents and benchmark items are joined and each hit is
extended word by word to both sides, as far as a window around it reaches; extensions of at least
``window`` words are hits. An item of fewer words is one window by itself: all of its own length's
grams of the documents are looked up.

A word is a run of digits, letters a-z (A-Z count as a-z) and characters beyond ASCII. Null
texts have no words. Items without words occur nowhere. Items of equal words are joined as one
and named each. Rows of one id count as one document: it has the words of its longest row, and
hits of all its rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from signalgrid.llm.arrays import map_pieces, mix, text_bytes, word_hashes, word_spans
from signalgrid.llm.work import settle

WINDOW = 10
GRAM = 5
#: Fingerprints of benchmark items that are sent to every task to sift documents; with more of
#: them (or more bytes of context), all fingerprints of the documents are shuffled and joined.
BROADCAST_PRINTS = 500_000
BROADCAST_BYTES = 64 << 20
#: Parts into which each fingerprint is dealt in the shuffled form.
SALTS = 16

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class _Words:
    """Words of the texts of a column; ``left``: words from each word on to its text's end."""

    def __init__(self, column: pa.Array):
        self.data, offsets = text_bytes(column)
        self.starts, self.ends = word_spans(self.data, offsets, _INSIDE)
        bounds = np.searchsorted(self.starts, offsets)
        self.count = np.diff(bounds)
        self.hashes = word_hashes(self.data, self.starts, self.ends, 3, fold=True)
        self.row = np.repeat(np.arange(len(column)), self.count)
        self.first = bounds[:-1][self.row]
        self.left = bounds[1:][self.row] - np.arange(len(self.row))
        self.raw = self.data.tobytes()

    def grams(self, size: int) -> np.ndarray:
        """Hash of ``size`` words from each word on; zero where the text ends before."""
        total = len(self.hashes)
        result = np.zeros(total, np.uint64)
        if total >= size:
            sums = np.zeros(total - size + 1, np.uint64)
            for i in range(size):
                sums = sums * np.uint64(0xC2B2AE3D27D4EB4F) + self.hashes[i : total - size + 1 + i]
            result[: len(sums)] = mix(sums + np.uint64(size)) | np.uint64(1)
        result[self.left < size] = 0
        return result

    def winnowed(self, size: int, width: int) -> np.ndarray:
        """First words of grams that are the least of some window of ``width`` grams."""
        values = self.grams(size)
        total = len(values) - width + 1
        if total <= 0:
            return np.empty(0, np.int64)
        least = values[:total].copy()
        for i in range(1, width):
            np.minimum(least, values[i : total + i], out=least)
        # Zero marks windows that run over the end of a text.
        best = np.zeros(len(values), np.uint64)
        for i in range(width):
            np.maximum(best[i : total + i], least, out=best[i : total + i])
        return np.flatnonzero((values == best) & (values != 0))

    def context(self, at: np.ndarray, size: int, reach: int) -> tuple[list[str], np.ndarray]:
        """Words around grams, space-joined in lower case, and how many stand before the gram."""
        before = np.minimum(at - self.first[at], reach)
        after = np.minimum(self.left[at], size + reach)
        texts = []
        for a, b in zip((at - before).tolist(), (at + after).tolist()):
            words = (self.raw[x:y] for x, y in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist()))
            texts.append(b" ".join(words).lower().decode())
        return texts, before


def _prints(
    batch: pa.RecordBatch,
    id_column: str,
    text: str,
    window: int,
    gram: int,
    shorter: list[int],
    wanted: np.ndarray | None,
    is_item: bool,
) -> pa.RecordBatch:
    """A row for every text with its number of words, and its fingerprints with context.

    ``shorter``: lengths of items below a window. ``wanted``: sorted hashes worth keeping.
    """
    words = _Words(batch.column(text))
    rows = [np.arange(batch.num_rows)]
    places = [np.full(batch.num_rows, -1)]
    sizes = [np.zeros(batch.num_rows, np.int64)]
    hashes = [np.zeros(batch.num_rows, np.uint64)]
    befores = [np.zeros(batch.num_rows, np.int64)]
    contexts: list[str | None] = [None] * batch.num_rows
    for size in [window, *shorter]:
        if size == window:
            at = words.winnowed(gram, window - gram + 1)
            values, length, reach = words.grams(gram)[at], gram, window - gram
        else:
            values, length, reach = words.grams(size), size, 0
            at = np.flatnonzero(values)
            if is_item:
                at = at[words.count[words.row[at]] == size]
            values = values[at]
        values = mix(values + np.uint64(size))
        if wanted is not None and len(at):
            place = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
            worth = wanted[place] == values if len(wanted) else np.zeros(len(at), bool)
            at, values = at[worth], values[worth]
        texts, before = words.context(at, length, reach)
        rows.append(words.row[at])
        places.append(at - words.first[at])
        sizes.append(np.full(len(at), size))
        hashes.append(values)
        befores.append(before)
        contexts += texts
    row = np.concatenate(rows)
    return pa.record_batch(
        [
            batch.column(id_column).take(pa.array(row)),
            pa.array(words.count[row]),
            pa.array(np.concatenate(places)),
            pa.array(np.concatenate(sizes)),
            pa.array(np.concatenate(hashes).view(np.int64)),
            pa.array(np.concatenate(befores)),
            pa.array(contexts, pa.string()),
        ],
        [id_column, "n_words", "place", "size", "print", "before", "context"],
    )


def fingerprints(
    texts: DataFrame,
    id_column: str,
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    shorter: list[int] | None = None,
    wanted: np.ndarray | None = None,
    is_item: bool = False,
) -> DataFrame:
    """(id, n_words, place, size, print, before, context); place -1 is the row of the text itself."""
    shorter = shorter if shorter is not None else list(range(1, window))
    kind = texts.schema[id_column].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(wanted)
    return map_pieces(
        texts.select(id_column, text),
        text,
        lambda batch: _prints(batch, id_column, text, window, gram, shorter, shared.value, is_item),
        f"{id_column} {kind}, n_words long, place long, size long, print long, before long, context string",
    )


def _extend(batch: pa.RecordBatch, id_column: str, window: int, gram: int) -> pa.RecordBatch:
    """Extend joined fingerprints to both sides; keeps those that reach a whole window."""
    names = ("context", "before", "place", "size", "item_context", "item_before")
    columns = zip(*(batch.column(name).to_pylist() for name in names))
    rows, starts, stops = [], [], []
    for row, (mine, before, place, size, other, item_before) in enumerate(columns):
        length = gram if size == window else size
        a, b = mine.split(" "), other.split(" ")
        if a[before : before + length] != b[item_before : item_before + length]:
            continue
        left = 0
        while left < min(before, item_before) and a[before - 1 - left] == b[item_before - 1 - left]:
            left += 1
        right = length
        most = min(len(a) - before, len(b) - item_before)
        while right < most and a[before + right] == b[item_before + right]:
            right += 1
        if left + right >= size:
            rows.append(row)
            starts.append(place - left)
            stops.append(place + right)
    kept = batch.select([id_column, "item"]).take(pa.array(rows, pa.int64()))
    return pa.record_batch(
        [*kept.columns, pa.array(starts, pa.int64()), pa.array(stops, pa.int64())],
        [id_column, "item", "start", "stop"],
    )


def _covered(spans: DataFrame, id_column: str) -> DataFrame:
    """Words inside any span, per id."""
    order = Window.partitionBy(id_column).orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(reached, F.lit(0))))
    return spans.withColumn("fresh", fresh).groupBy(id_column).agg(F.sum("fresh").alias("n_hit"))


def hits(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_prints: int = BROADCAST_PRINTS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: (id, n_words) of all documents; (id, start, stop) spans of words that stand
    in windows of items; (id, item) pairs of a document and an occurring item, by ``item_id``."""
    if not 1 <= gram <= window:
        raise ValueError("a gram has from one to as many words as a window")
    kind = docs.schema[id_column].dataType.simpleString()
    named = items.select(
        F.col(item_id).alias("item"), F.col(text).alias("item_text"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("same")
    )
    # Items of the same text are searched once, under the least of their ids.
    names, _ = settle(named.select("item", "same").distinct())
    least = named.groupBy("same").agg(F.first("item_text").alias("item_text"))
    made, _ = settle(fingerprints(least, "same", "item_text", window, gram, is_item=True).where("place >= 0"))
    prints = made.select(
        F.col("same").alias("item"),
        "print",
        F.col("before").alias("item_before"),
        F.col("context").alias("item_context"),
    ).distinct()
    size = prints.agg(F.count("*"), F.sum(F.octet_length("item_context"))).first()
    shorter = [row[0] for row in made.where(F.col("size") < window).select("size").distinct().collect()]
    small = size[0] <= broadcast_prints and (size[1] or 0) <= BROADCAST_BYTES
    wanted = None
    if small:
        rows = prints.select("print").distinct().collect()
        wanted = np.sort(np.array([row[0] for row in rows], np.int64).view(np.uint64))
    found, _ = settle(fingerprints(docs, id_column, text, window, gram, shorter, wanted))
    mine = found.where("place >= 0")
    if small:
        joined = mine.join(F.broadcast(prints), "print")
    else:
        salted = prints.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(id_column, "place"), F.lit(SALTS)).cast("int")
        joined = mine.withColumn("salt", salt).join(salted, ["print", "salt"])

    def extend(batches):
        for batch in batches:
            yield _extend(batch, id_column, window, gram)

    spans, _ = settle(
        joined.select(id_column, "item", "place", "size", "before", "context", "item_before", "item_context")
        .mapInArrow(extend, f"{id_column} {kind}, item string, start long, stop long")
        .distinct()
    )
    pairs = spans.select(id_column, F.col("item").alias("same")).distinct().join(names, "same")
    return (
        found.where("place = -1").groupBy(id_column).agg(F.max("n_words").alias("n_words")),
        spans.select(id_column, "start", "stop").distinct(),
        pairs.select(id_column, "item").distinct(),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_prints: int = BROADCAST_PRINTS,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items (ids sorted as strings,
    comma-joined), contaminated."""
    all_words, spans, pairs = hits(docs, items, id_column, item_id, text, window, gram, broadcast_prints)
    listed = pairs.groupBy(F.col(id_column).alias("listed_id")).agg(
        F.count("*").alias("n_items"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.col("item").cast("string")))).alias("items"),
    )
    hit = _covered(spans, id_column).withColumnRenamed(id_column, "hit_id")
    hit = hit.join(listed, F.col("hit_id").eqNullSafe(F.col("listed_id")), "left")
    nothing = F.lit(0).cast("long")
    return all_words.join(hit, F.col(id_column).eqNullSafe(F.col("hit_id")), "left").select(
        id_column,
        "n_words",
        F.coalesce("n_hit", nothing).alias("n_hit"),
        F.coalesce("n_items", nothing).alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
        (F.coalesce("n_hit", nothing) > 0).alias("contaminated"),
    )
