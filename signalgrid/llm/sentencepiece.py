"""Text to pieces and back: unigram Viterbi over a double-array trie.

The vocabulary file is a parameter and only read. Of a unigram file the stored log scores are
used; a file of merge ranks has none, so its pieces get the log of a Zipf share of their rank. The
best segmentation of a text is the one whose pieces' scores sum to the most; of equals the one
with the longest last piece. A character without a piece becomes the pieces of its bytes.

White space is marked: each space is a marker, and one more stands before a text. If no piece has
a marker after another character (checked when the file is read), each run of markers with the
characters up to the next is segmented by itself, once for each distinct run.

Null and empty texts have no pieces, and no pieces decode to an empty text. A text that holds the
marker itself comes back with a space in its place. Ids outside the vocabulary and control pieces
decode to nothing.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from signalgrid.llm.arrays import pieces, spread, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fields and codes of the vocabulary file, its marker, and the penalty of unknowns.
MARKER = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM = 1
UNKNOWN_PENALTY = 10.0

#: Distinct runs a task remembers before it starts anew.
REMEMBERED = 400_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of one protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 2: None, 5: 4}[tag & 7]
        size = number() if size is None else size
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Vocabulary:
    """Pieces by id, and a double-array trie: the child of node ``s`` on byte ``c`` is
    ``t = base[s] + c`` if ``check[t] == s``; ``leaf[t]`` is the id that ends there or -1."""

    texts: list[bytes]
    scores: np.ndarray
    base: np.ndarray
    check: np.ndarray
    leaf: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    unknown_score: float
    splits: bool
    prefix: bool


def _trie(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place the nodes of sorted keys; each node's children go to the first gap they fit in."""
    size = 256 + 4 * sum(len(key) for key, _ in keys)
    base, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    check = np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0] = 1
    lowest = 1
    stack = [(0, 0, 0, len(keys))]
    while stack:
        node, depth, low, high = stack.pop()
        if low < high and len(keys[low][0]) == depth:
            leaf[node] = keys[low][1]
            low += 1
        children = []
        while low < high:
            byte, begin = keys[low][0][depth], low
            while low < high and keys[low][0][depth] == byte:
                low += 1
            children.append((byte, begin, low))
        if not children:
            continue
        while taken[lowest]:
            lowest += 1
        first = children[0][0]
        place = max(lowest - first, 1)
        while any(taken[place + byte] for byte, _, _ in children):
            place = taken.find(0, place + first + 1) - first
        base[node] = place
        for byte, begin, end in children:
            taken[place + byte] = 1
            check[place + byte] = node
            stack.append((place + byte, depth + 1, begin, end))
    last = taken.rfind(1) + 257
    return base[:last], check[:last], leaf[:last]


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    with open(path, "rb") as file:
        message = list(_fields(file.read()))
    kind, prefix, rows = UNIGRAM, True, []
    for number, value in message:
        if number == 1:
            own = dict(_fields(value))
            rows.append((own[1], struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0], own.get(3, NORMAL)))
        elif number == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            prefix = bool(dict(_fields(value)).get(3, 1))
    scores = np.array([score for _, score, _ in rows])
    normal = np.array([type_ in (NORMAL, USER) for _, _, type_ in rows])
    if kind != UNIGRAM:
        rank = np.zeros(len(rows))
        rank[np.flatnonzero(normal)[np.argsort(-scores[normal], kind="stable")]] = np.arange(normal.sum())
        scores = -np.log(rank + 2.7) - np.log(np.log(normal.sum() + 2.7))
    keys = sorted((text, i) for i, (text, _, type_) in enumerate(rows) if type_ in (NORMAL, USER))
    base, check, leaf = _trie(keys)
    byte_ids = np.full(256, -1)
    texts = []
    marker = MARKER.encode()
    for i, (text, _, type_) in enumerate(rows):
        if type_ == BYTE:
            byte_ids[int(text[3:5], 16)] = i
            texts.append(bytes([int(text[3:5], 16)]))
        else:
            texts.append(text.replace(marker, b" ") if type_ in (NORMAL, USER) else b"")
    unknown = next((i for i, row in enumerate(rows) if row[2] == UNKNOWN), 0)
    splits = not any(marker in text.lstrip(b" ").replace(b" ", marker) for text in texts)
    lowest = float(scores[normal].min()) if normal.any() else 0.0
    return Vocabulary(
        texts, scores, base, check, leaf, byte_ids, unknown, lowest - UNKNOWN_PENALTY, splits, prefix
    )


class Encoder:
    """Segments texts; remembers the segmentation of runs it has met."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.known: dict[bytes, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known.clear()
        self.ids = [np.empty(0, np.int32)]
        self.counts = [np.empty(0, np.int64)]

    def _edges(self, data: np.ndarray, owner: np.ndarray, stops: np.ndarray):
        """(start, end, id) of every piece that stands in the data; id -1 for a character that
        is no piece."""
        words = self.words
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        ends_at = stops[owner[starts]]
        follow = np.minimum(np.append(starts[1:], len(data)), ends_at)
        whole = np.zeros(len(starts), bool)
        which, node, at = np.arange(len(starts)), np.zeros(len(starts), np.int64), starts
        begin, end, ids = [], [], []
        while len(which):
            inside = at < ends_at[which]
            which, node, at = which[inside], node[inside], at[inside]
            step = words.base[node] + data[at]
            good = words.check[step] == node
            which, node, at = which[good], step[good].astype(np.int64), at[good] + 1
            piece = words.leaf[node]
            hit = piece >= 0
            begin.append(starts[which[hit]])
            end.append(at[hit])
            ids.append(piece[hit])
            whole[which[hit & (at == follow[which])]] = True
        begin.append(starts[~whole])
        end.append(follow[~whole])
        ids.append(np.full(int((~whole).sum()), -1))
        return np.concatenate(begin), np.concatenate(end), np.concatenate(ids)

    def _segment(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs, number of ids of each)."""
        words = self.words
        data = np.frombuffer(b"".join(runs), np.uint8)
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        stops = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(runs)), sizes)
        begin, end, ids = self._edges(data, owner, stops)
        own = owner[begin]
        score = np.where(ids >= 0, words.scores[ids], words.unknown_score)
        # Each run has one node more than bytes: where it may be cut.
        source, target = begin + own, end + own
        depth = end - (stops - sizes)[own]
        order = np.lexsort((begin, target, depth))
        source, target, ids, score, depth = (x[order] for x in (source, target, ids, score, depth))
        best = np.full(len(data) + len(runs), -np.inf)
        best[stops - sizes + np.arange(len(runs))] = 0
        came = np.zeros(len(best), np.int64)
        bounds = np.flatnonzero(np.diff(depth, prepend=-1))
        for low, high in zip(bounds.tolist(), [*bounds[1:].tolist(), len(depth)]):
            total = best[source[low:high]] + score[low:high]
            at = target[low:high]
            heads = np.flatnonzero(np.diff(at, prepend=-1))
            top = np.maximum.reduceat(total, heads)
            group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, high - low)))
            winners = np.flatnonzero(total == top[group])
            # Of equals the earliest start: its winner is written last.
            winners = winners[::-1]
            best[at[heads]] = top
            came[at[winners]] = winners + low
        node = stops + np.arange(len(runs))
        first = stops - sizes + np.arange(len(runs))
        active = np.arange(len(runs))[sizes > 0]
        rows, steps, found, spans = [], [], [], []
        step = 0
        while len(active):
            edge = came[node[active]]
            rows.append(active)
            steps.append(np.full(len(active), step))
            found.append(ids[edge])
            spans.append(np.column_stack([source[edge], target[edge]]) - active[:, None])
            node[active] = source[edge]
            active = active[node[active] > first[active]]
            step += 1
        if not rows:
            return np.empty(0, np.int32), np.zeros(len(runs), np.int64)
        row, back, piece, span = (np.concatenate(x) for x in (rows, steps, found, spans))
        order = np.lexsort((-back, row))
        row, piece, span = row[order], piece[order], span[order]
        # A character without a piece is spelt in bytes.
        lone = piece < 0
        width = np.where(lone, span[:, 1] - span[:, 0], 1)
        which, place = spread(width)
        spelt = words.byte_ids[data[np.minimum(span[which, 0] + place, len(data) - 1)]]
        flat = np.where(lone[which], np.where(spelt >= 0, spelt, words.unknown), piece[which])
        return flat.astype(np.int32), np.bincount(row, width, minlength=len(runs)).astype(np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if len(self.known) > REMEMBERED:
            self._clear()
        cut = re.compile(rb" +[^ ]*|[^ ]+" if self.words.splits else rb"(?s).+").findall
        front, space, marker = b" " if self.words.prefix else b"", b" ", MARKER.encode()
        runs: list[bytes] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                own = cut(front + text.replace(marker, space))
                counts[i] = len(own)
                runs += own
        fresh = [run for run in dict.fromkeys(runs) if run not in self.known]
        if fresh:
            for run in fresh:
                self.known[run] = len(self.known)
            ids, sizes = self._segment([run.replace(space, marker) for run in fresh])
            self.ids = [np.concatenate([*self.ids, ids])]
            self.counts = [np.concatenate([*self.counts, sizes])]
        lengths = self.counts[0]
        firsts = np.cumsum(lengths) - lengths
        index = np.fromiter((self.known[run] for run in runs), np.int64, len(runs))
        which, place = spread(lengths[index])
        flat = self.ids[0][firsts[index][which] + place]
        totals = np.append(0, np.cumsum(lengths[index]))
        edges = np.append(0, np.cumsum(counts))
        return flat, totals[edges[1:]] - totals[edges[:-1]]


class Decoder:
    def __init__(self, words: Vocabulary):
        self.size, self.prefix = len(words.texts), words.prefix
        self.widths = np.array([*map(len, words.texts), 0])
        self.firsts = np.cumsum(self.widths) - self.widths
        self.data = np.frombuffer(b"".join(words.texts), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        ids = np.where((ids >= 0) & (ids < self.size), ids, self.size)
        widths = self.widths[ids]
        which, place = spread(widths)
        raw = self.data[self.firsts[ids][which] + place].tobytes()
        totals = np.append(0, np.cumsum(widths))
        edges = totals[np.append(0, np.cumsum(counts))].tolist()
        texts = (raw[a:b] for a, b in zip(edges, edges[1:]))
        return [
            (text[1:] if self.prefix and text[:1] == b" " else text).decode("utf-8", "replace") for text in texts
        ]


def encode(docs: DataFrame, words: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids`` added (or replaced): the ids of each text's pieces."""
    docs = docs.drop(ids)
    shape = StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType(), False))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(words)
        for batch in batches:
            for piece in pieces(batch, text, 1 << 20):
                data, offsets = text_bytes(piece.column(text))
                raw, edges = data.tobytes(), offsets.tolist()
                flat, counts = encoder.encode([raw[a:b] for a, b in zip(edges, edges[1:])])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(flat, pa.int32())
                )
                yield pa.record_batch([*piece.columns, lists], [*piece.schema.names, ids])

    return docs.mapInArrow(run, shape)


def decode(docs: DataFrame, words: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the column ``text`` added (or replaced): the text of each row's ids. Null
    ids, and null lists, count as none."""
    docs = docs.drop(text)
    shape = StructType([*docs.schema.fields, StructField(text, StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(words)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                column = part.column(ids)
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                texts = pa.array(decoder.decode(flat, counts), pa.string())
                yield pa.record_batch([*part.columns, texts], [*part.schema.names, text])

    return docs.mapInArrow(run, shape)
