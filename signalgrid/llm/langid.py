"""Language identification with a small convolutional network over bytes.

The network embeds the bytes of a fixed-length window, applies filters of several widths, takes
each filter's greatest answer over the window and ends in a softmax. It is trained in numpy on a
bounded sample of labelled texts (``SAMPLE_TEXTS`` of each label, ``SAMPLE_CHARS`` characters of
each); predictions read every byte of every text, in windows of ``WINDOW`` bytes whose
probabilities are averaged by length. Training is deterministic for given rows.

A text that is null or has no letter is ``und`` with score 0, and so is any text if there is no
label to learn. Equal scores go to the first label in order. Columns of the input that have the
names of the answers are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from signalgrid.llm.arrays import pieces, spread, text_bytes

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 10
EMBEDDING = 8
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 800
EPOCHS = 6
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass
class Network:
    """Weights; ``filters[w]`` is (width * embedding, filters), rows ordered by place."""

    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Answer of each filter place to each byte: a convolution becomes a sum of lookups."""
        size = self.embedding.shape[1]
        return [
            [(self.embedding @ w[j * size : (j + 1) * size]).astype(np.float32) for j in range(len(w) // size)]
            for w in self.filters
        ]

    def probabilities(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        features = []
        index = windows.astype(np.intp)
        for places, bias in zip(tables, self.bias):
            span = index.shape[1] - len(places) + 1
            total = places[0][index[:, :span]]
            for j in range(1, len(places)):
                total += places[j][index[:, j : j + span]]
            features.append(np.maximum(total.max(axis=1) + bias, 0))
        return _softmax(np.concatenate(features, axis=1) @ self.out + self.out_bias)


def _softmax(logits: np.ndarray) -> np.ndarray:
    values = np.exp(logits - logits.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of each window, text of each window, bytes of text in it); short ends are blank."""
    lengths = np.diff(offsets)
    row, place = spread(-(-lengths // WINDOW))
    starts = offsets[:-1][row] + place * WINDOW
    filled = np.minimum(offsets[1:][row] - starts, WINDOW)
    steps = np.arange(WINDOW)
    inside = steps < filled[:, None]
    padded = np.append(_LOWER[data], np.uint8(32))
    return padded[np.where(inside, starts[:, None] + steps, len(data))], row, filled


def train(windows: np.ndarray, target: np.ndarray, labels: list[str], seed: int = 7) -> Network:
    """Fit by Adam on the cross entropy of shuffled batches."""
    rng = np.random.default_rng(seed)
    count = len(labels)
    weights = [rng.normal(0, 0.3, (256, EMBEDDING))]
    weights += [rng.normal(0, (width * EMBEDDING) ** -0.5, (width * EMBEDDING, FILTERS)) for width in WIDTHS]
    weights += [np.zeros(FILTERS) for _ in WIDTHS]
    weights += [rng.normal(0, 0.2, (FILTERS * len(WIDTHS), count)), np.zeros(count)]
    weights = [w.astype(np.float32) for w in weights]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step, batch, n = 0, 64, len(WIDTHS)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), batch):
            chosen = order[begin : begin + batch]
            x, size = windows[chosen].astype(np.intp), len(chosen)
            embedding, out = weights[0], weights[2 * n + 1]
            embedded = embedding[x]
            columns, best, pooled = [], [], []
            for k, width in enumerate(WIDTHS):
                span = WINDOW - width + 1
                column = np.concatenate([embedded[:, j : j + span] for j in range(width)], axis=2)
                answer = column @ weights[1 + k] + weights[1 + n + k]
                best.append(answer.argmax(axis=1))
                pooled.append(np.maximum(answer.max(axis=1), 0))
                columns.append(column)
            features = np.concatenate(pooled, axis=1)
            wrong = _softmax(features @ out + weights[2 * n + 2])
            wrong[np.arange(size), target[chosen]] -= 1
            wrong /= size
            grads = [np.zeros_like(w) for w in weights]
            grads[2 * n + 1] = features.T @ wrong
            grads[2 * n + 2] = wrong.sum(axis=0)
            back = (wrong @ out.T) * (features > 0)
            for k, width in enumerate(WIDTHS):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                # Only the place of each filter's greatest answer learns.
                at = columns[k][np.arange(size)[:, None], best[k]]
                grads[1 + k] = np.einsum("bfi,bf->if", at, own)
                grads[1 + n + k] = own.sum(axis=0)
                down = own[:, :, None] * weights[1 + k].T[None]
                for j in range(width):
                    hit = x[np.arange(size)[:, None], best[k] + j]
                    np.add.at(grads[0], hit, down[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
            step += 1
            rate = 0.01 * (1 - epoch / (EPOCHS + 1))
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                even, spreadness = first[i] / (1 - 0.9**step), second[i] / (1 - 0.999**step)
                weights[i] = weights[i] - (rate * even / (np.sqrt(spreadness) + 1e-8)).astype(np.float32)
    return Network(labels, weights[0], weights[1 : 1 + n], weights[1 + n : 1 + 2 * n], weights[-2], weights[-1])


def held_out(id_column: str | Column) -> Column:
    """Whether a row is never learned from; a row without an id never is."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame, text: str = "text", label: str = "lang") -> Network | None:
    """Learn from the rows of ``docs`` that have a label; None if there are none.

    Which texts of a label are taken is decided by a hash of the text, and where the piece
    starts in a longer text as well. Rows of one label and text are one.
    """
    own = F.col(label).cast("string").alias("own_label")
    labelled = docs.where(F.col(label).isNotNull() & (F.length(text) > 0))
    hashed = labelled.select(own, F.xxhash64(text).alias("by"), F.col(text).alias("own_text"))
    # One row per label, as many as the network has answers; copies of a text are one.
    counts = hashed.select("own_label", "by").distinct().groupBy("own_label").count()
    begin = F.lit(1) + F.pmod("by", F.greatest(F.lit(1), F.length("own_text") - SAMPLE_CHARS)).cast("int")
    order = Window.partitionBy("own_label").orderBy("by", "piece")
    rows = (
        hashed.join(F.broadcast(counts), "own_label")
        # About four times as many as wanted, before they meet in one task per label.
        .where(F.pmod("by", F.lit(1 << 30)) <= F.lit(4.0 * SAMPLE_TEXTS * (1 << 30)) / F.col("count"))
        .select("own_label", "by", F.substring("own_text", begin, F.lit(SAMPLE_CHARS)).alias("piece"))
        .groupBy("own_label", "by")
        .agg(F.min("piece").alias("piece"))
        .withColumn("number", F.row_number().over(order))
        .where(F.col("number") <= SAMPLE_TEXTS)
        .orderBy("own_label", "number")
        .toArrow()
    )
    labels = sorted(set(rows.column("own_label").to_pylist()))
    if not labels:
        return None
    names = np.array([labels.index(name) for name in rows.column("own_label").to_pylist()])
    windows, row, _ = windows_of(*text_bytes(rows.column("piece").combine_chunks()))
    return train(windows, names[row], labels)


def _answers(column: pa.Array, network: Network | None, tables: list) -> tuple[list[str], np.ndarray]:
    data, offsets = text_bytes(column)
    names = [UNKNOWN] * len(column)
    scores = np.zeros(len(column))
    if network is None or not len(data):
        return names, scores
    letters = np.append(0, np.cumsum(_LETTER[data]))
    lettered = letters[offsets[1:]] > letters[offsets[:-1]]
    for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
        lettered[i] = any(map(str.isalpha, column[int(i)].as_py()))
    sums = np.zeros((len(column), len(network.labels)))
    windows, row, filled = windows_of(data, offsets)
    for begin in range(0, len(windows), 2048):
        part = slice(begin, begin + 2048)
        odds = network.probabilities(windows[part], tables) * filled[part, None]
        rows, firsts = np.unique(row[part], return_index=True)
        sums[rows] += np.add.reduceat(odds, firsts, axis=0)
    best = sums.argmax(axis=1)
    for i in np.flatnonzero(lettered):
        names[i] = network.labels[best[i]]
        scores[i] = min(1.0, sums[i, best[i]] / (offsets[i + 1] - offsets[i]))
    return names, scores


def predict(
    docs: DataFrame, network: Network | None, text: str = "text", answer: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the predicted label and its mean probability added."""
    docs = docs.drop(answer, score)
    shape = StructType([*docs.schema.fields, StructField(answer, StringType()), StructField(score, DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network else []
        for batch in batches:
            for piece in pieces(batch, text, 1 << 20):
                names, scores = _answers(piece.column(text), network, tables)
                yield pa.record_batch(
                    [*piece.columns, pa.array(names, pa.string()), pa.array(scores)],
                    [*piece.schema.names, answer, score],
                )

    return docs.mapInArrow(run, shape)


#: A score counts in steps of one in so many.
STEPS = 1000


def least_score(answered: DataFrame, labels: int, below: float = 0.001, part: float = 0.5, score: str = "score") -> float:
    """Score under which a text is in no language that was learned: ``part`` of the way from chance
    (one in ``labels``) to the score that a share ``below`` of ``answered`` stays under.

    ``answered`` are predictions for labelled texts that were not learned from. Without any, or with
    one label, it is chance itself, and nothing is under it. Found from counts of scores in
    ``STEPS``, so it does not depend on how rows are dealt out.
    """
    chance = 1 / max(labels, 1)
    step = F.floor(F.col(score) * STEPS).alias("step")
    counts = dict(answered.where(F.col(score) > 0).groupBy(step).count().collect())
    if not counts or labels < 2:
        return chance
    seen, total = 0, sum(counts.values())
    for step in sorted(counts):
        seen += counts[step]
        if seen > below * total:
            break
    return chance + part * max(0.0, step / STEPS - chance)
