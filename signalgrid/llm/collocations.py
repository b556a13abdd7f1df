"""Collocations by relational mining of word occurrences.

Texts are cut into pieces at punctuation and line ends, pieces into words. The relation of length
one holds every occurrence of every word, sorted by piece and place. Each length is made from the
one before: its occurrences are merge-joined with themselves on the same piece and the next place,
counted by group, and only those of groups that reach ``least`` go into the next length. A longer
phrase that often has only parts that often, so none is lost.

Relations are written as runs: a row holds the occurrences of one language in about ``RUN`` bytes of
text, as packed columns: gaps between places, one more where a piece ends, and phrases. No piece
spans two runs, so the merge-join needs no shuffle. Frequent words come back to the runs as numbers;
a phrase is the numbers of its words, so counting is exact without carrying strings.
Counts are summed up within each task before they are dealt out: a phrase that is in all texts
is a few rows a task. The semi-join with the frequent groups of two words and more goes by a bitmap
of their hashes, whose size is bounded: what it lets through by mistake is rare and falls at the
count of the next length, for a phrase never stands more often than its parts.

Texts that are null or empty have no words. A null language is ``und``. Repeated rows count as often
as they stand. Phrases are compared by their bytes; only A-Z are lowered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from signalgrid.llm.arrays import U64, mix, pieces, text_bytes, word_spans
from signalgrid.llm.work import drop_folder, settle as settle_frame

LONGEST = 4
LEAST = 30
COVER = 80
TOP = 2000
SCALE = 2_000_000
#: Bytes of text in a run.
RUN = 2 << 20
#: Frequent words up to this number (some 20 MB) are sent to every task that numbers words.
KNOWN_WORDS = 1 << 20
#: Frequent phrases up to this number are sent to every task; more are joined by a shuffle.
FEW_PHRASES = 200_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = np.zeros(256, bool)
_CUT[list(b".,;:!?\n\x0b\x0c\r")] = True
_INSIDE = ~_CUT
_INSIDE[list(b" \t")] = False

WORD_RUNS = "lang string, n int, gaps binary, codes binary, words array<binary>, counts array<long>"
RUNS = "n int, gaps binary, high binary, low binary"
#: Phrases are numbers of up to four words in two columns.
MOST_WORDS = 4
_WORD = np.int64((1 << 32) - 1)
#: Rows that a task gathers before it sums them up.
GATHER = 1 << 20
#: Rows of sums that a task hands on at once.
TOLD = 1 << 16
#: A task gets few runs at once: Spark would send up to 64 MB of them, held on both sides.
FEW_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
settle = partial(settle_frame, settings=FEW_BYTES)
#: What reads runs decodes few at once: Spark would decode 4,096 rows, which is all runs of a file.
settle_from_runs = partial(settle_frame, settings={**FEW_BYTES, "spark.sql.parquet.columnarReaderBatchSize": "8"})
#: A written run may fill a page: Parquet would look at its sizes after 100 rows only, and until
#: then hold all runs of a task, to compress them as one page a column.
RUN_FILES = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
#: Bits of the bitmap for each frequent phrase, and at most.
BITS_EACH, MOST_BITS = 16, 1 << 27
#: Bits in a row of Spark's bitmap functions.
PAGE = 32768


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the greatest needs; none where all are 0."""
    most = int(values.max(initial=0))
    kind = next(kind for kind in (np.uint8, np.uint16, np.uint32, np.int64) if most <= np.iinfo(kind).max)
    return values.astype(kind).tobytes() if most else b""


def _unpacked(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    n, data = batch.column("n")[row].as_py(), batch.column(column)[row].as_buffer()
    kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}
    return np.frombuffer(data, kinds[data.size // n]).astype(np.int64) if data.size else np.zeros(n, np.int64)


def _gaps(places: np.ndarray) -> bytes:
    """Places but for the first, which tells nothing."""
    return _packed(np.diff(places, prepend=places[:1]))


def _words(lang: str, texts: pa.Array) -> pa.RecordBatch | None:
    """The run of all word occurrences of some texts."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    starts, ends = word_spans(data, offsets, _INSIDE)
    if not len(starts):
        return None
    text = np.searchsorted(offsets, starts, side="right")
    cut = np.cumsum(_CUT[data], dtype=np.int32)[starts]
    begins = (np.diff(text) != 0) | (np.diff(cut) != 0)
    places = np.arange(len(starts))
    places[1:] += np.cumsum(begins)
    edges = np.concatenate([[0], np.cumsum(ends - starts)])
    letters = data[_INSIDE[data]]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(letters)]
    ).dictionary_encode()
    codes = words.indices.to_numpy()
    listed = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.record_batch(
        [
            pa.array([lang], pa.string()),
            pa.array([len(codes)], pa.int32()),
            pa.array([_gaps(places)], pa.binary()),
            pa.array([_packed(codes)], pa.binary()),
            listed(words.dictionary.cast(pa.binary())),
            listed(pa.array(np.bincount(codes), pa.int64())),
        ],
        ["lang", "n", "gaps", "codes", "words", "counts"],
    )


def _word_runs(docs: DataFrame, lang: str, text: str) -> DataFrame:
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("lang").unique().to_pylist():
                for piece in pieces(batch.filter(pc.equal(batch.column("lang"), name)), "text", RUN):
                    if (run := _words(name, piece.column("text"))) is not None:
                        yield run

    spoken = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    return docs.where(F.length(text) > 0).select(spoken, F.col(text).alias("text")).mapInArrow(make, WORD_RUNS)


def _run(places: np.ndarray, high: np.ndarray, low: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(places):
        packed = [pa.array([x], pa.binary()) for x in (_gaps(places), _packed(high), _packed(low))]
        yield pa.record_batch([pa.array([len(places)], pa.int32()), *packed], ["n", "gaps", "high", "low"])


def _frequent_runs(batches: Iterable[pa.RecordBatch], number: Callable[[pa.RecordBatch, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Word runs with only the words that have a number (from 0), under it."""
    for batch in batches:
        for row in range(batch.num_rows):
            places = np.cumsum(_unpacked(batch, "gaps", row))
            low = number(batch, row)[_unpacked(batch, "codes", row)]
            stays = low >= 0
            yield from _run(places[stays], np.zeros(int(stays.sum()), np.int64), low[stays])


def _listed_numbers(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """Number of each word of a run by the list ``kept`` that was joined to it."""
    kept = batch.column("kept")[row].values
    number = np.full(batch.column("size")[row].as_py(), -1)
    number[kept.field("code").to_numpy()] = kept.field("id").to_numpy()
    return number


def _numbered_runs(first: DataFrame, words: DataFrame, each: DataFrame) -> DataFrame:
    """The occurrences of frequent words. A vocabulary of up to ``KNOWN_WORDS`` words is sent to the
    tasks; the numbers of a larger one are joined to the words of each run and listed by run."""
    if words.count() <= KNOWN_WORDS:
        known = {}
        for row in words.select("lang", "phrase", "id").toArrow().group_by("lang").aggregate([("phrase", "list"), ("id", "list")]).to_pylist():
            known[row["lang"]] = (pa.array([w.encode() for w in row["phrase_list"]], pa.binary()), np.array(row["id_list"]))

        def number(batch: pa.RecordBatch, row: int) -> np.ndarray:
            spelt, ids = known.get(batch.column("lang")[row].as_py(), (pa.array([], pa.binary()), np.empty(0, np.int64)))
            return np.append(ids, -1)[pc.fill_null(pc.index_in(batch.column("words")[row].values.cast(pa.binary()), spelt), len(ids)).to_numpy()]

        return first.select("lang", "n", "gaps", "codes", "words").mapInArrow(lambda batches: _frequent_runs(batches, number), RUNS)
    kept = each.join(words.select("lang", "phrase", "id"), ["lang", "phrase"]).groupBy("run").agg(F.collect_list(F.struct("code", "id")).alias("kept"))
    joined = first.join(kept, "run").select("n", "gaps", "codes", F.size("words").alias("size"), "kept")
    return joined.mapInArrow(lambda batches: _frequent_runs(batches, _listed_numbers), RUNS)


def _longer(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a run's occurrences with those at the next place: places and phrases."""
    places = np.cumsum(_unpacked(batch, "gaps", row))
    high, low = _unpacked(batch, "high", row), _unpacked(batch, "low", row)
    meets = np.flatnonzero(np.diff(places) == 1)
    first = low[meets]
    return places[meets], high[meets] << 32 | first >> 32, (first & _WORD) << 32 | low[meets + 1] & _WORD


def _summed(rows: list[np.ndarray]) -> list[np.ndarray]:
    """``rows`` (high, low, n) with one row a phrase; the list is emptied on the way, so that no
    column is held twice."""
    order = np.lexsort((rows[1], rows[0])) if rows[0].any() else np.argsort(rows[1])
    for i in range(3):
        rows[i] = rows[i][order]
    del order
    low, high = rows[1], rows[0]
    first = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
    del low, high
    n = np.add.reduceat(rows.pop(), first)
    low = rows.pop()[first]
    return [rows.pop()[first], low, n]


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(high, low, n) of the phrases one word longer than those of the runs of a task."""
    gathered: list[list[np.ndarray]] = []

    def summed() -> list[np.ndarray]:
        rows = [np.concatenate([x.pop(0) for x in gathered]) for _ in range(3)]
        gathered.clear()
        return _summed(rows)

    def told(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(rows[0]), TOLD):
            yield pa.record_batch([pa.array(x[start : start + TOLD]) for x in rows], ["high", "low", "n"])

    for batch in batches:
        for row in range(batch.num_rows):
            _, high, low = _longer(batch, row)
            if len(low):
                gathered.append(_summed([high, low, np.ones(len(low), np.int64)]))
            if sum(len(x[0]) for x in gathered) > GATHER:
                gathered.append(summed())
                if len(gathered[0][0]) > GATHER // 2:
                    yield from told(gathered.pop())
    if gathered:
        yield from told(summed())


def _spots(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    return (mix(low.astype(U64) ^ mix(high.astype(U64))) & U64(bits - 1)).astype(np.int64)


def _bitmap(frequent: DataFrame, count: int) -> np.ndarray:
    """Bits that are set where the hash of a frequent phrase points, at most ``MOST_BITS``."""
    bits = PAGE
    while bits < min(count * BITS_EACH, MOST_BITS):
        bits *= 2

    def pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = _spots(*(batch.column(name).to_numpy() for name in ("high", "low")), bits)
            for page in np.unique(spot // PAGE).tolist():
                own = np.zeros(PAGE, bool)
                own[spot[spot // PAGE == page] % PAGE] = True
                yield pa.record_batch([pa.array([page], pa.int64()), pa.array([np.packbits(own).tobytes()], pa.binary())], ["page", "part"])

    parts = frequent.select("high", "low").mapInArrow(pages, "page long, part binary")
    result = np.zeros(bits // 8, np.uint8)
    for page, part in parts.groupBy("page").agg(F.bitmap_or_agg("part")).collect():
        result[page * PAGE // 8 : (page + 1) * PAGE // 8] = np.frombuffer(part, np.uint8)
    return result


def _next_runs(runs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Occurrences of the phrases one word longer than those of ``runs`` that the bitmap lets pass."""
    bits = len(bitmap) * 8

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                places, high, low = _longer(batch, row)
                spot = _spots(high, low, bits)
                stays = (bitmap[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8) & 1).astype(bool)
                yield from _run(places[stays], high[stays], low[stays])

    return runs.mapInArrow(make, RUNS)


def _with_numbers(words: DataFrame) -> DataFrame:
    """``words`` with ``id``, whole numbers from 0; the driver learns the rows of each partition."""
    listed, _ = settle_from_runs(
        words.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id() % (1 << 33))
    )
    sizes = dict(listed.groupBy("part").count().collect())
    begin = np.cumsum([0, *(sizes.get(part, 0) for part in range(max(sizes, default=0) + 1))]).tolist()
    if begin[-1] > _WORD >> 1:
        raise ValueError("more frequent words than numbers")
    offsets = F.array(*(F.lit(x).cast("long") for x in begin[:-1]))
    return listed.withColumn("id", F.get(offsets, F.col("part")) + F.col("at")).drop("part", "at")


def _spelt(frequent: DataFrame, words: DataFrame, size: int, few: bool) -> DataFrame:
    """(lang, phrase, words, f) of frequent phrases, which are numbers of words."""
    held = lambda column, shift: F.shiftright(column, shift).bitwiseAND(int(_WORD))
    ids = [held("high", 32), held("high", 0), held("low", 32), held("low", 0)][MOST_WORDS - size :]
    each = frequent.select("high", "low", "f", F.posexplode(F.array(*ids)).alias("at", "id"))
    lookup = words.select("id", "lang", "phrase")
    spelt = each.join(F.broadcast(lookup) if few else lookup, "id")
    return (
        spelt.groupBy("high", "low", "f")
        .agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "phrase"))).alias("spelt"))
        .select("lang", F.array_join(F.col("spelt")["phrase"], " ").alias("phrase"), F.lit(size).alias("words"), "f")
    )


def phrase_counts(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases up to ``longest`` (four at most) words that stand
    ``least`` times, and (lang, n) of all languages with words."""
    if not 1 <= longest <= MOST_WORDS:
        raise ValueError(f"phrases have 1 to {MOST_WORDS} words")
    # Numbered as written: read again, a run has the number it had.
    first, folder = settle(_word_runs(docs, lang, text).withColumn("run", F.monotonically_increasing_id()), options=RUN_FILES)
    sizes = first.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    sizes, _ = settle_from_runs(sizes.groupBy("lang").agg(F.sum("n").alias("n")))
    each = first.select("run", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "of")).select(
        "run", "code", "lang", F.col("of.words").cast("string").alias("phrase"), F.col("of.counts").alias("f")
    )
    words, _ = settle(_with_numbers(each.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)))
    few = words.count() <= FEW_PHRASES
    runs, newer = settle_from_runs(_numbered_runs(first, words, each), options=RUN_FILES)
    drop_folder(docs.sparkSession, folder)
    folder = newer
    result = words.select("lang", "phrase", F.lit(1).alias("words"), "f")
    for size in range(2, longest + 1):
        # Dealt out as they come: each task has summed up its own, which Spark would try once more.
        counts = runs.mapInArrow(_counts, "high long, low long, n long").repartition("high", "low")
        frequent, _ = settle_from_runs(counts.groupBy("high", "low").agg(F.sum("n").alias("f")).where(F.col("f") >= least))
        result = result.unionByName(_spelt(frequent, words, size, few))
        if size < longest:
            runs, newer = settle_from_runs(_next_runs(runs, _bitmap(frequent, frequent.count())), options=RUN_FILES)
        # All that was made of the runs before is written.
        drop_folder(docs.sparkSession, folder)
        folder = newer
    return result, sizes


def score_of(a: str, left: str, right: str) -> Column:
    """``SCALE * a / (left + right)``, floored; decimals, as products may pass 64 bits."""
    wide = "decimal(20,0)"
    return F.expr(f"CAST({SCALE} AS decimal(10,0)) * CAST({a} AS {wide}) div (CAST({left} AS {wide}) + CAST({right} AS {wide}))")


def covers(longer: str, own: str, share: int) -> Column:
    """Whether a longer phrase's count is at least ``share`` hundredths of a phrase's own."""
    wide = lambda name, by: F.col(name).cast("decimal(20,0)") * F.lit(by).cast("decimal(10,0)")
    return wide(longer, 100) >= wide(own, share)


def _part(first: int, stop: int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, stop - first + 1), " ")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    longest: int = LONGEST,
    cover: int = COVER,
) -> DataFrame:
    """All candidates that no longer candidate covers: (lang, phrase, words, a, l, r, n, score)."""
    counted, sizes = phrase_counts(docs, lang, text, least, longest)
    counted, _ = settle(counted)
    few = counted.count() <= FEW_PHRASES
    held = lambda frame: F.broadcast(frame) if few else frame
    candidates = counted.where("words > 1").withColumnRenamed("f", "a")
    # Every cut of every candidate, then the least one.
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    words = F.split("phrase", " ")
    cut = cut.withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn(
        "rest", F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ")
    )
    of = lambda side, count: held(
        counted.where(F.col("words") < longest).select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
    )
    cut = cut.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    scored = (
        cut.groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct(score_of("a", "l", "r").alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    )
    # The most frequent longer candidate around each phrase.
    spans = [(size, begin) for size in range(2, longest) for begin in range(1, longest + 2 - size)]
    around = (
        candidates.where("words > 2")
        .select(
            "lang",
            F.col("a").alias("f"),
            F.explode(
                F.array(
                    *(
                        F.when((F.col("words") > size) & (F.col("words") >= begin + size - 1), _part(begin, begin + size - 1))
                        for size, begin in spans
                    )
                )
            ).alias("phrase"),
        )
        .where("phrase is not null")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("f"))
    )
    left = scored.join(around, ["lang", "phrase"], "left").where(~F.coalesce(covers("f", "a", cover), F.lit(False)))
    return left.join(F.broadcast(sizes) if sizes.count() <= FEW_PHRASES else sizes, "lang").select(
        "lang", "phrase", "words", "a", "l", "r", "n", "score"
    )


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language by score, count and phrase, with their ``rank``.

    Phrases are ranked in groups by a hash first, as many as keep both steps alike in size, so no
    task gets all of a language.
    """
    found, _ = settle(found)
    groups = max(1, int((found.count() / max(top, 1)) ** 0.5))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(groups))
    near = Window.partitionBy("lang", "slot").orderBy(*order)
    far = Window.partitionBy("lang").orderBy(*order)
    return (
        found.withColumn("slot", group)
        .withColumn("rank", F.row_number().over(near))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(far).cast("long"))
        .where(F.col("rank") <= top)
        .drop("slot")
    )
