"""Vector codes, licence templates and collocations against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter
from pathlib import Path

import messy
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from signalgrid.llm import collocations, licenses, vector_codes
from signalgrid.llm.queries import QUERIES, table


def _usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def _codes(rows, entries, rounds):
    """(id, label, code, error) by plain loops over whole numbers of any size, and the codebooks."""
    kept = [(i, label, [math.floor(max(min(1024 * x, 1 << 22), -(1 << 22))) for x in v]) for i, v, label in rows if _usable(v)]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0, row[2]))
    size = -(-max((len(v) for _, _, v in kept), default=0) // 4)
    kept = [(i, label, v + [0] * (4 * size - len(v))) for i, label, v in kept]
    cut = lambda v, part: v[part * size : (part + 1) * size]
    books = [[cut(v, part) for _, _, v in kept[:entries]] for part in range(4)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, part: min((gap(cut(v, part), e), i) for i, e in enumerate(books[part]))
    for _ in range(rounds):
        groups = {}
        for _, _, v in kept:
            for part in range(4):
                groups.setdefault((part, nearest(v, part)[1]), []).append(cut(v, part))
        for (part, entry), members in groups.items():
            books[part][entry] = [sum(xs) // len(members) for xs in zip(*members)]
    result = []
    for i, label, v in kept:
        found = [nearest(v, part) for part in range(4)]
        result.append((i, label, "".join(f"{at:02x}" for _, at in found), sum(far for far, _ in found)))
    return result, books


def _vectors():
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(10)] for _ in range(7)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in centres[0 if i % 3 == 0 else i % 7]], i % 4 or None) for i in range(400)]
    # Equal vectors and ties, a repeated and a null id, other lengths, zeros, huge and unusable ones.
    rows += [(401, rows[5][1], 1), (402, rows[5][1], 1), (402, rows[9][1], 1), (None, rows[9][1], 2), (403, [], 9)]
    rows += [(404, [0.0] * 10, 1), (405, [1e300] + [0.0] * 9, 1), (406, [-1e300, 0.5], 5), (407, rows[3][1] + [0.25], 1)]
    return rows + [(408, None, 1), (409, [1.0, None], 1), (410, [float("nan")], 1), (411, [float("-inf")] * 10, None)]


@pytest.mark.parametrize("entries, rounds", [(256, 4), (9, 3), (1, 1)])
def test_vector_codes_equal_brute_force(spark, entries, rounds):
    rows = _vectors()
    frame = spark.createDataFrame(rows, "id long, code array<double>, label int").repartition(6)
    whole = vector_codes.whole_numbers(frame, "id", "code", "label").cache()
    books = vector_codes.learn(whole, entries, rounds)
    found = vector_codes.encode(whole, books).collect()
    want, plain = _codes(rows, entries, rounds)
    assert books.tolist() == plain
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_vector_codes_of_a_table(spark):
    rows = [(i, v, label, "x") for i, v, label in _vectors()]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, error string")
    found, books = vector_codes.compress(frame)
    want, plain = _codes([row[:3] for row in rows], 256, 4)
    errors = Counter()
    for _, label, _, error in want:
        errors[label] += error
    expected = sorted(((i, code, error, errors[label]) for i, label, code, error in want), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert vector_codes.books_digest(books) == hashlib.sha256(",".join(str(x) for b in plain for e in b for x in e).encode()).hexdigest()
    near = vector_codes.decode(found.select("vec_id", "code"), books).where("vec_id = 7").first()
    assert near.near == [x for part in range(4) for x in plain[part][int(near.code[2 * part : 2 * part + 2], 16)]]
    empty, books = vector_codes.compress(frame.limit(0))
    assert empty.isEmpty() and vector_codes.books_text(books) == ""


def test_search_takes_the_lower_of_equal_entries_and_leaves_most_unmeasured():
    rng = np.random.default_rng(1)
    book = rng.integers(-5, 6, size=(256, 3))
    parts = rng.integers(-6, 7, size=(3000, 3))
    found, gap = vector_codes.Orchard(book).nearest(parts)
    plain = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert found.tolist() == plain.argmin(axis=1).tolist() and gap.tolist() == plain.min(axis=1).tolist()
    # Two far groups of entries: whoever starts in its own group never reads the other's.
    far = np.concatenate([rng.integers(0, 50, size=(128, 2)), rng.integers(0, 50, size=(128, 2)) + 10**6])
    finder = vector_codes.Orchard(far)
    parts = rng.integers(0, 50, size=(200, 2))
    finder._guess = lambda parts: np.zeros(len(parts), np.int64)
    finder.book = far.copy()
    finder.book[128:] = parts[0]
    assert (finder.nearest(parts)[0] < 128).all()


def _license_ends(items, words, at):
    """All ends of ways that a template matches from ``at``."""
    ends = {at}
    for item in items:
        if isinstance(item, str):
            ends = {e + 1 for e in ends if e < len(words) and words[e] == item}
        elif isinstance(item, tuple):
            ends = {e + n for e in ends for n in range(item[0], item[1] + 1) if e + n <= len(words)}
        else:
            ends = ends.union(*(_license_ends(item, words, e) for e in ends)) if ends else ends
    return ends


def _licenses(text, templates):
    words = messy.words_lower(text)
    places = []
    for at in range(len(words)):
        for label, markup in templates:
            if ends := _license_ends(licenses.parse(markup), words, at):
                places.append((label, at, max(ends)))
    inside = {i for _, a, b in places for i in range(a, b)}
    return len(words), len(inside), places


def _license_texts():
    rng = random.Random(8)
    mit = dict(licenses.MORE)["mit-text"]
    whole = mit.replace("[", "").replace("]", "")
    texts = [None, "", "...", "MIT", "mit, LICENSE!", "Licensed under the Apache License, Version 2.0.", "cc by cc by-nc-sa 4.0 cc-by"]
    texts += ["gnu general public license " * 4, "GNU General Public License, as published by the Free Software Foundation; either version 3"]
    texts += ["gnu general public license either version 2 as", "spdx-license-identifier: MIT OR Apache-2.0 und mehr", "spdx license identifier"]
    texts += [whole.upper(), re.sub(r"\[[^\[\]]*(\[[^\[\]]*\])?[^\[\]]*\]", "", mit), whole.replace("deal in", "trade in"), "x " + whole.replace(" ", "\n")]
    names = "neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
    texts += [names.format(x) for x in ("the copyright holder", "", "nor the names nor the names of", "a " * 12, "a " * 13, "é ü 漢字")]
    vocabulary = "gnu general public license mit cc by nc sa nd apache licensed under the version 2 0 neither name of nor names é".split()
    texts += [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(60)]
    return texts + ["mit license " * 2000, "permission is hereby " * 3000, " ".join(rng.choice(vocabulary) for _ in range(8000))]


def test_licenses_equal_brute_force(spark):
    texts = _license_texts()
    rows = [(i, text, "a", 1) for i, text in enumerate(texts)] + [(3, texts[3], None, None), (None, texts[4], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places string, n_words int").repartition(4)
    found = licenses.find_licenses(docs).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_covered, [tuple(p) for p in r.places]) for r in found), key=str)
    templates = [*licenses.BASE, *licenses.MORE]
    assert got == sorted(((row[0], *_licenses(row[1], templates)) for row in rows), key=str)
    assert {p[0] for row in got for p in row[3]} >= {"mit-text", "bsd-names", "gpl-3.0", "gpl-2.0", "spdx", "cc-sa", "apache-2.0"}
    assert licenses.find_licenses(messy.nothing(spark)).isEmpty()
    assert all(not row.places for row in licenses.find_licenses(messy.documents(spark), templates=[("a", "zzz")]).collect())


def test_random_templates_equal_brute_force(monkeypatch):
    monkeypatch.setattr(licenses, "PLACES", 17)
    rng = random.Random(4)

    def markup(depth):
        parts = [rng.choice("abc")]
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            parts.append(f"[{markup(depth + 1)}]" if kind < 0.25 and depth < 2 else f"{{{rng.randrange(2)},{rng.randrange(2, 4)}}}" if kind < 0.5 else rng.choice("abc"))
        return " ".join(parts)

    for _ in range(40):
        templates = [(f"t{i}", markup(0)) for i in range(4)]
        texts = ["".join(rng.choice("abcd ") + rng.choice("  .,") for _ in range(rng.randrange(60))) for _ in range(12)] + [None]
        counts, own, kind, first, stop = licenses.Matcher(licenses.compile_templates(templates)).places(pa.array(texts, pa.string()))
        cover = licenses.covered(counts, own, first, stop)
        for i, text in enumerate(texts):
            places = [(f"t{k}", a, b) for o, k, a, b in zip(own, kind, first, stop) if o == i]
            assert (counts[i], cover[i], places) == _licenses(text, templates)


@pytest.mark.parametrize("markup", ["[a", "a]", "", "{1,2}", "[a] {0,3}"])
def test_templates_need_closed_regions_and_wording(markup):
    with pytest.raises(ValueError):
        licenses.compile_templates([("x", markup)])


def test_licenses_query_digests_places(spark):
    rows = {row.doc_id: row for row in QUERIES["op12_licenses"](spark, "/root/testdata/sf0.001").collect()}
    for doc in table(spark, "/root/testdata/sf0.001", "documents").collect():
        words, inside, places = _licenses(doc.text, [*licenses.BASE, *licenses.MORE])
        base = [p for p in places if p[0] in dict(licenses.BASE)]
        starts = [p[1] for p in base]
        want = (words, len(base), min(starts, default=None), max(starts, default=None))
        labels = [",".join(sorted({p[0] for p in some})) for some in (base, places)]
        assert tuple(rows[doc.doc_id])[1:] == (*want, *labels, inside / words if words else 0.0)


def _phrases(rows, least, longest):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    result = []
    for (lang, phrase), a in counts.items():
        if len(phrase) < 2 or a < least:
            continue
        longer = [n for (other, p), n in counts.items() if other == lang and len(p) > len(phrase) and n >= least
                  and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))]
        if any(100 * n >= 80 * a for n in longer):
            continue
        cuts = [(2_000_000 * a // (counts[lang, phrase[:k]] + counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        result.append((lang, " ".join(phrase), a, counts[lang, phrase[:k]], counts[lang, phrase[k:]], sizes[lang], score))
    return sorted(result, key=lambda row: (row[0], -row[6], -row[2], row[1].encode()))


def _mined_rows():
    rng = random.Random(6)
    vocabulary = ["new", "york", "New", "city", "é", "漢字", "the", "of", "a-b", "x y", "İ"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\t", "\r", "\x0b"]) for _ in range(80)) for _ in range(40)]
    texts += ["new york city hall " * 30, "a a a a a a a a a", None, "", " \t", "...", "one", "the of. " * 300 + "x" * 5000]
    return [(rng.choice(["en", "de", None, "und", ""]), text) for text in texts] + [("fr", texts[40])] * 3


@pytest.mark.parametrize("run, least", [(8 << 20, 5), (200, 5), (200, 1)])
def test_collocations_equal_brute_force(spark, monkeypatch, run, least):
    monkeypatch.setattr(collocations, "RUN", run)
    rows = _mined_rows()
    docs = spark.createDataFrame([(*row, "n", 1) for row in rows], "lang string, text string, phrase string, run int").repartition(5)
    found = collocations.best(collocations.collocations(docs, least=least), 10**6).collect()
    got = [(r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in sorted(found, key=lambda r: (r.lang, r["rank"]))]
    want = _phrases(rows, least, 4)
    assert got == want and len(want) > 100
    ranks = Counter(row.lang for row in found)
    assert all(sorted(r["rank"] for r in found if r.lang == lang) == list(range(1, n + 1)) for lang, n in ranks.items())


@pytest.mark.parametrize("few", [0, 200_000])
def test_collocations_by_either_join_and_the_first_few(spark, monkeypatch, few):
    monkeypatch.setattr(collocations, "FEW_PHRASES", few)
    monkeypatch.setattr(collocations, "KNOWN_WORDS", few)
    rows = _mined_rows()
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = collocations.best(collocations.collocations(docs, least=4), 7).collect()
    want = {}
    for row in _phrases(rows, 4, 4):
        want.setdefault(row[0], []).append(row)
    got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found)
    assert got == sorted((lang, i + 1, *row[1:]) for lang, some in want.items() for i, row in enumerate(some[:7]))
    for empty in (docs.limit(0), docs.withColumn("text", F.lit(None).cast("string"))):
        assert collocations.best(collocations.collocations(empty)).isEmpty()


def test_scores_are_exact_beyond_64_bits(spark):
    # A count of 10**18 cannot be made from texts here; the scoring expression is that of the operator.
    a, l, r = 10**18, 3 * 10**18 + 1, 10**18 + 7  # noqa: E741
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(collocations.score_of("a", "l", "r")).first()
    assert row[0] == 2_000_000 * a // (l + r)
    covers = spark.createDataFrame([(8 * 10**17, a), (8 * 10**17 - 1, a)], "f long, a long").select(collocations.covers("f", "a", 80))
    assert [row[0] for row in covers.collect()] == [True, False]


def test_counting_holds_few_times_what_it_gathers(monkeypatch):
    monkeypatch.setattr(collocations, "GATHER", 1 << 18)
    rng, n = np.random.default_rng(1), 50_000
    words = [rng.integers(0, 1 << 20, n) for _ in range(24)]
    runs = (run for some in words for run in collocations._run(np.arange(n), np.zeros(n, np.int64), some))
    told, want = Counter(), Counter()
    tracemalloc.start()
    try:
        for batch in collocations._counts(runs):
            assert batch.num_rows <= collocations.TOLD
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 5 * 24 * collocations.GATHER + sum(x.nbytes for x in words)
    words = [some[:500] % 9 for some in words]
    for some in words:
        want.update((int(a) << 32) + int(b) for a, b in zip(some, some[1:]))
    runs = (run for some in words for run in collocations._run(np.arange(500), np.zeros(500, np.int64), some))
    for batch in collocations._counts(runs):
        told.update({low: count for high, low, count in zip(*batch.to_pydict().values())})
    assert told == want


def test_tasks_of_a_settled_frame_get_few_bytes_at_once(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["bytes"])

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    runs = spark.range(0, 24, 1, 1).selectExpr("repeat('x', 1000000) AS run").mapInArrow(sizes, "bytes long")
    got = [row.bytes for row in collocations.settle(runs)[0].collect()]
    assert sum(got) > 24_000_000 and max(got) < 6_000_000
    assert spark.conf.get(setting, None) == before


def test_runs_are_stored_and_read_few_at_once(spark, monkeypatch):
    groups, plain, drop = [], collocations._counts, collocations.drop_folder

    def counts(batches):
        assert int(TaskContext.get().getLocalProperty("spark.sql.parquet.columnarReaderBatchSize")) <= 8
        return plain(batches)

    def dropped(session, folder):
        for file in Path(folder.removeprefix("file:")).glob("*.parquet"):
            meta = pq.read_metadata(file)
            groups.append([meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)])
        drop(session, folder)

    monkeypatch.setattr(collocations, "RUN", 300_000)
    monkeypatch.setattr(collocations, "_counts", counts)
    monkeypatch.setattr(collocations, "drop_folder", dropped)
    word = "hex(pmod(xxhash64(id, x), 65536))"
    docs = spark.range(0, 40, 1, 1).selectExpr("'en' AS lang", f"array_join(transform(sequence(1, 60000), x -> {word}), ' ') AS text")
    found, sizes = collocations.phrase_counts(docs, longest=2)
    assert sizes.collect() == [("en", 2_400_000)]
    assert found.where("words = 1").agg({"f": "min"}).first()[0] >= collocations.LEAST
    # Of some 30 MB that a task writes, few are held at once.
    assert sum(map(sum, groups)) > 16_000_000 and max(map(max, groups)) < 8_000_000
    most = max(groups, key=sum)
    assert len(most) > 2
