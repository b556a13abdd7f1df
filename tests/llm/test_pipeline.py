"""The pipeline's stages on odd rows and on the test tables, and the registered queries' SQL."""

from __future__ import annotations

import random

import duckdb
import messy
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from signalgrid.llm import decontaminate, langid, lines, simhash
from signalgrid.llm.oracle import STATEMENTS
from signalgrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_bear_odd_rows_and_no_rows(spark):
    for docs in (messy.documents(spark), messy.nothing(spark)):
        for name, stage in pipeline.STAGES[:-1]:
            docs_after = stage(spark, docs, SF)
            assert docs_after.columns == docs.columns, name
            docs = spark.createDataFrame(docs_after.collect(), docs.schema)
        last = pipeline.STAGES[-1][1](spark, docs, SF)
        assert {"ids", "n_pieces"} <= set(last.columns) and last.count() == docs.count()


def test_columns_with_the_names_of_helpers_keep_their_values(spark):
    docs = pipeline.table(spark, SF, "documents").limit(120)
    names = ["score", "lang_pred", "nameless", "lines_removed", "bad_id", "id", "row", "order", "held_out"]
    wide = docs.select("*", *(F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in names))
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, wide, SF)
        assert after.columns == wide.columns, name
        wide = spark.createDataFrame(after.collect(), wide.schema)
        for column in names:
            assert wide.where(F.col(column) != F.concat(F.lit(f"{column} "), "doc_id")).isEmpty(), (name, column)
    assert wide.count() > 50


def test_rows_of_one_id_leave_the_same_one_however_dealt(spark):
    rows = [(i % 5, f"text number {i} " * 30, "en", "s", i) for i in range(40)] + [(None, "a", "en", "s", i) for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = [sorted(pipeline.drop_near_duplicates(spark, docs.repartition(n), SF).collect(), key=str) for n in (1, 7)]
    assert left[0] == left[1] and len({row.doc_id for row in left[0]}) == len(left[0])


def test_many_foreign_texts_are_rejected_and_clean_ones_kept(spark):
    rng = random.Random(9)
    docs = pipeline.table(spark, "/root/testdata/sf0.01", "documents")
    noise = ["".join(rng.choice("бвгджзклмнпрстфхцчшщаеиоуыэюя") for _ in range(5)) for _ in range(400)]
    marks = [" ".join(rng.choices(noise, k=80)) for _ in range(30)]
    rows = [(10**6 + 4 * i, text, None, "s", len(text)) for i, text in enumerate(marks)]
    left = pipeline.identify_language(spark, docs.union(spark.createDataFrame(rows, docs.schema)), SF)
    kept = {row.doc_id for row in left.select("doc_id").collect()}
    texts = [row.doc_id for row in docs.where("length(text) > 200 and text rlike '[a-z]'").collect()]
    assert len(kept & set(texts)) >= 0.998 * len(texts)
    # A network that knows only its own labels is not sure enough of a third of them at least.
    assert sum(row[0] in kept for row in rows) <= 20


def test_rejection_bound_follows_labels_and_scores(spark):
    scores = spark.createDataFrame([(0.7 + i / 10000,) for i in range(2000)] + [(0.1,), (0.0,)], "score double")
    assert langid.least_score(scores, 4) == pytest.approx(0.25 + 0.5 * 0.45)
    assert langid.least_score(scores, 2) == pytest.approx(0.5 + 0.5 * 0.2)
    assert langid.least_score(scores, 1) == 1.0 and langid.least_score(scores.limit(0), 4) == 0.25


def test_near_duplicates_leave_one_of_each_group(spark):
    left = pipeline.drop_near_duplicates(spark, messy.documents(spark), SF)
    ids = [row.doc_id for row in left.collect()]
    assert ids.count(9) == 1 and 16 in ids and 17 not in ids and 18 not in ids
    assert ids.count(None) == 2


def test_pipeline_equals_its_parts(spark):
    docs = pipeline.table(spark, SF, "documents")
    ids = lambda frame: sorted(row.doc_id for row in frame.select("doc_id").collect())
    first = pipeline.identify_language(spark, docs, SF)
    spread = lines.drop_boilerplate(first).drop("lines_removed")
    groups = simhash.near_duplicates(spread)
    one = spread.join(groups.where("doc_id = component_id").select("doc_id"), "doc_id")
    bad = decontaminate.decontaminate(one, pipeline.table(spark, SF, "benchmark")).where("contaminated")
    want = sorted(set(ids(one)) - set(ids(bad)))
    found = pipeline.run(spark, SF)
    assert ids(found) == want and 0 < len(want) < docs.count()
    assert found.where("n_pieces = 0").isEmpty()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_queries_equal_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    peer = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        peer.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = peer.execute(f"SELECT {', '.join(columns)} FROM ({STATEMENTS[name]})").fetchall()
    assert sorted(map(tuple, frame.select(*columns).collect()), key=str) == sorted(want, key=str)
