"""From raw documents to token ids, in five stages that each work on all the one before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``;
the last adds ``ids`` (piece ids) and ``n_pieces``. A stage's result is written as Parquet and
read again as the next one's input, so a lost executor costs at most part of one stage.

Null texts: language identification rejects them with all texts without a letter, and texts whose
score lies under a bound found from labelled documents that were not learned from. Rows that share
an id are one document: the near-duplicate stage keeps the one whose text has the least hash. Rows
without an id are never taken for each other's copies unless their texts are equal. Columns beyond
those of ``documents`` go through all stages as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalgrid.llm import decontaminate, langid, lines, sentencepiece, simhash
from signalgrid.llm.queries import table
from signalgrid.llm.work import settle


def _fresh(docs: DataFrame, name: str) -> str:
    """A name like ``name`` that no column has."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a known language."""
    held_out = langid.held_out("doc_id")
    network = langid.fit(docs.where(~held_out))
    answer, score = _fresh(docs, "lang_pred"), _fresh(docs, "score")
    labels = len(network.labels) if network else 0
    labelled = docs.where(held_out & F.col("lang").isNotNull()).select("text")
    least = langid.least_score(langid.predict(labelled, network), labels)
    known = langid.predict(docs, network, answer=answer, score=score)
    return known.where((F.col(answer) != langid.UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that spread over many sites out of the texts; every document stays."""
    removed = _fresh(docs, "lines_removed")
    left = lines.drop_boilerplate(docs, removed=removed)
    changed = F.col(removed) > 0
    return left.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, the one with the least id."""
    groups = simhash.near_duplicates(docs)
    copies = groups.where("component_id <> doc_id").select("doc_id").distinct()
    # Rows that repeat an id are one document; rows without an id are told apart by their text.
    plain = [field.name for field in docs.schema.fields if field.dataType.typeName() not in ("map", "variant")]
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("nameless"),
        F.struct(F.xxhash64("text"), F.xxhash64(*plain)).alias("order"),
        F.struct("*").alias("row"),
    )
    left = rows.join(copies.withColumnRenamed("doc_id", "id"), "id", "left_anti")
    return left.groupBy("id", "nameless").agg(F.min_by("row", "order").alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad_id = _fresh(docs, "bad_id")
    bad = found.where("contaminated").select(F.col("doc_id").alias(bad_id))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(bad_id)), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text's pieces and their number."""
    encoded = sentencepiece.encode(docs, sentencepiece.read_vocabulary())
    return encoded.withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [
    ("language identification", identify_language),
    ("line dedup", drop_boilerplate),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: SQL expresses neither the network nor the segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs, _ = settle(stage(spark, docs, sf_dir))
    return docs
