"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from signalgrid.llm import (
    collocations,
    decontaminate,
    html_text,
    langid,
    licenses,
    lines,
    secrets,
    sentencepiece,
    simhash,
    substrings,
    urls,
    vector_codes,
    vectors,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = sentencepiece.read_vocabulary()
    encoded = sentencepiece.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), words)
    spelt = [int(i) for i in words.byte_ids if i >= 0]
    return sentencepiece.decode(encoded, words).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.size(F.filter("ids", lambda i: i.between(min(spelt, default=-1), max(spelt, default=-1)))).cast("long").alias("n_bytes"),
        F.hex(F.xxhash64("ids")).alias("ids_hash"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    kinds = [rule.kind for rule in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *(
            F.size(F.filter(F.col("spans")["kind"], F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}")
            for kind in kinds
        ),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        "lines_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id"))
    network = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "text", "held_out"), network).drop("text")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(vector_codes.books_digest(books)))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["label"].isin([label for label, _ in licenses.BASE]))
    listed = lambda places: F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")
    return found.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base")["start"]).alias("first_word"),
        F.array_max(F.col("base")["start"]).alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.col("places")).alias("labels"),
        F.coalesce(F.try_divide("n_covered", "n_words"), F.lit(0.0)).alias("score"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.best(collocations.collocations(table(spark, sf_dir, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_secrets": op3_secrets,
    "op4_urls": op4_urls,
    "op5_vectors": op5_vectors,
    "op6_substrings": op6_substrings,
    "op7_simhash": op7_simhash,
    "op8_html_text": op8_html_text,
    "op9_lines": op9_lines,
    "op10_langid": op10_langid,
    "op11_vector_codes": op11_vector_codes,
    "op12_licenses": op12_licenses,
    "op13_collocations": op13_collocations,
}
