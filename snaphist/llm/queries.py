"""One query per operator, over its whole table; SQL where it can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.llm import class_model, decontaminate, html_extract, importance, language_id, lexical_search, mixing, ngram_join, oracles, quality_model, quality_rules, substring_dedup, suffix_dedup, warc
from snaphist.llm.ship import ship
from snaphist.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_class_model_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_model.score_texts(table(spark, sf_dir, "documents"), fold(5) != 1)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels.where(fold(5) != 0))
    return quality_model.score(docs, model, "doc_id").select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(3) != 1))
    return language_id.identify(docs, model).select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.payload_sizes(warc.read_archive(spark, path)) \
        .select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_ngram_jaccard_join, op3_mix_sources, op4_class_model_scoring, op5_suffix_array_dedup, op6_benchmark_decontamination, op7_quality_classifier,
                            op8_html_extraction, op9_quality_rules, op10_language_id, op11_warc, op12_lexical_search, op13_importance_resampling)
}
SQL: dict[str, str] = {"op1_substring_dedup": oracles.SUBSTRING_SQL, "op2_ngram_jaccard_join": oracles.JOIN_SQL, "op5_suffix_array_dedup": oracles.BYTES_SQL, "op9_quality_rules": oracles.RULES_SQL, "op3_mix_sources": mixing.MIX_SQL, "op11_warc": warc.ARCHIVE_SQL, "op12_lexical_search": lexical_search.SEARCH_SQL}
