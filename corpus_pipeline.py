"""A training corpus from raw documents, in five stages.

Quality classifier, near duplicates, repeated passages, benchmark leaks, and
the mix of sources. Each stage takes all rows its predecessor kept; all but
the last return the columns of ``documents``. Rows with NULLs, empty texts and
repeated rows go through as the operators define (the near-duplicate stage
keeps one of rows equal in id and text); an empty table stays empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.llm import decontaminate, mixing, ngram_join, quality_model, substring_dedup
from snaphist.llm.lineage import broadcast_if_small, cut
from snaphist.llm.queries import fold, table
from snaphist.llm.ship import ship
from snaphist.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE, PERCENT = 5, 80  # near duplicates of the corpus; op2 has its own


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score is under the classifier's threshold."""
    docs = docs.select(*COLUMNS)
    model = quality_model.fit(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    return quality_model.score(docs, model, *COLUMNS).where(F.col("score") >= quality_model.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near duplicates, and one row
    of those that are equal in id and text (the least of its other columns)."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    kept = ngram_join.near_duplicates(docs, percent=PERCENT, shingle=SHINGLE).where("stays").select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"))
    first = cut(kept.groupBy("k_id", "k_th").agg((F.count("*") > 1).alias("again")))
    same = (F.xxhash64("text") == F.col("k_th")) & F.col("doc_id").eqNullSafe(F.col("k_id"))
    rows = docs.join(broadcast_if_small(first), same).select(*COLUMNS, "again")
    # only the texts that occur again are shuffled
    one = rows.where("again").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("x")).select("doc_id", "text", "x.*")
    return rows.where("NOT again").select(*COLUMNS).unionByName(one)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages that an earlier document has; a document that loses
    all its words goes."""
    ship(spark)
    left = substring_dedup.dedup_substrings(docs.select(*COLUMNS), keep=("lang", "source", "n_chars"), keep_space=True)
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.where("n_removed = 0 OR n_removed < n_words").select("doc_id", "text", "lang", "source", size.alias("n_chars"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.drop_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    ship(spark)
    return mixing.mix_sources(docs.select(*COLUMNS), keep=("text", "lang", "n_chars"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("mix_sources", source_mix),
]

#: SQL can't train the classifier; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written to the shared folder and read
    again, so a lost executor costs one stage at most."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
