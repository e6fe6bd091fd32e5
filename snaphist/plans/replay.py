"""Rebuild SCD2 history from the landing zone without re-reading the source.

The runs are those the store committed, in their committed order: a run that
a gate or audit rejected has landed as well, but made no history. Their landed
documents are read in one scan; each document's run comes from its file path
(``<landing>/<run_id>/entities/<table>/...``). The staged rows then go through
``scd2_replay`` (one window pass). Sampled runs keep the objects they kept
when they were ingested, and say nothing about others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import VALID_FROM, TableContract
from ..operators.flatten import objects_to_rows
from ..operators.scd2 import RUN_COLUMNS, run_ends, scd2_replay
from ..sources.landing import DOC, envelope_results
from ..sources.store import Run, Store

CHAIN = T.StructType([T.StructField("run_seq", T.LongType()), T.StructField("run_id", T.StringType()), T.StructField(VALID_FROM, T.TimestampType()),
                      T.StructField("sampled", T.BooleanType())])


def run_list(spark: SparkSession, runs: list[Run]) -> DataFrame:
    """run_seq 1..N, run_id, clock, and whether it kept a sample only."""
    return spark.createDataFrame([(i, r.run_id, r.ingested_at, r.sample_limit is not None) for i, r in enumerate(runs, 1)], CHAIN)


def landed_entity_rows(spark: SparkSession, landing: str, table: str, contract: TableContract, runs: list[Run], *, source_system: str) -> DataFrame:
    """Staged rows of ``runs`` of ``table``, each stamped with its run, with
    the columns of its run (``RUN_COLUMNS``)."""
    listed = run_list(spark, runs)
    run_of_file = F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]+)/entities/{table}/[^/]+$", 1)

    def docs(some: list[Run]) -> DataFrame:
        pages = spark.read.text([f"{landing.rstrip('/')}/{r.run_id}/entities/{table}" for r in some])
        return envelope_results(pages.select("value", run_of_file.alias("run_id")), keep=("run_id",))

    ends = run_ends(listed, docs(runs), on="run_id")

    def rows(some: list[Run]) -> DataFrame:
        return objects_to_rows(docs(some).join(ends, "run_id"), contract, run_id=F.col("run_id"), ingested_at=F.col(VALID_FROM),
                               source_system=source_system, doc_col=DOC, keep=RUN_COLUMNS)

    parts = [rows(some) for some in ([r for r in runs if r.sample_limit is None],) if some]
    for limit in sorted({r.sample_limit for r in runs if r.sample_limit is not None}):
        kept = F.row_number().over(Window.partitionBy("run_seq").orderBy(*[F.col(k).asc_nulls_last() for k in contract.business_keys]))
        sampled = rows([r for r in runs if r.sample_limit == limit])
        parts.append(sampled.withColumn("__k", kept).where(F.col("__k") <= limit).drop("__k"))
    return reduce(DataFrame.unionByName, parts)


def rebuild_history(store: Store, landing: str, table: str, *, source_system: str) -> DataFrame:
    """The SCD2 history that the store holds for ``table``, computed from the
    landed extracts of its committed runs in one pass."""
    spark, contract, runs = store.spark, store.contracts[table], store.runs(table)
    if not runs:
        return spark.createDataFrame([], contract.schema)
    return scd2_replay(landed_entity_rows(spark, landing, table, contract, runs, source_system=source_system), run_list(spark, runs), contract)
