"""The schemas that stored Parquet files really have.

A read with the contract's schema forces it on every file: a column that a
file lacks is NULL, one it has too many is not seen. So the files' own footers
are compared with the contract first. Spark lists the files (no content is
read) and its tasks read the footers, so the check costs a few kilobytes a
file however large the table is.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

# Kinds of drift.
MISSING, EXTRA, RETYPED = "missing_column", "extra_column", "other_type"
SCHEMA = "file string, fault string, field string, found string, wanted string"
TIMES = ("timestamp", "timestamp_ntz")  # the footer of an INT96 time names no zone


def footer_faults(found: pa.Schema, wanted: dict[str, str]) -> list[tuple[str, str, str | None, str | None]]:
    """(fault, field, found, wanted) of one file; ``wanted``: type by column."""
    have = {f.name: from_arrow_type(f.type).simpleString() for f in found}
    same = lambda a, b: a == b or (a in TIMES and b in TIMES)
    return [*((MISSING, c, None, t) for c, t in wanted.items() if c not in have),
            *((EXTRA, c, t, None) for c, t in have.items() if c not in wanted),
            *((RETYPED, c, have[c], t) for c, t in wanted.items() if c in have and not same(have[c], t))]


def file_schema_faults(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """One row per file and column of the Parquet files below ``paths`` that is
    not as ``schema`` says. Partition columns stand in folder names, not in
    files, and are not part of ``schema``."""
    wanted = {f.name: f.dataType.simpleString() for f in schema.fields}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(paths).select("path")

    def read(batches):
        for b in batches:
            rows = []
            for path in b.column("path").to_pylist():
                fs, inner = pyarrow.fs.FileSystem.from_uri(path)
                rows += [(path, *x) for x in footer_faults(pq.read_schema(inner, filesystem=fs), wanted)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(5)], names=["file", "fault", "field", "found", "wanted"])

    return files.mapInArrow(read, SCHEMA)


def schema_report(faults: DataFrame, *by: str) -> DataFrame:
    """Files per fault and column (and per ``by``, e.g. their partition)."""
    return faults.groupBy(*by, "fault", "field", "found", "wanted").agg(F.countDistinct("file").alias("files"))
