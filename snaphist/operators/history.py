"""Append-only run history: stamp, append, and scope by run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import RUN_ID, TableContract, conform


def append_history(existing: DataFrame, batch: DataFrame, contract: TableContract) -> DataFrame:
    """The table after appending ``batch`` (contract-conformed). Re-running
    the same data adds one more run; nothing is deduplicated across runs."""
    return conform(existing, contract).unionByName(conform(batch, contract))


def rows_per_run(table: DataFrame) -> DataFrame:
    return table.groupBy(RUN_ID).agg(F.count(F.lit(1)).alias("n"))
