"""Documents dealt into bounded blocks, and questions asked across blocks.

An operator that needs to know something about each of a document's many
n-grams (how often one occurs anywhere, in which document first) would shuffle
one row per n-gram. Here a block first reduces its own n-grams to distinct
ones, so a key that a third of all documents hold costs each block one entry;
it packs them per bucket, the bucket reads one packed row from each block, and
the answers go back to the blocks that asked, in the order of the question.
Blocks and buckets grow in number with the input, never in size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20


def block_count(docs: DataFrame, column: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of about ``block_bytes`` of text, and at least two per core, so
    a small table is spread as well. Reads one column once."""
    total = docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0
    return int(max(-(-total // block_bytes), 2 * docs.sparkSession.sparkContext.defaultParallelism))


def with_block(docs: DataFrame, n: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, ``keep`` and block; the text takes part in the choice of the block,
    so rows without an id don't all meet in one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(c) for c in keep]) \
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))


def sorted_block(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The block's rows in a fixed order, and their ids (NULL: the largest)."""
    table = table.combine_chunks().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return table, ids_of(table["doc_id"])


def ids_of(column) -> np.ndarray:
    return column.combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def by_bucket(keys: np.ndarray, n_buckets: int):
    """(bucket, positions of the sorted distinct ``keys`` that belong to it);
    a bucket is a hash of the key, its positions are ascending."""
    b = ((keys >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(b[order]) != 0)) if keys.size else np.empty(0, np.int64)
    for lo, hi in zip(cuts, np.append(cuts[1:], keys.size)):
        yield int(b[order[lo]]), order[lo:hi]


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal values, and the run number of each position."""
    if not sorted_values.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.append(True, sorted_values[1:] != sorted_values[:-1])
    return np.flatnonzero(new), np.cumsum(new) - 1
