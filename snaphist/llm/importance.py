"""Resampling towards a target distribution by hashed n-gram importance.

Words of a batch are found by Arrow kernels (``ascii_lower``,
``split_pattern_regex``, ``list_flatten``) and become indices into the batch's
own dictionary (``dictionary_encode``). Shifting the indices gives pairs of
neighbours, and those, encoded again, triples. Only distinct words, pairs and triples get a
checksum: the CRC of a joined string follows from those of its parts, so
nothing is concatenated. Gains are taken by index and summed per segment.

One scan counts the buckets of the documents, one those of the target; a
bucket's gain is the log ratio of its shares. A second scan weighs the
documents; Gumbel noise from a hash of the id makes the highest scores a
weighted draw without replacement.

Scale: narrow scans; a task sends at most one row per bucket, and the fixed
number of buckets is all that the driver sees. Ranks come from a range
partitioning of the scores (four numbers a document, rows that are equal in
all of them spread by a salt), the number of rows in each range, and positions
within it; no window gathers them.

Defined results: NULL text has no words, so weight 0, and is never drawn; a
NULL doc_id is hashed as empty text and ranks after others of equal score;
rows equal in score and id rank next to each other; an empty target or empty
table gives gains from the smoothing alone. Other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm.lineage import cut

BUCKETS = 10_000
SEED = 42
MIN_WORDS = 20
PERCENT = 5
CHUNK_BYTES = 1 << 20
RANGE_ROWS = 1 << 20
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing
POLYNOMIAL = 0xEDB88320  # of zlib's crc32


def _advance_tables() -> np.ndarray:
    """T[k][j][v]: what 2^k zero bytes make of a checksum's byte j of value v."""
    def apply(t, x):
        return t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]

    byte = np.arange(256, dtype=np.uint32)
    one = byte.copy()
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    step = lambda x: one[x & 255] ^ (x >> 8)
    tables = [np.stack([step(byte << np.uint32(8 * j)) for j in range(4)])]
    while len(tables) < 31:
        tables.append(np.stack([apply(tables[-1], apply(tables[-1], byte << np.uint32(8 * j))) for j in range(4)]))
    return np.stack(tables)


ADVANCE = _advance_tables()


def crc_joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC of each concatenation, from the CRCs of its parts and the right
    part's number of bytes."""
    x = left.copy()
    for k in range(int(size.max(initial=0)).bit_length()):
        at = np.flatnonzero(size >> k & 1)
        t, y = ADVANCE[k], x[at]
        x[at] = t[0][y & 255] ^ t[1][y >> 8 & 255] ^ t[2][y >> 16 & 255] ^ t[3][y >> 24]
    return x ^ right


@dataclass
class Features:
    """A batch's words, pairs and triples: ``at`` (positions of first words),
    ``index`` (of the distinct feature) and ``bucket`` (of each distinct one)."""
    first: np.ndarray  # each document's first word, and one more
    at: list[np.ndarray]
    index: list[np.ndarray]
    bucket: list[np.ndarray]


def _encode(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    e = pc.dictionary_encode(values)
    return e.indices.to_numpy(zero_copy_only=False), e.dictionary


def features(texts: pa.Array, buckets: int = BUCKETS) -> Features:
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATOR)
    flat, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.not_equal(pc.binary_length(flat), 0)
    flat, doc = flat.filter(some), doc.filter(some).to_numpy(zero_copy_only=False)
    word, dictionary = _encode(flat)
    first = np.searchsorted(doc, np.arange(len(texts) + 1), "left")
    raw = dictionary.cast(pa.binary()).to_pylist()
    alone = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
    after = np.fromiter((zlib.crc32(w, SPACE) for w in raw), np.uint32, len(raw))  # of " word"
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    at, index, bucket = [np.arange(word.size)], [word], [(alone % np.uint32(buckets)).astype(np.int64)]
    crc, before, n = alone, word, max(len(raw), 1)
    for k in (1, 2):
        here = np.flatnonzero(doc[:-k] == doc[k:]) if doc.size > k else np.empty(0, np.int64)
        # ``before``: the feature one word shorter that starts at each word
        pair, distinct = _encode(pa.array(before[here].astype(np.int64) * n + word[here + k]))
        distinct = distinct.to_numpy(zero_copy_only=False)
        crc = crc_joined(crc[distinct // n], after[distinct % n], size[distinct % n])
        before = np.zeros(word.size, np.int64)
        before[here] = pair
        at.append(here)
        index.append(pair)
        bucket.append((crc % np.uint32(buckets)).astype(np.int64))
    return Features(first, at, index, bucket)


SPACE = zlib.crc32(b" ")


def bucket_counts(f: Features, buckets: int = BUCKETS) -> np.ndarray:
    return sum(np.bincount(b[i], minlength=buckets) for i, b in zip(f.index, f.bucket))


def weights(f: Features, gain: np.ndarray) -> np.ndarray:
    """Sum of gains over each document's features."""
    per_word = np.zeros(f.at[0].size, np.int64)
    for at, index, bucket in zip(f.at, f.index, f.bucket):
        taken = pc.take(pa.array(gain[bucket]), pa.array(index)).to_numpy(zero_copy_only=False)
        per_word[at] += taken
    running = np.append(0, np.cumsum(per_word))
    return running[f.first[1:]] - running[f.first[:-1]]


def _chunks(column: pa.Array):
    """(offset, texts) of about CHUNK_BYTES each."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(column):
        done = int(upto[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, done + CHUNK_BYTES, "right")))
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def count_buckets(texts: DataFrame, buckets: int = BUCKETS, min_words: int = MIN_WORDS) -> tuple[np.ndarray, int]:
    """Features per bucket over all texts, and how many have ``min_words``."""
    def run(batches):
        n, enough = np.zeros(buckets, np.int64), 0
        for b in batches:
            for _, part in _chunks(b.column("text")):
                f = features(part, buckets)
                n += bucket_counts(f, buckets)
                enough += int((np.diff(f.first) >= min_words).sum())
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, at)), pa.array(np.append(enough, n[at]))], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    got = rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # a row per bucket
    n, enough = np.zeros(buckets, np.int64), 0
    for r in got:
        if r["bucket"] < 0:
            enough = r["n"]
        else:
            n[r["bucket"]] = r["n"]
    return n, enough


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of smoothed shares, rounded down."""
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + s.size) / ((s + 1) * (t.sum() + s.size)))).astype(np.int64)


def noise(seed: int) -> Column:
    """Gumbel noise of an id, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    held = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches):
        for b in batches:
            for lo, part in _chunks(b.column("text")):
                f = features(part, held.value.size)
                n = np.diff(f.first)
                cols = [n, sum(np.maximum(n - k, 0) for k in range(3)), weights(f, held.value)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, len(part)), *map(pa.array, cols)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, n_rows: int, order: list[Column]) -> DataFrame:
    """``rows`` (stored, narrow) with ``place`` 1, 2, 3, ... in ``order``: ranges
    of the order, positions within a range, and the sizes of those before it."""
    n = max(-(-n_rows // RANGE_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    order = [*order, F.col("salt")]
    by_range = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("salt")

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int64)), pa.array(np.arange(at + 1, at + b.num_rows + 1))],
                                             names=[*b.schema.names, "part", "at"])
            at += b.num_rows

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = cut(by_range.mapInArrow(number, f"{schema}, part long, at long"))
    before, sizes = 0, []
    for r in placed.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # a row per range
        sizes.append((r["part"], before))
        before += r["n"]
    offsets = rows.sparkSession.createDataFrame(sizes, "part long, before long")
    return placed.join(F.broadcast(offsets), "part").withColumn("place", F.col("before") + F.col("at")).drop("part", "at", "before")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; ``rank`` is
    NULL unless it is among the ``percent`` percent drawn of those that have
    ``min_words`` words. ``target``: rows with a ``text``."""
    source, enough = count_buckets(docs, buckets, min_words)
    aim, _ = count_buckets(target, buckets, min_words)
    scored = cut(weigh(docs, gains(source, aim)).withColumn("score", F.col("weight") + noise(seed)))
    drawn = percent * enough // 100
    out = ["doc_id", "n_features", "weight", "score"]
    able = scored.where(F.col("n_words") >= min_words).select(*out)
    placed = ranked(able, enough, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")])
    rest = scored.where(F.col("n_words") < min_words).select(*out, F.lit(None).cast("long").alias("rank"))
    return placed.select(*out, F.when(F.col("place") <= drawn, F.col("place")).alias("rank")).unionByName(rest)
