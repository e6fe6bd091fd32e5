"""Ranked search of items in documents, straight from the text.

All distinct terms of the items stand in one Aho-Corasick automaton, each with
a guard before and after it; a text is lower-cased (A-Z), every byte between
terms becomes the guard, and one walk over it names each occurrence of each
term. Neighbours share their guard, so matches are whole terms only. No index
of the documents is made: a first walk counts document frequencies, a second
one scores, its outputs mapped to the items that hold the term.

Scale: two narrow scans of the documents. A task keeps the ``top`` best
documents of each item, so what is shuffled is bounded by tasks x items x top
rows; they are reduced in two levels. The automaton is broadcast; it holds at most
``SHARD_BYTES`` of item text. More items are dealt to several shards, each
scanned for by itself (frequencies and scores of an item need only its own
terms).

Defined results: NULL text has no term; an item without a term, or whose terms
no document holds, has no row; equal scores rank by ascending doc_id (NULL
last), rows equal in both are ranked next to each other; repeated rows are
ranked each; items with equal id are one item with the terms of all of them;
an item without id or text is none; an empty table on either side gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaphist.llm.lineage import cut
from snaphist.llm.tokens import LOWER_AZ, Texts

TOP = 20
SHARD_BYTES = 4 << 20
CHUNK_BYTES = 1 << 19
CELLS = 1 << 21  # scores held at a time: documents x items
SALT = 64
GUARD = 0x20
NONE = np.iinfo(np.int64).max  # stands for a NULL id

IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True
#: lower-cased, and a guard between terms
GUARDED = np.where(IS_TERM, LOWER_AZ, GUARD).astype(np.uint8)


def guarded(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The texts as guarded bytes with one more guard before each and at the
    end, and where each text starts."""
    n = len(t)
    out = np.full(t.buf.size + n + 1, GUARD, np.uint8)
    at = np.arange(t.buf.size) + np.repeat(np.arange(1, n + 1), np.diff(t.off))
    out[at] = GUARDED[t.buf]
    return out, t.off + np.arange(n + 1)


def term_counts(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Terms of each text, with repeats: places where a guard ends."""
    begins = np.flatnonzero((buf[:-1] == GUARD) & (buf[1:] != GUARD))
    return np.diff(np.searchsorted(begins, start, "left"))


def item_terms(text: str) -> Counter:
    """Terms of an item, as bytes in the form of ``as_text``."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return Counter(as_text(GUARDED[raw]).split())


def as_text(raw: np.ndarray) -> str:
    """One character a byte, so that positions of matches are byte positions."""
    return raw.tobytes().decode("latin-1")


@dataclass
class Shard:
    """Items whose terms fit into one automaton."""
    items: np.ndarray  # ids
    terms: list[str]
    of_term: np.ndarray  # CSR of (term -> item, times): offsets
    item: np.ndarray
    times: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        """Terms between guards; an output is the term's number."""
        a = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, term in enumerate(self.terms):
            a.add_word(f" {term} ", k)
        a.make_automaton()
        return a


def shard_of(held: dict[int, Counter]) -> Shard:
    by: dict[str, list[tuple[int, int]]] = {}
    for k, terms in enumerate(held.values()):
        for term, times in terms.items():
            by.setdefault(term, []).append((k, times))
    each = [x for v in by.values() for x in v]
    return Shard(np.array(list(held)), list(by), np.cumsum([0, *map(len, by.values())]), np.array([k for k, _ in each]), np.array([n for _, n in each], np.int64))


def shards(items: DataFrame, size: int) -> Iterator[Shard]:
    """Shards of at most ``size`` bytes of terms (or one larger item), by
    ascending item; the items stream through the driver, a shard at a time."""
    held: dict[int, Counter] = {}
    n = 0
    for r in items.orderBy("item_id").toLocalIterator():
        terms = item_terms(r["text"])
        more = sum(len(x) + 2 for x in terms)
        if held and n + more > size and r["item_id"] not in held:
            yield shard_of(held)
            held, n = {}, 0
        if terms:
            held[r["item_id"]] = held.get(r["item_id"], Counter()) + terms
            n += more
    if held:
        yield shard_of(held)


def occurrences(a: ahocorasick.Automaton, t: Texts, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, tf) of every term that occurs, and each text's number of
    terms. One walk over the chunk."""
    buf, start = guarded(t)
    hits = np.fromiter(chain.from_iterable(a.iter(as_text(buf))), np.int64)
    doc = np.searchsorted(start, hits[::2], "left") - 1  # a match ends at a guard after its text's first byte
    key, tf = np.unique(doc * n_terms + hits[1::2], return_counts=True)
    return key // n_terms, key % n_terms, tf.astype(np.int64), term_counts(buf, start)


def _scan(docs: DataFrame, work, schema: str) -> DataFrame:
    """``work(doc ids, texts)`` over chunks of whole texts, then ``work(None, None)``."""
    def run(batches):
        each = work()
        for b in batches:
            ids = b.column("doc_id").fill_null(NONE).to_numpy(zero_copy_only=False)
            t = Texts.of(b.column("text"))
            for lo, hi in t.parts(CHUNK_BYTES):
                each.add(ids[lo:hi], t.part(lo, hi))
        yield each.result()

    return docs.mapInArrow(run, schema)


class _Frequencies:
    def __init__(self, a, n_terms):
        self.a, self.n, self.df, self.docs, self.size = a, n_terms, np.zeros(n_terms, np.int64), 0, 0

    def add(self, ids, t):
        _, term, _, size = occurrences(self.a, t, self.n)
        self.df += np.bincount(term, minlength=self.n)
        self.docs += int((size > 0).sum())
        self.size += int(size.sum())

    def result(self):
        at = np.flatnonzero(self.df)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], at])), pa.array(np.concatenate([[self.docs, self.size], self.df[at]]))], names=["term", "n"])


class _Scores:
    """The best documents of each item so far."""
    def __init__(self, a, shard: Shard, weight, n_docs, n_words, top):
        self.a, self.s, self.w, self.n, self.l, self.top = a, shard, weight, n_docs, n_words, top
        self.best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))  # item, score, id

    def add(self, ids, t):
        step = max(1, CELLS // max(self.s.items.size, 1))
        for lo in range(0, len(t), step):
            self.some(ids[lo:lo + step], t.part(lo, min(lo + step, len(t))))

    def some(self, ids, t):
        s = self.s
        doc, term, tf, size = occurrences(self.a, t, len(s.terms))
        if not doc.size:
            return
        m = 75 + (25 * size * self.n) // self.l
        part = self.w[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        many = np.diff(s.of_term)[term]  # items that hold the term
        at = np.repeat(s.of_term[term] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        n_items = s.items.size
        score = np.zeros(len(t) * n_items, np.int64)
        np.add.at(score, np.repeat(doc, many) * n_items + s.item[at], np.repeat(part, many) * s.times[at])
        score = score.reshape(len(t), n_items)
        least = np.ones(n_items, np.int64)  # what still can enter
        item, got, _ = self.best
        if item.size:
            last = np.flatnonzero(np.append(item[1:] != item[:-1], True))
            full = np.bincount(item, minlength=n_items)[item[last]] == self.top
            least[item[last[full]]] = np.maximum(got[last[full]], 1)
        d, i = np.nonzero(score >= least)
        if not d.size:
            return
        item, got, who = (np.concatenate([a, b]) for a, b in zip(self.best, (i, score[d, i], ids[d])))
        order = np.lexsort((who, -got, item))
        item, got, who = item[order], got[order], who[order]
        begin = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        keep = np.arange(item.size) - np.repeat(begin, np.diff(np.append(begin, item.size))) < self.top
        self.best = item[keep], got[keep], who[keep]

    def result(self):
        item, got, who = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.s.items[item]), pa.array(who, mask=who == NONE), pa.array(got)], names=["item_id", "doc_id", "score"])


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` documents of each of
    ``items`` (item_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    parts = []
    for shard in shards(asked, shard_bytes):
        automaton = spark.sparkContext.broadcast(shard.automaton())
        n_terms = len(shard.terms)
        counted = _scan(rows, lambda a=automaton, n=n_terms: _Frequencies(a.value, n), "term long, n long")
        got = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # at most the shard's terms
        n_docs, n_words = got.get(-2, 0), got.get(-1, 0)
        if not n_words:
            continue
        df = np.array([got.get(k, 0) for k in range(n_terms)], np.int64)
        weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
        held = spark.sparkContext.broadcast((shard, weight))
        parts.append(_scan(rows, lambda a=automaton, h=held, n=n_docs, m=n_words: _Scores(a.value, *h.value, n, m, top), "item_id long, doc_id long, score long"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= top)
    found = cut(found.select("item_id", "doc_id", "score"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


#: The same over plain SQL (tables documents, benchmark).
SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM sizes),
tfs AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY doc_id, term),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term), total),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l))))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), total
  GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
