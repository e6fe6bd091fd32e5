"""Quality rules with adaptive thresholds.

Counts of a text (words, symbols, repeated lines, words in repeated 5-word
windows) become four integer rates. Per language and source a quantile sketch
of each rate is kept: a histogram over a fixed integer range, so sketches of
any size merge exactly by adding counts, in any order, and reruns agree. Every
document is in its group's sketch, also those that the base rule rejects. The
limits of a group are its quartiles widened by their distance. They are drawn
towards those of its language, and these towards those of all, as if ``PRIOR``
documents of the wider group belonged to the narrower one: one rule for groups
of every size, and limits that move little with each document. The limits are
then joined back and decide.

Scale: one pass makes the counts; a group's sketch has at most ``BINS`` rows
per rate however many documents it has (map-side combined); the join's right
side has one row per (language, source).

Defined results: NULL or empty text has no words and fails the base rule; NULL
language or source is a group of its own; repeated rows are judged alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaphist.llm.lineage import cut
from snaphist.llm.tokens import BYTE_CODE, Texts, fits, grams, mix, prefix_hash, span_hash, words

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
WINDOW = 5
BINS = 2001
PRIOR = 50  # documents that a wider group counts for in a narrower one's quartiles
#: rate -> (slack that is always allowed, whether low values are judged too)
RATES = {"symbol_rate": (60, False), "repeat_rate": (200, False), "dup_line_rate": (60, False), "word_length": (20, True)}
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per(first: np.ndarray, running: np.ndarray) -> np.ndarray:
    return running[first[1:]] - running[first[:-1]]


def _running(x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.size + 1, np.int64)
    np.cumsum(x, out=out[1:])
    return out


def _repeated(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether a hash occurs more than once in its document."""
    key = mix(h ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    k = key[order]
    same = np.append(False, k[1:] == k[:-1])
    same[:-1] |= same[1:]
    out = np.empty(key.size, bool)
    out[order] = same
    return out


def _dup_lines(t: Texts, w) -> np.ndarray:
    n = len(t)
    breaks = np.flatnonzero(t.buf == 10)
    start = np.concatenate([t.off[:-1], breaks + 1])
    end_of = np.sort(np.concatenate([t.off[1:], breaks]))
    doc = np.concatenate([np.arange(n), np.searchsorted(t.off, breaks, "right") - 1])
    order = np.lexsort((start, doc))
    start, doc, end = start[order], doc[order], end_of
    has = np.searchsorted(w.start, end, "left") > np.searchsorted(w.start, start, "left")
    start, end, doc = start[has], end[has], doc[has]
    p, inv = prefix_hash(BYTE_CODE[t.buf])
    h = mix(span_hash(p, inv, start, end) ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    first = np.unique(h, return_index=True)[1]
    return np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)


def count_texts(t: Texts) -> list[np.ndarray]:
    """The five counts of each text."""
    w = words(t)
    chars = _running((t.buf & 0xC0) != 0x80)
    out = [np.diff(w.first), _per(w.first, _running(chars[w.end] - chars[w.start])), _per(t.off, _running(SYMBOL[t.buf])), _dup_lines(t, w)]
    at, cover = fits(w.first, WINDOW), np.zeros(w.hash.size + 1, np.int64)
    if at.size:
        hit = at[_repeated(w.doc()[at], grams(w.hash, WINDOW)[at])]
        cover[hit] += 1
        np.add.at(cover, hit + WINDOW, -1)
    out.append(_per(w.first, _running(np.cumsum(cover[:-1]) > 0)))
    return out


def text_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the five counts of every whole text."""
    rows = docs.select(*[F.col(c).alias(c) for c in keep], F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])

    def count(batches):
        for b in batches:
            t = Texts.of(b.column("text"))
            for lo, hi in t.parts(1 << 20):
                got = count_texts(t.part(lo, hi))
                cols = [b.column(c).slice(lo, hi - lo) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array(x.astype(np.int64)) for x in got]], names=[*keep, *[c.split()[0] for c in COUNTS.split(", ")]])

    return rows.mapInArrow(count, ", ".join(x for x in (schema, COUNTS) if x))


def rates(counts: DataFrame) -> DataFrame:
    """Integer rates within 0..BINS-1: per thousand, and tenths of a character."""
    per = lambda a, b, k: F.least(F.floor(k * F.col(a) / F.greatest(F.col(b), F.lit(1))), F.lit(BINS - 1)).cast("int")
    return counts.withColumns({"symbol_rate": per("n_symbols", "word_chars", 1000), "repeat_rate": per("n_repeat_words", "n_words", 1000),
                               "dup_line_rate": per("n_dup_lines", "n_words", 1000), "word_length": per("word_chars", "n_words", 10)})


def sketches(rated: DataFrame) -> DataFrame:
    """(lang, source, rate, bin, n): the mergeable sketch of every group."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("bin")) for r in RATES])).alias("x")
    return rated.select("lang", "source", each).groupBy("lang", "source", "x.rate", "x.bin").agg(F.count("*").alias("n"))


def merge(sk: DataFrame, *group: str) -> DataFrame:
    return sk.groupBy(*group, "rate", "bin").agg(F.sum("n").alias("n"))


def quartiles(sk: DataFrame, *group: str) -> DataFrame:
    """group, rate, docs, q1, q3: the smallest bins that reach a quarter and
    three quarters of a group's documents."""
    w = Window.partitionBy(*group, "rate")
    at = sk.withColumn("docs", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("bin")))
    first = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("docs") * q, F.col("bin")))
    return at.groupBy(*group, "rate").agg(F.max("docs").alias("docs"), first(1).alias("q1"), first(3).alias("q3"))


def limits(sk: DataFrame) -> DataFrame:
    """One row per (lang, source): low and high limit of each rate. Sums of
    whole numbers only meet in one division each, so reruns agree."""
    same = lambda a, b, c: a[c].eqNullSafe(b[c])
    own = quartiles(sk, "lang", "source")
    lang = quartiles(merge(sk, "lang"), "lang").select(F.col("lang").alias("l_lang"), F.col("rate").alias("l_rate"), F.col("docs").alias("l_docs"), F.col("q1").alias("l_q1"), F.col("q3").alias("l_q3"))
    whole = quartiles(merge(sk)).select(F.col("rate").alias("a_rate"), F.col("q1").alias("a_q1"), F.col("q3").alias("a_q3"))
    j = own.join(lang, own.lang.eqNullSafe(F.col("l_lang")) & (own.rate == F.col("l_rate"))).join(whole, F.col("rate") == F.col("a_rate"))
    drawn = lambda n, q, wider: (F.col(n) * F.col(q) + PRIOR * wider) / (F.col(n) + PRIOR)
    pick = lambda q: drawn("docs", q, drawn("l_docs", f"l_{q}", F.col(f"a_{q}")))
    j = j.select("lang", "source", "rate", pick("q1").alias("q1"), pick("q3").alias("q3"))
    wide = [F.max(F.when(F.col("rate") == r, F.col("q3") + 3 * (F.col("q3") - F.col("q1")) + s)).alias(f"{r}_high") for r, (s, _) in RATES.items()]
    wide += [F.max(F.when(F.col("rate") == r, F.col("q1") - 3 * (F.col("q3") - F.col("q1")) - s)).alias(f"{r}_low") for r, (s, two) in RATES.items() if two]
    return j.groupBy("lang", "source").agg(*wide)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, the rates, base_failed, kept."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    rated = rates(text_counts(rows, "doc_id", "lang", "source"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rated = rated.withColumn("base_failed", base)
    lim = cut(limits(sketches(rated))).withColumnsRenamed({"lang": "m_lang", "source": "m_source"})
    j = rated.join(lim, rated.lang.eqNullSafe(F.col("m_lang")) & rated.source.eqNullSafe(F.col("m_source")), "left")
    ok = ~F.col("base_failed")
    for r, (_, two) in RATES.items():
        ok = ok & (F.col(r) <= F.col(f"{r}_high"))
        ok = ok & (F.col(r) >= F.col(f"{r}_low")) if two else ok
    return j.withColumn("kept", F.coalesce(ok, F.lit(False))).drop("m_lang", "m_source")
