"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters that occurs in a text with at most e edits shares at
least m - q + 1 - q*e of its q-grams with it, on diagonals (text position less
item position) at most e apart. Shared q-grams are counted per item in bands of
2e diagonals (at least two), each overlapping the next by half, so that every
occurrence lies wholly in one of them. Bands that reach the bound are verified
by an alignment of those diagonals only, which gives the fewest edits of the
item within the band. The filter loses nothing within the budget of
e = ``budget`` * m edits.

q is 8, or for short items the largest that keeps the bound at 1 or more
(m div (e + 1)), so items of any length are searched.

Texts and items are lower-cased, and white space counts as one space. Items
are taken in shards of bounded size (``SHARD_BYTES``), broadcast one by one and
indexed in the tasks; each shard reads the documents once. There is no shuffle.

Defined results: NULL and empty texts have no leak; empty items are never
found; of overlapping finds of one item in one text the one with fewest edits
counts, then the one that ends first; repeated items and rows are each
reported; empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
BUDGET = 0.08
SHARD_BYTES = 4 << 20
TABLE_BITS = 22
PART = 1 << 17
HITS = "doc_id long, item_id long, start long, end long, edits int"


def normal(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on (zeros behind the end), as one
    number; the first q of them are its low bytes."""
    buf = np.append(buf, np.zeros(Q - 1, np.uint8))
    return np.ndarray((buf.size - Q + 1,), "<u8", buf.data, 0, (1,))


def slot(g: np.ndarray) -> np.ndarray:
    return (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)


class Grams:
    """Index of the q-grams of some items, for one q."""

    def __init__(self, q: int, items: list[tuple[int, bytes]]):
        self.q, self.mask = q, np.uint64((1 << (8 * q)) - 1)
        grams = [eights(np.frombuffer(x, np.uint8))[:len(x) - q + 1] & self.mask for _, x in items]
        g = np.concatenate(grams)
        item = np.repeat(np.array([k for k, _ in items]), [x.size for x in grams])
        pos = np.concatenate([np.arange(x.size) for x in grams])
        order = np.argsort(g, kind="stable")
        self.gram, first = np.unique(g[order], return_index=True)
        self.first = np.append(first, g.size)
        self.item, self.pos = item[order], pos[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[slot(self.gram)] = True

    def shared(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of every q-gram that text (as ``eights``) and items
        share."""
        g = text[:max(0, text.size - self.q + 1)] & self.mask
        at = np.flatnonzero(self.table[slot(g)])
        key = g[at]
        k = np.minimum(np.searchsorted(self.gram, key), self.gram.size - 1)
        real = self.gram[k] == key
        at, k = at[real], k[real]
        n = self.first[k + 1] - self.first[k]
        each = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return self.item[each], np.repeat(at, n) - self.pos[each]


class Shard:
    """q-gram indexes of some items."""

    def __init__(self, items: list[tuple[int, str]], budget: float = BUDGET, least: int = 1):
        self.items = [(i, x) for i, x in ((i, normal(x)) for i, x in items) if len(x) >= least]
        self.size = np.array([len(x) for _, x in self.items], np.int64)
        self.edits = np.array([int(budget * len(x)) for _, x in self.items], np.int64)
        self.q = np.minimum(Q, self.size // (self.edits + 1))
        self.bound = self.size - self.q + 1 - self.q * self.edits
        self.step = np.maximum(1, self.edits)  # half a band
        self.grams = [Grams(int(q), [(k, self.items[k][1]) for k in np.flatnonzero(self.q == q)]) for q in np.unique(self.q)]
        self.gap = Q + 2 * int(self.step.max(initial=1))

    def bands(self, buf: np.ndarray) -> list[tuple[int, int]]:
        """(item, first diagonal) of the bands that reach the bound."""
        text = eights(buf)
        met = [g.shared(text) for g in self.grams]
        item, diag = (np.concatenate([m[k] for m in met]) if met else np.empty(0, np.int64) for k in (0, 1))
        if not item.size:
            return []
        low = int(diag.min())
        band = (diag - low) // self.step[item] + 1
        top = int(band.max()) + 1
        key = np.concatenate([item * top + band, item * top + band - 1])  # band b: the steps b and b + 1
        key, n = np.unique(key, return_counts=True)
        key = key[n >= self.bound[key // top]]
        return [(int(i), low + (int(b) - 1) * int(self.step[i])) for i, b in zip(key // top, key % top)]

    def regions(self, buf: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, from, to): stretches of the text that reach the bound."""
        return [(i, max(0, d), min(buf.size, d + 2 * int(self.step[i]) + int(self.size[i]))) for i, d in self.bands(buf)]

    def find(self, buf: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) of verified leaks in one text."""
        found: dict[int, set[tuple[int, int, int]]] = {}
        for i, d in self.bands(buf):
            text, width = self.items[i][1], 2 * int(self.step[i])
            lo = max(0, d)
            at = buf[lo:max(lo, d + width - 1 + len(text))].tobytes().find(text)
            if at >= 0:
                hit = (lo + at, lo + at + len(text), 0)
            else:
                hit = banded_alignment(np.frombuffer(text, np.uint8), buf, d, width, int(self.edits[i])) if self.edits[i] else None
            if hit:
                found.setdefault(i, set()).add(hit)
        out = []
        for i, hits in found.items():
            kept: list[tuple[int, int, int]] = []
            for s, e, n in sorted(hits, key=lambda h: (h[2], h[1], h[0])):
                if not any(s < b and a < e for a, b, _ in kept):
                    kept.append((s, e, n))
            out.extend((i, *h) for h in kept)
        return out


def banded_alignment(item: np.ndarray, text: np.ndarray, first: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """Fewest edits of the whole item against any stretch of ``text`` on the
    ``width`` diagonals from ``first`` on, if at most ``edits``: (start, end,
    edits), of equal ones the one that ends first. A row of the table is the
    band's cells: text position = items read + diagonal."""
    far = item.size + text.size + 1
    ramp = np.arange(width)
    at = first + ramp  # text position of each diagonal's cell
    cost, start = np.where((at >= 0) & (at <= text.size), 0, far), at.copy()
    padded = np.full(item.size + width, -1, np.int16)  # the text from ``first`` on
    lo, hi = max(0, first), min(text.size, first + padded.size)
    if lo < hi:
        padded[lo - first:hi - first] = text[lo:hi]
    for i, c in enumerate(item.tolist()):
        best = cost + (padded[i:i + width] != c)
        origin = start
        if width > 1:
            skip = np.append(cost[1:], far) + 1  # the item's character has no partner
            take = skip < best
            best, origin = np.where(take, skip, best), np.where(take, np.append(start[1:], 0), origin)
        at = first + i + 1 + ramp
        best = np.where((at >= 0) & (at <= text.size), best, far)
        level = best - ramp
        run = np.minimum.accumulate(level)  # characters of the text without partner
        came = np.maximum.accumulate(np.where(level == run, ramp, 0))
        cost, start = run + ramp, origin[came]
        cost = np.where((at >= 0) & (at <= text.size), cost, far)
        if cost.min() > edits:
            return None
    end = int(cost.argmin())
    return (int(start[end]), int(first + item.size + end), int(cost[end])) if cost[end] <= edits else None


def shards(benchmark: DataFrame) -> list[Broadcast]:
    """The benchmark in broadcasts of about SHARD_BYTES, read one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // SHARD_BYTES))
    out = []
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        out.append(benchmark.sparkSession.sparkContext.broadcast(sorted(((r["item_id"], r["text"]) for r in part), key=lambda x: (x[0] is None, x[0] or 0, x[1]))))
    return out


def scan(shard: Shard, texts: list) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, edits) of the leaks in many texts. Texts are
    filtered some at a time, joined by bytes that no text has."""
    out, group, size = [], [], 0

    def done():
        gap = np.zeros(shard.gap, np.uint8)
        flat, owner, at = [], [], 0
        for i, b in group:
            flat += [b, gap]
            owner.append((at, i, b))
            at += b.size + gap.size
        first = np.array([o[0] for o in owner])
        hit = sorted({k for _, a, z in shard.regions(np.concatenate(flat)) for k in range(max(0, int(np.searchsorted(first, a, "right")) - 1), int(np.searchsorted(first, z, "left")))})
        for k in hit:
            _, i, b = owner[k]
            out.extend((i, *h) for h in shard.find(b))

    for i, x in enumerate(texts if shard.items else []):
        raw = normal(x) if x else b""
        if not raw:
            continue
        group.append((i, np.frombuffer(raw, np.uint8)))
        size += len(raw)
        if size >= PART:
            done()
            group, size = [], 0
    if group:
        done()
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET) -> DataFrame:
    """One row per leak: doc_id, item_id, start, end (in the normalised text's
    bytes) and edits."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(items: Broadcast) -> DataFrame:
        def run(batches):
            shard = Shard(items.value, budget)
            for b in batches:
                hits = scan(shard, b.column("text").to_pylist())
                ids = b.column("doc_id").to_pylist()
                cols = [[ids[h[0]] for h in hits], [shard.items[h[1]][0] for h in hits], [h[2] for h in hits], [h[3] for h in hits]]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols], pa.array([h[4] for h in hits], pa.int32())], names=["doc_id", "item_id", "start", "end", "edits"])
        return rows.mapInArrow(run, HITS)

    return reduce(DataFrame.unionAll, [search(s) for s in shards(benchmark)])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, least: int = Q) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item of ``least``
    bytes or more (a shorter one, such as "yes", is no sign of a leak)."""
    schema = docs.schema
    for items in shards(benchmark):
        def run(batches, items=items):
            shard = Shard(items.value, budget, least)
            for b in batches:
                bad = {h[0] for h in scan(shard, b.column("text").to_pylist())}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_()))
        docs = docs.mapInArrow(run, schema)
    return docs
