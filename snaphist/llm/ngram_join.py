"""N-gram Jaccard self-join with signature trees.

A text's set is its distinct word shingles (of ``SHINGLE`` words unless the
caller says otherwise). Texts with equal sets form a
class, and only classes are joined. Two sets with similarity t share, in any
fixed order of shingles, one of the first n - ceil(t n) + 1 of each, so
classes meet in the bucket of such a shingle. The order goes by the rarest word
of a shingle, by a sketch of all words' counts: shingles of frequent words only,
which texts share by chance, come last and hardly ever bring texts together.
Among the classes that share a shingle

1. each is compared with the smallest-sized ones around it, and with the one
   that most tasks hold (stars, so a group of near copies costs few comparisons
   a member), and the links found make first components;
2. groups that still hold several components go through a signature tree:
   nodes hold OR-combined shingle bitmaps, size ranges and, if they have only
   one, their component. A dual traversal from (root, root) drops node pairs of
   one component, of incompatible sizes, or whose maximum possible overlap is
   too small, and yields the class pairs that are left. The likeliest pair of
   each two components is verified first; pairs it joins need no other.

All candidates are verified on whole sets, so every pair of classes that is
linked lies in one component, and no pair that isn't linked joins two.

Bounds: a row per class and shingle of its prefix is packed per bucket; sets
travel only for classes that are compared. Hashes: 64 bits for a set (with its
size), 48 for a shingle within one comparison.

Defined results: a text of fewer words than a shingle has its whole word sequence
as its only shingle; texts without words (or NULL) have none and stand alone;
rows with equal ids and different texts are separate documents; a component is
named NULL only if none of its documents has an id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.llm.blocks import block_count, by_bucket
from snaphist.llm.components import components
from snaphist.llm.lineage import broadcast_if_small, cut, cut_step, release
from snaphist.llm.tokens import Texts, grams, mix, planes, sliding_min, unplanes, words

SHINGLE, PERCENT = 4, 85
SKETCH_BITS = 18
SIGNATURE = 4  # bits of a bitmap per shingle at least, rounded up to a power of two
LEAF, FAN = 8, 8
U64 = np.uint64
PAIR = ["a", "a_n", "b", "b_n"]
NO_ID = 2**63 - 1  # stands for NULL in the order of ids


def shingle_sets(t: Texts, k: int = SHINGLE, rarity: np.ndarray | None = None):
    """(first position of each text and one more, distinct shingle hashes in
    ascending order per text), and with ``rarity`` (of the words' slots) that
    of each shingle: its rarest word's."""
    w = words(t)
    size = np.diff(w.first)
    doc = w.doc()
    g = grams(w.hash, k)
    at = np.flatnonzero(np.arange(g.size) + k <= w.first[1:][doc[:g.size]]) if g.size else np.empty(0, np.int64)
    d, h = doc[at], g[at]
    of_word = None if rarity is None else rarity[(w.hash >> U64(64 - SKETCH_BITS)).astype(np.int64)]
    least = None if rarity is None else (sliding_min(of_word, k)[at] if at.size else np.empty(0, np.uint8))
    for i in np.flatnonzero((size > 0) & (size < k)):  # the whole sequence
        a = np.full(1, size[i], U64)
        for x in w.hash[w.first[i]:w.first[i + 1]]:
            a = mix(a + x)
        d, h = np.append(d, i), np.append(h, a)
        least = None if least is None else np.append(least, of_word[w.first[i]:w.first[i + 1]].min())
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])) if d.size else np.empty(0, bool)
    d, h = d[new], h[new]
    first = np.searchsorted(d, np.arange(len(t) + 1))
    return (first, h) if least is None else (first, h, least[order][new])


def set_keys(first: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One hash per set, whatever the order."""
    total = np.append(U64(0), np.cumsum(mix(h ^ U64(0x5851F42D4C957F2D))))
    return mix(total[first[1:]] - total[first[:-1]]).view(np.int64)


def needed(n: np.ndarray | int, percent: int):
    """Least overlap of a set of n with any set linked to it."""
    return (percent * n + 99) // 100


def least_overlap(n, m, percent: int):
    """Least overlap of linked sets of n and m: 100 o >= percent (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


def _parts(batch, size: int = 1 << 20):
    t = Texts.of(batch.column("text"), lower=True)
    for lo, hi in t.parts(size):
        yield lo, hi, t.part(lo, hi)


def describe(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, n, key) of every document, and per task a row with the
    task's sketch of how often words occur (n is -1)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))

    def run(batches):
        count = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "th", "n", "key", "sketch"]
        for b in batches:
            for lo, hi, t in _parts(b):
                first, h = shingle_sets(t, shingle)
                count += np.bincount((words(t).hash >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=count.size)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("th").slice(lo, hi - lo), pa.array(np.diff(first)),
                                                  pa.array(set_keys(first, h)), pa.nulls(hi - lo, pa.binary())], names=names)
        if count.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([-1]), pa.nulls(1, pa.int64()),
                                              pa.array([planes(count.astype(U64), 4)], pa.binary())], names=names)

    return rows.mapInArrow(run, "doc_id long, th long, n long, key long, sketch binary")


def word_rarity(described: DataFrame, slices: int = 4) -> np.ndarray:
    """Logarithm of the count of each slot of the sketch, a byte each: small
    for slots that hold rare words only. The driver reads ``slices`` sums of
    fixed size."""
    def add(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for x in b.column("sketch"):
                total += unplanes(x.as_py(), total.size, 4).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([planes(total, 5)], pa.binary())], names=["s"])

    rows = described.where("n = -1").select("sketch").repartition(slices).mapInArrow(add, "s binary").collect()
    total = sum((unplanes(r["s"], 1 << SKETCH_BITS, 5).astype(np.int64) for r in rows), np.zeros(1 << SKETCH_BITS, np.int64))
    return (4 * np.log2(total + 1.0)).astype(np.uint8)


def _prefixes(rarity: np.ndarray, buckets: int, percent: int, shingle: int):
    def run(batches):
        tok, key, num = [], [], []
        for b in batches:
            for _, _, t in _parts(b):
                first, h, rare = shingle_sets(t, shingle, rarity)
                n = np.diff(first)
                doc = np.repeat(np.arange(n.size), n)
                rank = mix(h ^ U64(0x2545F4914F6CDD1D)) >> U64(8) | rare.astype(U64) << U64(56)
                order = np.lexsort((rank, doc))
                place = np.arange(h.size) - first[doc]
                use = order[place < (n - needed(n, percent) + 1)[doc]]
                tok.append(h[use])
                key.append(set_keys(first, h)[doc[use]])
                num.append(n[doc[use]])
        if not tok:
            return
        tok, key, num = np.concatenate(tok), np.concatenate(key), np.concatenate(num)
        order = np.lexsort((key, tok))
        tok, key, num = tok[order], key[order], num[order]
        new = np.append(True, (tok[1:] != tok[:-1]) | (key[1:] != key[:-1])) if tok.size else np.empty(0, bool)
        tok, key, num = mix(tok[new]), key[new], num[new]
        rows = [(b, at.size, planes(tok[at], 6), key[at].tobytes(), planes(num[at], 4)) for b, at in by_bucket(tok, buckets)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (2, 3, 4)]],
                                         names=["bucket", "n", "tok", "key", "num"])
    return run


def _meet(percent: int):
    """Star pairs (grp 0) and the groups of three classes and more."""
    def run(key, table):
        size = table["n"].to_numpy()
        tok = np.concatenate([unplanes(x.as_py(), n, 6) for x, n in zip(table["tok"], size)])
        k = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table["key"]])
        num = np.concatenate([unplanes(x.as_py(), n, 4) for x, n in zip(table["num"], size)]).astype(np.int64)
        order = np.lexsort((k, num, tok))
        tok, k, num = tok[order], k[order], num[order]
        new = np.append(True, (tok[1:] != tok[:-1]) | (k[1:] != k[:-1]) | (num[1:] != num[:-1]))
        seen_in = np.diff(np.append(np.flatnonzero(new), tok.size))  # tasks that sent the class: more for one of many copies
        tok, k, num = tok[new], k[new], num[new]
        # a group ends with its shingle, and where sizes are too far apart
        cut_here = np.append(True, (tok[1:] != tok[:-1]) | (100 * num[:-1] < percent * num[1:]))
        starts = np.flatnonzero(cut_here)
        count = np.diff(np.append(starts, tok.size))
        seen, pairs, groups = set(), [], []
        two = starts[count == 2]
        pairs.append(np.stack([k[two], num[two], k[two + 1], num[two + 1]], 1))
        for s, c in zip(starts[count > 2].tolist(), count[count > 2].tolist()):
            kk, nn = k[s:s + c], num[s:s + c]
            name = hash((c, kk.tobytes()))
            if name in seen:
                continue
            seen.add(name)
            name = int(mix(np.array([np.bitwise_xor.reduce(mix(kk.view(U64))) + U64(c)], U64)).view(np.int64)[0]) | 1
            groups.append(np.stack([np.full(c, name), nn, kk, nn], 1))
            m = int(seen_in[s:s + c].argmax())
            if m and seen_in[s + m] > 1:  # near copies are nearest to the text that was copied most
                lo, hi = np.searchsorted(nn, -(-percent * nn[m] // 100), "left"), np.searchsorted(nn, 100 * nn[m] // percent, "right")
                low, high = np.arange(lo, m), np.arange(m + 1, hi)
                pairs.append(np.stack([np.append(kk[low], np.full(high.size, kk[m])), np.append(nn[low], np.full(high.size, nn[m])),
                                       np.append(np.full(low.size, kk[m]), kk[high]), np.append(np.full(low.size, nn[m]), nn[high])], 1))
            at = 0
            while at < c:
                to = int(np.searchsorted(nn, 100 * nn[at] // percent, "right"))
                if to > at + 1:
                    pairs.append(np.stack([np.full(to - at - 1, kk[at]), np.full(to - at - 1, nn[at]), kk[at + 1:to], nn[at + 1:to]], 1))
                at = to if to < c else c
        p = np.unique(np.concatenate(pairs), axis=0)
        g = np.concatenate(groups) if groups else np.empty((0, 4), np.int64)
        kind = np.append(np.zeros(len(p), np.int32), np.ones(len(g), np.int32))
        both = np.concatenate([p, g])
        return pa.table({"kind": kind, **{c: np.ascontiguousarray(both[:, i]) for i, c in enumerate(("a", "a_n", "b", "b_n"))}})
    return run


def signature(h: np.ndarray) -> np.ndarray:
    """Bitmap of a set, of a width that grows with it, so long texts are told
    apart as well as short ones."""
    width = max(64, 1 << (SIGNATURE * h.size - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(h % U64(width)).astype(np.int64)] = True
    return np.packbits(bits).view(U64)


def fold(sig: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (a row each) brought to a smaller width: slots that meet are
    OR-combined, so a bitmap keeps standing for its set."""
    return np.bitwise_or.reduce(sig.reshape(sig.shape[0], -1, words), axis=1)


def _sets(what: str, shingle: int):
    """key, n and the set itself (``tokens``) or its bitmap (``sig``)."""
    def run(batches):
        for b in batches:
            for lo, hi, t in _parts(b):
                first, h = shingle_sets(t, shingle)
                key, n = set_keys(first, h), np.diff(first)
                want = np.flatnonzero((key == b.column("w_key").slice(lo, hi - lo).to_numpy()) & (n == b.column("w_n").slice(lo, hi - lo).to_numpy()))
                own = [h[first[i]:first[i + 1]] for i in want]
                data = [signature(x).tobytes() if what == "sig" else planes(np.sort(x & U64((1 << 48) - 1)), 6) for x in own]
                yield pa.RecordBatch.from_arrays([pa.array(key[want]), pa.array(n[want]), pa.array(data, pa.binary())], names=["key", "n", what])
    return run


def fetch_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, what: str, shingle: int) -> DataFrame:
    """(key, n, ``what``) of the classes in ``wanted`` (key, n), from the text
    of each class's first document."""
    ids = cut(classes.join(wanted.select(F.col("key").alias("x_key"), F.col("n").alias("x_n")).distinct(), (F.col("key") == F.col("x_key")) & (F.col("n") == F.col("x_n")), "left_semi")
              .select(F.col("rep.doc_id").alias("w_id"), F.col("rep.th").alias("w_th"), F.col("key").alias("w_key"), F.col("n").alias("w_n")))
    ids = broadcast_if_small(ids)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(ids, (F.xxhash64("text") == F.col("w_th")) & F.col("doc_id").eqNullSafe(F.col("w_id"))).select("text", "w_key", "w_n")
    return cut_step(rows.mapInArrow(_sets(what, shingle), f"key long, n long, {what} binary"))


def ends(pairs: DataFrame) -> DataFrame:
    """(key, n) of both ends of pairs."""
    return pairs.select(F.col("a").alias("key"), F.col("a_n").alias("n")).unionByName(pairs.select(F.col("b").alias("key"), F.col("b_n").alias("n")))


def possible(n, m, sig_a, sig_b, percent: int):
    """Whether two sets' bitmaps allow the least overlap."""
    most = np.minimum(n - np.bitwise_count(sig_a & ~sig_b).sum(-1), m - np.bitwise_count(sig_b & ~sig_a).sum(-1))
    return most >= least_overlap(n, m, percent)


def verify(pairs: DataFrame, bitmaps: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The (a, a_n, b, b_n) that are linked: bitmaps first, then whole sets,
    which are made for the classes that still have a pair."""
    side = lambda sets, c, x: sets.select(F.col("key").alias(c), F.col("n").alias(f"{c}_n"), F.col(x).alias(f"{c}_{x}"))

    def keep(test):
        def run(batches):
            for b in batches:
                n, m = b.column("a_n").to_numpy(), b.column("b_n").to_numpy()
                ok = test(b, n, m) if b.num_rows else np.empty(0, bool)
                yield b.select(PAIR).filter(pa.array(ok, pa.bool_()))
        return run

    def by_bitmap(b, n, m):
        x, y = b.column("a_sig").to_pylist(), b.column("b_sig").to_pylist()
        width = np.array([[len(u) // 8, len(v) // 8] for u, v in zip(x, y)])
        ok = np.empty(b.num_rows, bool)
        for w in np.unique(width, axis=0):  # rows of one width at a time
            at = np.flatnonzero((width == w).all(1))
            sig = [fold(np.frombuffer(b"".join(side[i] for i in at), U64).reshape(at.size, -1), w.min()) for side in (x, y)]
            ok[at] = possible(n[at], m[at], *sig, percent)
        return ok

    def by_set(b, n, m):
        out = np.empty(b.num_rows, bool)
        for i, (x, y) in enumerate(zip(b.column("a_tokens"), b.column("b_tokens"))):
            o = np.intersect1d(unplanes(x.as_py(), n[i], 6), unplanes(y.as_py(), m[i], 6), assume_unique=True).size
            out[i] = 100 * o >= percent * (n[i] + m[i] - o)
        return out

    schema = "a long, a_n long, b long, b_n long"
    left = cut_step(pairs.join(side(bitmaps, "a", "sig"), ["a", "a_n"]).join(side(bitmaps, "b", "sig"), ["b", "b_n"]).mapInArrow(keep(by_bitmap), schema))
    sets = fetch_sets(docs, classes, ends(left), "tokens", shingle)
    return cut_step(left.join(side(sets, "a", "tokens"), ["a", "a_n"]).join(side(sets, "b", "tokens"), ["b", "b_n"]).mapInArrow(keep(by_set), schema))


class SignatureTree:
    """Nodes over members ordered by component and size, bottom up."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, sig: np.ndarray):
        self.n, self.comp, self.sig = n, comp, sig
        self.ones = np.bitwise_count(sig).sum(1).astype(np.int64)
        lo = np.arange(0, n.size, LEAF)
        self.levels = [self._level(lo, np.append(lo[1:], n.size), None)]
        while self.levels[-1]["low"].size > 1:
            below = self.levels[-1]
            lo = np.arange(0, below["low"].size, FAN)
            self.levels.append(self._level(lo, np.append(lo[1:], below["low"].size), below))

    def _level(self, lo, hi, below):
        n_lo, n_hi = (self.n, self.n) if below is None else (below["low"], below["high"])
        sig, ones = (self.sig, self.ones) if below is None else (below["sig"], below["ones"])
        c_lo, c_hi = (self.comp, self.comp) if below is None else (below["c_low"], below["c_high"])
        return {"lo": lo, "hi": hi, "low": np.minimum.reduceat(n_lo, lo), "high": np.maximum.reduceat(n_hi, lo), "ones": np.minimum.reduceat(ones, lo),
                "sig": np.bitwise_or.reduceat(sig, lo, axis=0), "c_low": np.minimum.reduceat(c_lo, lo), "c_high": np.maximum.reduceat(c_hi, lo)}

    def pairs(self, percent: int):
        """(i, j) arrays of members that may be linked, of two components."""
        todo = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            depth, a, b = todo.pop()
            v = self.levels[depth]
            one = (v["c_low"][a] == v["c_high"][a]) & (v["c_low"][b] == v["c_high"][b]) & (v["c_low"][a] == v["c_low"][b])
            sizes = (100 * v["high"][a] >= percent * v["low"][b]) & (100 * v["high"][b] >= percent * v["low"][a])
            common = np.bitwise_count(v["sig"][a] & v["sig"][b]).sum(1).astype(np.int64)
            most = np.minimum(v["high"][a] - np.maximum(0, v["ones"][a] - common), v["high"][b] - np.maximum(0, v["ones"][b] - common))
            go = ~one & sizes & (most >= least_overlap(v["low"][a], v["low"][b], percent))
            a, b = a[go], b[go]
            for at in range(0, a.size, 512):
                x, y = self._down(v, a[at:at + 512], b[at:at + 512])
                if depth:
                    todo.append((depth - 1, x, y))
                    continue
                ok = (self.comp[x] != self.comp[y]) & (100 * np.minimum(self.n[x], self.n[y]) >= percent * np.maximum(self.n[x], self.n[y]))
                x, y = x[ok], y[ok]
                ok = possible(self.n[x], self.n[y], self.sig[x], self.sig[y], percent)
                yield x[ok], y[ok]

    @staticmethod
    def _down(v, a, b):
        """Children pairs of node pairs; a node with itself gives each once."""
        xs, ys = [], []
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = np.meshgrid(np.arange(v["lo"][i], v["hi"][i]), np.arange(v["lo"][j], v["hi"][j]), indexing="ij")
            keep = (x <= y) if i == j else np.ones(x.shape, bool)
            xs.append(x[keep])
            ys.append(y[keep])
        return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.empty(0, np.int64), np.empty(0, np.int64))


TREE_PAIR = "a long, a_n long, b long, b_n long, a_comp long, b_comp long, margin long"


def _tree_pairs(percent: int):
    """Pairs of two components that their bitmaps allow, and by how much."""
    def run(key, table):
        table = table.combine_chunks().sort_by([("comp", "ascending"), ("n", "ascending"), ("key", "ascending")])
        n, comp, k = (table[c].to_numpy() for c in ("n", "comp", "key"))
        raw = [np.frombuffer(x.as_py(), U64) for x in table["sig"]]
        least = min(x.size for x in raw)
        sig = np.stack([fold(x[None], least)[0] for x in raw])
        out = []
        for x, y in SignatureTree(n, comp, sig).pairs(percent):
            margin = np.minimum(n[x], n[y]) - np.bitwise_count(sig[x] & ~sig[y]).sum(1).astype(np.int64)
            out.append(np.stack([k[x], n[x], k[y], n[y], comp[x], comp[y], margin], 1))
        p = np.concatenate(out) if out else np.empty((0, 7), np.int64)
        return pa.table({c.split()[0]: np.ascontiguousarray(p[:, i]) for i, c in enumerate(TREE_PAIR.split(", "))})
    return run


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, th (hash of the text) and stays (this
    is its component's first document) of every document. Rows that are equal
    in id and text are one document."""
    described = cut_step(describe(docs, shingle))
    rows = described.where("n >= 0").select("doc_id", "th", "n", "key")
    smallest = F.min(F.struct(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("o"), "doc_id", "th")).alias("rep")
    classes = cut(rows.where("n > 0").groupBy("key", "n").agg(smallest))
    buckets = block_count(docs)
    packed = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_prefixes(word_rarity(described), buckets, percent, shingle), "bucket int, n int, tok binary, key binary, num binary")
    met = cut(packed.groupBy("bucket").applyInArrow(_meet(percent), "kind int, a long, a_n long, b long, b_n long").distinct())
    release(docs.sparkSession)  # here and below: what finished steps left in the driver
    pairs, groups = met.where("kind = 0").drop("kind"), met.where("kind = 1").select(F.col("a").alias("grp"), F.col("b").alias("key"), F.col("b_n").alias("n"))
    bitmaps = fetch_sets(docs, classes, ends(pairs).unionByName(groups.select("key", "n")), "sig", shingle)
    links = verify(pairs, bitmaps, docs, classes, percent, shingle)
    first = label(links, classes)
    release(docs.sparkSession)
    # groups whose classes aren't all in one component yet, found without their bitmaps
    marked = cut_step(groups.join(first.select("key", "n", "mark"), ["key", "n"], "left").select("grp", "key", "n", F.coalesce("mark", F.xxhash64("key", "n")).alias("comp")))
    several = marked.groupBy("grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("grp")
    open_groups = cut_step(marked.join(several, "grp", "left_semi"))
    tree = open_groups.join(bitmaps, ["key", "n"]).select("grp", "key", "n", "comp", "sig").groupBy("grp").applyInArrow(_tree_pairs(percent), TREE_PAIR)
    tree = cut_step(tree.groupBy(*PAIR).agg(F.max(F.struct("margin", "a_comp", "b_comp")).alias("m")).select(*PAIR, "m.*"))
    more = cut(tree.join(pairs, PAIR, "left_anti"))
    release(docs.sparkSession)
    # the likeliest pair of any two components first; those it joins need no other
    likely = cut(more.groupBy(F.least("a_comp", "b_comp").alias("x"), F.greatest("a_comp", "b_comp").alias("y"))
                 .agg(F.max(F.struct("margin", *PAIR)).alias("m")).select(*[F.col(f"m.{c}").alias(c) for c in PAIR]))
    links = cut(links.unionByName(verify(likely, bitmaps, docs, classes, percent, shingle)))
    second = label(links, classes).select("key", "n", "mark")
    release(docs.sparkSession)
    mark = lambda c: second.select(F.col("key").alias(c), F.col("n").alias(f"{c}_n"), F.col("mark").alias(f"{c}_mark"))
    rest = cut_step(more.join(likely, PAIR, "left_anti").join(mark("a"), ["a", "a_n"], "left").join(mark("b"), ["b", "b_n"], "left")
                    .where("a_mark IS NULL OR b_mark IS NULL OR a_mark <> b_mark").select(*PAIR))
    final = label(links.unionByName(verify(rest, bitmaps, docs, classes, percent, shingle)), classes)
    best = final.select("key", "n", F.struct("o", "th").alias("best"))
    named = classes.join(best, ["key", "n"], "left").select("key", "n", F.coalesce("best", F.struct("rep.o", "rep.th")).alias("best"))
    own = F.struct(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("o"), "th")
    linked = rows.where("n > 0").join(named, ["key", "n"]).select("doc_id", F.col("n").alias("n_shingles"), _id("best.o").alias("component_id"), "th", (own == F.col("best")).alias("stays"))
    return linked.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "th", F.lit(True).alias("stays")))


def _id(column: str):
    return F.when(F.col(column) < NO_ID, F.col(column))


def label(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, n, o, th, mark) of each linked class: id and text hash of the first
    document of its component, and a hash that names it."""
    ids = classes.select("key", "n", F.col("rep.o").alias("o"), F.col("rep.th").alias("th"))
    # ids order the nodes; text hashes tell classes without an id apart
    node = F.struct("o", "th", "n", "key")
    end = lambda c, out: links.join(ids.withColumn(out, node).select(F.col("key").alias(c), F.col("n").alias(f"{c}_n"), out), [c, f"{c}_n"])
    edges = end("a", "u").join(ids.withColumn("v", node).select(F.col("key").alias("b"), F.col("n").alias("b_n"), "v"), ["b", "b_n"]).select("u", "v")
    found = components(edges)
    return found.select("node.key", "node.n", "component.o", "component.th", F.xxhash64("component.key", "component.n").alias("mark"))
