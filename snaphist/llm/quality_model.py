"""Quality classifier: random-indexing word vectors and a small network.

Random indexing: every character trigram (hashed to ``BUCKETS``) has a sparse
random ternary index vector. A trigram's context vector is the sum of the
index vectors of the trigrams near it in the sample, which reach into the
neighbouring words; a word's vector is the sum over its trigrams, and a
document pools its words' vectors (as a mean, over all of its text). Pairs of
words one, and two to five, apart are pooled as well, by the product of their
own index vectors, which is 1 for equal words and taken as 0 otherwise. A
two-layer network in numpy turns pooled vectors into a probability, and one
temperature, fitted on rows the network was not trained on, calibrates it.

Bounded parameters: the ``SAMPLE`` labelled ids with the smallest hashes are
learned from. Everything else reads whole texts of all rows.

Defined results: NULL and empty texts are scored as a text without trigrams;
without both labels to learn from every score is the share of label 1 (1 if
there is none); a document labelled more than once counts with its lowest
label; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.llm.sampling import near_bottom
from snaphist.llm.tokens import Texts, words

BUCKETS, DIM, HIDDEN = 2048, 64, 32
LAGS = ((1,), (2, 3, 4, 5))
NEAR = 6  # bytes to the right in which trigrams are each other's context
SAMPLE = 6_000
THRESHOLD = 0.3
EPOCHS, BATCH, RATE = 60, 64, 3e-3


def buckets(buf: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that starts at each byte but the last two."""
    if buf.size < 3:
        return np.empty(0, np.int32)
    b = buf.astype(np.uint32)
    h = (b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))) * np.uint32(2654435761)
    return (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)


def index_vectors(seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, DIM), np.float32)
    for sign in (1, -1):
        out[np.arange(BUCKETS)[:, None], rng.integers(0, DIM, (BUCKETS, 3))] = sign
    return out


def histogram(t: Texts) -> np.ndarray:
    """Share of each bucket in each text."""
    n = len(t)
    b = buckets(t.buf)
    doc = np.repeat(np.arange(n), np.diff(t.off))[:b.size]
    inside = np.arange(b.size) + 3 <= t.off[1:][doc] if b.size else np.empty(0, bool)
    h = np.bincount(doc[inside] * BUCKETS + b[inside], minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
    return h / np.maximum(h.sum(1, keepdims=True), 1)


def near_counts(t: Texts) -> np.ndarray:
    """How often two buckets are within NEAR bytes of each other."""
    m = np.zeros((BUCKETS, BUCKETS), np.float32)
    for lo, hi in zip(t.off[:-1], t.off[1:]):
        b = buckets(t.buf[lo:hi]).astype(np.int64)
        for d in range(1, NEAR + 1):
            if b.size > d:
                k, n = np.unique(b[:-d] * BUCKETS + b[d:], return_counts=True)
                m.reshape(-1)[k] += n
    return m + m.T


def agreement(t: Texts) -> np.ndarray:
    """Mean product of the index vectors of words some places apart."""
    w = words(t)
    doc, out = w.doc(), np.zeros((len(t), len(LAGS)), np.float32)
    for k, lags in enumerate(LAGS):
        for d in lags:
            same = doc[:-d] == doc[d:]
            equal = same & (w.hash[:-d] == w.hash[d:])
            out[:, k] += np.bincount(doc[d:], weights=equal, minlength=len(t)) / np.maximum(np.bincount(doc[d:], weights=same, minlength=len(t)), 1)
    return out


def pool(t: Texts, context: np.ndarray) -> np.ndarray:
    """Mean word vector, and agreement; shares are damped so that a few
    frequent trigrams don't hide the rare ones that mark bad text."""
    return np.concatenate([np.sqrt(histogram(t)) @ context, agreement(t)], axis=1)


def learn_context(sample: DataFrame, parts: int = 8, slices: int = 8) -> np.ndarray:
    """Context vectors from the sample's texts (a bounded number of rows). The
    parts' sums, whole numbers, are added slice by slice in tasks, so the
    driver reads one matrix however many parts there are."""
    r = index_vectors().astype(np.float64)

    def partial(batches):
        m = np.zeros((BUCKETS, BUCKETS))
        for b in batches:
            m += near_counts(Texts.of(b.column("text")))
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([x.tobytes() for x in np.array_split(m @ r, slices)], pa.binary())], names=["slice", "m"])

    def add(key, table):
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table["m"])
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})

    dealt = sample.select("doc_id", "text").repartition(parts, F.xxhash64("doc_id")).select("text")  # equal texts apart
    rows = dealt.mapInArrow(partial, "slice int, m binary").groupBy("slice").applyInArrow(add, "slice int, m binary").collect()
    c = np.concatenate([np.frombuffer(x["m"], np.float64) for x in sorted(rows, key=lambda x: x["slice"])]).reshape(BUCKETS, DIM) if rows else np.zeros((BUCKETS, DIM))
    size = np.linalg.norm(c, axis=1, keepdims=True)
    return (np.where(size > 0, c / np.maximum(size, 1e-9), 0) + r / np.sqrt(DIM)).astype(np.float32)


def sample_rows(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The rows (doc_id, text, y) of the ``size`` labelled ids with the smallest hashes."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")) \
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"))
    n = lab.count()
    h = F.xxhash64("doc_id")
    lab = lab.where(near_bottom(h, size, F.lit(max(n, 1)))).orderBy(h, "doc_id").limit(size)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(lab), "doc_id")  # at most ``size`` rows of two integers


def vectors(docs: DataFrame, context: np.ndarray, *keep: str) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches):
        for b in batches:
            t = Texts.of(b.column("text"))
            for lo, hi in t.parts(1 << 18):
                v = pool(t.part(lo, hi), context)
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(lo, hi - lo) for c in keep], pa.array(list(v), pa.list_(pa.float32()))], names=[*keep, "v"])

    return docs.select(*keep, "text").mapInArrow(run, f"{schema}, v array<float>")


def train(v: np.ndarray, y: np.ndarray, seed: int = 3) -> dict:
    """Two layers, Adam, then the temperature on every fifth row."""
    mean, sd = v.mean(0), v.std(0) + 1e-6
    x = (v - mean) / sd
    held = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(seed)
    p = {"w1": rng.normal(0, DIM ** -0.5, (v.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "b2": np.zeros(1)}
    m1, m2, step = {k: 0 * q for k, q in p.items()}, {k: 0 * q for k, q in p.items()}, 0
    xt, yt = x[~held], y[~held]
    for epoch in range(EPOCHS):
        order = rng.permutation(len(yt))
        for lo in range(0, len(yt), BATCH):
            at = order[lo:lo + BATCH]
            h = np.tanh(xt[at] @ p["w1"] + p["b1"])
            d = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - yt[at]) / len(at)
            dh = d[:, None] * p["w2"] * (1 - h * h)
            g = {"w2": h.T @ d, "b2": d.sum(keepdims=True), "w1": xt[at].T @ dh + 1e-4 * p["w1"], "b1": dh.sum(0)}
            step += 1
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - RATE * (1 - epoch / EPOCHS) * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    model = {"mean": mean, "sd": sd, **p, "t": 1.0}
    if held.any():
        z = logits(model, v[held])
        grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, z / t) - y[held] * z / t) for t in grid]
        model["t"] = float(grid[int(np.argmin(loss))])
    return model


def logits(model: dict, v: np.ndarray) -> np.ndarray:
    return np.tanh(((v - model["mean"]) / model["sd"]) @ model["w1"] + model["b1"]) @ model["w2"] + model["b2"][0]


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    sample = sample_rows(docs, labels)
    context = learn_context(sample)
    rows = vectors(sample, context, "doc_id", "y").collect()
    if len({r["y"] for r in rows}) < 2:
        return {"context": context, "constant": float(rows[0]["y"]) if rows else 1.0}
    rows.sort(key=lambda r: (r["doc_id"], r["v"]))
    return {"context": context, **train(np.array([r["v"] for r in rows], np.float64), np.array([r["y"] for r in rows], np.float64))}


def score(docs: DataFrame, model: dict, *keep: str) -> DataFrame:
    """``keep`` columns and ``score`` in 0..1 of every whole text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    names = [*keep, "score"]

    def run(batches):
        for b in batches:
            t = Texts.of(b.column("text"))
            for lo, hi in t.parts(1 << 18):
                if "constant" in model:
                    s = np.full(hi - lo, model["constant"])
                else:
                    v = pool(t.part(lo, hi), model["context"])
                    s = 1 / (1 + np.exp(-np.clip(logits(model, v) / model["t"], -30, 30)))
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(lo, hi - lo) for c in keep], pa.array(np.asarray(s, np.float64))], names=names)

    cols = dict.fromkeys([*keep, "text"])
    return docs.select(*cols).mapInArrow(run, f"{schema}, score double")
