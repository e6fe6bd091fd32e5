"""Language identification with a byte convolutional network.

Filters of two, three and four bytes over a byte embedding, ReLU, max pooling
over a window of fixed length and a softmax layer, trained in numpy with Adam.
To apply it, a filter over bytes is the sum of what its byte pairs contribute,
so the trained filters become two tables indexed by byte pairs, and a window
costs two table reads a byte. A text is every one of its windows; its
probabilities are their mean, weighted by the bytes they hold.

Bounded parameters: training uses at most ``SAMPLE`` windows, dealt evenly to
the languages: of each language the texts with the smallest hashes of id and
text, whatever its size, and at least one; nothing else is sampled.

Defined results: NULL text or no letter gives ``und`` with score 0; so does
everything if no labelled text was given; rows whose lang is NULL are never
learned from; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaphist.llm.lineage import broadcast_if_small
from snaphist.llm.sampling import near_bottom
from snaphist.llm.tokens import LOWER_AZ, Texts

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS, EMBED = 8, 8
SAMPLE = 12_000
PER_DOC = 4  # windows of one document in the sample
EPOCHS, BATCH, RATE = 8, 64, 4e-3
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def training_windows(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[bytes], list[str]]:
    """At most ``sample`` windows of (text, lang) rows, evenly per language (and
    those of one text per language, if there are more languages than that)."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                           F.xxhash64("doc_id", "text").alias("h")).where(F.col("lang").isNotNull() & (F.length("text") > 0))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    found = sizes.agg(F.count("*").alias("k")).first()["k"]
    if not found:
        return [], []
    quota = max(1, sample // found // PER_DOC)
    near = rows.join(broadcast_if_small(sizes), "lang").where(near_bottom(F.col("h"), quota, F.col("n")))
    # rows that are equal in id and text count once; the smallest hashes of each language stay
    one = near.groupBy("lang", "h").agg(F.max("text").alias("text"))
    chosen = one.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= quota).drop("k")

    def cut(batches):
        for b in batches:
            text, lang = [], []
            for x, la, h in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), b.column("h").to_pylist()):
                raw = x.encode()
                n = -(-len(raw) // WINDOW)
                for j in sorted({(h + k * n // PER_DOC) % n for k in range(PER_DOC)}):
                    text.append(raw[j * WINDOW:(j + 1) * WINDOW])
                    lang.append(la)
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.binary()), pa.array(lang, pa.string())], names=["text", "lang"])

    got = sorted((bytes(r["text"]), r["lang"]) for r in chosen.mapInArrow(cut, "text binary, lang string").collect())
    return [x for x, _ in got], [la for _, la in got]


def windows(raws: list[bytes]) -> np.ndarray:
    """Lower-cased (A-Z) and padded with spaces to WINDOW bytes."""
    out = np.full((len(raws), WINDOW), 32, np.uint8)
    for i, r in enumerate(raws):
        out[i, :len(r)] = LOWER_AZ[np.frombuffer(r, np.uint8)]
    return out


def train(raws: list[bytes], langs: list[str], seed: int = 7) -> dict:
    """Fit the network; returns the tables that ``predict`` reads."""
    names = sorted(set(langs))
    if not names:
        return {"names": []}
    rng = np.random.default_rng(seed)
    x, y = windows(raws), np.array([names.index(v) for v in langs])
    p = {"emb": rng.normal(0, 0.5, (256, EMBED)), "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(names))), "bias": np.zeros(len(names))}
    for k in WIDTHS:
        p[f"w{k}"] = rng.normal(0, (k * EMBED) ** -0.5, (k * EMBED, FILTERS))
        p[f"b{k}"] = np.zeros(FILTERS)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m1, m2, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            at = order[lo:lo + BATCH]
            xb, n = x[at], len(at)
            e = p["emb"][xb]
            feats, where = [], []
            for k in WIDTHS:
                cols = np.concatenate([e[:, j:WINDOW - k + 1 + j] for j in range(k)], axis=2)
                z = cols @ p[f"w{k}"] + p[f"b{k}"]
                top = z.argmax(1)
                where.append((cols, top))
                feats.append(np.maximum(np.take_along_axis(z, top[:, None], 1)[:, 0], 0))
            f = np.concatenate(feats, 1)
            s = f @ p["out"] + p["bias"]
            s = np.exp(s - s.max(1, keepdims=True))
            d = s / s.sum(1, keepdims=True)
            d[np.arange(n), y[at]] -= 1
            d /= n
            g = {"out": f.T @ d, "bias": d.sum(0), "emb": np.zeros_like(p["emb"])}
            df = (d @ p["out"].T) * (f > 0)
            for i, k in enumerate(WIDTHS):
                cols, top = where[i]
                dk = df[:, i * FILTERS:(i + 1) * FILTERS]
                picked = cols[np.arange(n)[:, None], top]  # (n, FILTERS, k*EMBED)
                g[f"w{k}"] = np.einsum("nfc,nf->cf", picked, dk)
                g[f"b{k}"] = dk.sum(0)
                back = np.einsum("nf,cf->nfc", dk, p[f"w{k}"]).reshape(n, FILTERS, k, EMBED)
                byte = xb[np.arange(n)[:, None, None], top[:, :, None] + np.arange(k)]
                np.add.at(g["emb"], byte, back)
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for key in p:
                m1[key] = 0.9 * m1[key] + 0.1 * g[key]
                m2[key] = 0.999 * m2[key] + 0.001 * g[key] ** 2
                p[key] -= (rate * (m1[key] / (1 - 0.9 ** step)) / (np.sqrt(m2[key] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return {"names": names, **pair_tables(p), "out": p["out"], "bias": p["bias"]}


def pair_tables(p: dict) -> dict:
    """Filters as tables: ``a[pair at i]`` and ``b[pair at i+2]``."""
    byte = {(k, j): p["emb"] @ p[f"w{k}"][j * EMBED:(j + 1) * EMBED] for k in WIDTHS for j in range(k)}
    pair = lambda u, v: (u[:, None] + v[None]).reshape(65536, FILTERS)
    none = np.zeros((256, FILTERS), np.float32)
    a = [pair(byte[k, 0], byte[k, 1]) + p[f"b{k}"] for k in WIDTHS]
    b = [pair(byte[3, 2], none), pair(byte[4, 2], byte[4, 3])]
    return {"a": np.concatenate(a, 1).astype(np.float32), "b": np.concatenate(b, 1).astype(np.float32)}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Class probabilities of WINDOW-byte rows."""
    out = np.empty((len(x), len(model["names"])), np.float32)
    for lo in range(0, len(x), 64):
        w = x[lo:lo + 64].astype(np.int32)
        pairs = w[:, :-1] * 256 + w[:, 1:]
        z = model["a"].take(pairs[:, :WINDOW - 3], axis=0)
        z[:, :, FILTERS:] += model["b"].take(pairs[:, 2:], axis=0)
        f = z.max(1)
        # the last positions, which four bytes no longer fit into
        tail = model["a"].take(pairs[:, WINDOW - 3:], axis=0)[:, :, :FILTERS].max(1)
        f[:, :FILTERS] = np.maximum(f[:, :FILTERS], tail)
        last3 = model["a"].take(pairs[:, WINDOW - 3], axis=0)[:, FILTERS:2 * FILTERS] + model["b"].take(w[:, -1] * 256, axis=0)[:, :FILTERS]
        f[:, FILTERS:2 * FILTERS] = np.maximum(f[:, FILTERS:2 * FILTERS], last3)
        s = np.maximum(f, 0) @ model["out"] + model["bias"]
        s = np.exp(s - s.max(1, keepdims=True))
        out[lo:lo + 64] = s / s.sum(1, keepdims=True)
    return out


def predict_texts(model: dict, t: Texts) -> tuple[list[str], np.ndarray]:
    size = np.diff(t.off)
    names, score = ["und"] * len(t), np.zeros(len(t))
    letters = np.concatenate([[0], np.cumsum(LETTER[t.buf])])
    has = letters[t.off[1:]] > letters[t.off[:-1]]
    for i in np.flatnonzero(~has & (size > 0)):  # no ASCII letter: ask Unicode
        has[i] = any(c.isalpha() for c in t.buf[t.off[i]:t.off[i + 1]].tobytes().decode("utf-8", "replace") if c != "�")
    todo = np.flatnonzero(has) if model["names"] else np.empty(0, np.int64)
    for doc in np.array_split(todo, max(1, int(size[todo].sum()) >> 20)):
        n = -(-size[doc] // WINDOW)
        first = np.concatenate([[0], np.cumsum(n)])
        flat = np.full(int(first[-1]) * WINDOW, 32, np.uint8)
        for i, d in enumerate(doc):
            flat[first[i] * WINDOW:first[i] * WINDOW + size[d]] = t.buf[t.off[d]:t.off[d + 1]]
        if not len(doc):
            continue
        p = predict(model, LOWER_AZ[flat].reshape(-1, WINDOW))
        weight = np.full(int(first[-1]), float(WINDOW))
        weight[first[1:] - 1] = size[doc] - (n - 1) * WINDOW
        mean = np.add.reduceat(p * weight[:, None], first[:-1], axis=0) / size[doc][:, None]
        best = mean.argmax(1)
        for i, d in enumerate(doc):
            names[d] = model["names"][best[i]]
            score[d] = min(1.0, float(mean[i, best[i]]))
    return names, score


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def score(batches):
        for b in batches:
            names, s = predict_texts(model, Texts.of(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(s)], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double")


def fit(labelled: DataFrame) -> dict:
    return train(*training_windows(labelled))
