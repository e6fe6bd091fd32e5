"""Suffix-array deduplication by merging Burrows-Wheeler transforms.

The stretches that texts may share (see ``passages``) are dealt to shards.
Each shard sorts its own suffixes once and keeps its transform: the symbol
before each suffix, and where the suffix with that symbol in front stands. The
shards are then merged by iterative refinement of their interleaving: starting
from all suffixes shard by shard, each round reads the symbols in the present
order and deals the suffixes they lead to into buckets, stably; after h rounds
the order is right to h symbols. No suffixes are compared or sorted again. A
boundary that first appears in round h has a common prefix of h - 1 symbols;
the intervals without a boundary after ``depth`` rounds are the repeated
strings, and their smallest id owns them. Suffixes that stand alone are
settled and leave the rounds.

A symbol is a pair of bytes: a text is two chains of pairs, from its first and
its second byte, so 25 rounds give strings of 50 bytes at every position.

Defined results: NULL and empty texts have no bytes; matches never cross
texts; a repeated id is never smaller than itself; a NULL id is larger than
all; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snaphist.llm.blocks import BLOCK_BYTES
from snaphist.llm.passages import Tokens, remove_repeats
from snaphist.llm.tokens import Texts

MIN_BYTES, GRAM = 50, 24
SHARDS = 4  # transforms that one piece of work is merged from


class Transform:
    """Sorted suffixes of chains of byte pairs, as a transform."""

    def __init__(self, chains: list[np.ndarray]):
        size = np.array([c.size for c in chains], np.int64)
        m = size.size
        self.end = np.cumsum(size + 1) - 1  # position of each chain's end mark
        self.begin = self.end - size
        n = int((size + 1).sum())
        text = np.empty(n, np.int64)  # end marks come first, one value each
        text[self.end] = np.arange(m)
        inner = np.ones(n, bool)
        inner[self.end] = False
        text[inner] = np.concatenate(chains).astype(np.int64) + m if m else 0
        self.order = suffix_order(text, m + 65536)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        before = self.order - 1
        starts = np.zeros(n, bool)
        starts[self.begin] = True
        self.first = starts[self.order]  # nothing stands before these
        self.symbol = np.where(self.first, 0, text[before] - m).astype(np.uint16)
        self.leads = np.where(self.first, -1, place[before])


def suffix_order(text: np.ndarray, base: int) -> np.ndarray:
    """Order of all suffixes by doubling; end marks differ, so none are equal."""
    n = text.size
    pad = np.concatenate([text, np.zeros(3, np.int64)])
    key = (pad[:n] * base + pad[1:n + 1]) * base + pad[2:n + 2]
    k = 3
    while True:
        order = np.argsort(key)  # equal keys have equal ranks, in whatever order
        sk = key[order]
        rank = np.empty(n, np.int64)
        up = np.cumsum(np.append(0, sk[1:] != sk[:-1]))[:n]
        rank[order] = up
        if not n or up[-1] == n - 1:
            return order
        later = np.zeros(n, np.int64)
        later[:max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + later
        k *= 2


def repeated_intervals(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, interval) of every suffix that shares its first ``depth``
    symbols with another; suffixes count through the shards in their order."""
    offset = np.cumsum([0, *[s.order.size for s in shards]])
    symbol = np.concatenate([s.symbol for s in shards])
    leads = np.concatenate([np.where(s.leads < 0, -1, s.leads + o) for s, o in zip(shards, offset)])
    at = np.arange(symbol.size)
    interval = np.zeros(symbol.size, np.int32)
    for _ in range(depth):
        to = leads[at]
        inside = to >= 0
        to, c, interval = to[inside], symbol[at[inside]], interval[inside]
        order = np.argsort(c, kind="stable")  # a bucket per symbol
        at, c, interval = to[order], c[order], interval[order]
        new = np.ones(at.size + 1, bool)  # boundaries; the last is the end
        new[1:-1] = (c[1:] != c[:-1]) | (interval[1:] != interval[:-1])
        alone = new[:-1] & new[1:]
        interval = np.cumsum(new[:-1], dtype=np.int32)[~alone]
        at = at[~alone]
        if not at.size:
            break
    return at, interval


def match_bytes(least: int, shards: int = SHARDS):
    """Owners of every window, by merging the transforms of some shards."""
    depth, odd = divmod(least, 2)

    def match(contents: list[bytes], ids: np.ndarray, windows: np.ndarray) -> list[np.ndarray]:
        owners = [np.full(n, i, np.int64) for i, n in zip(ids.tolist(), windows.tolist())]
        parts, where_string, where_pos = [], [], []
        for part in np.array_split(np.arange(len(contents)), min(shards, len(contents))):
            chains, of = [], []
            for j in part.tolist():
                raw = contents[j]
                for q in (0, 1):
                    chains.append(np.frombuffer(raw, ">u2", (len(raw) - q) // 2, q) if len(raw) > q + 1 else np.empty(0, ">u2"))
                    of.append((j, q))
            t = Transform(chains)
            chain = np.searchsorted(t.end, t.order)
            of = np.array(of)
            where_string.append(of[chain, 0])
            where_pos.append(of[chain, 1] + 2 * (t.order - t.begin[chain]))
            parts.append(t)
        at, interval = repeated_intervals(parts, depth)
        string, pos = np.concatenate(where_string)[at], np.concatenate(where_pos)[at]
        inside = pos < windows[string]
        string, pos, interval = string[inside], pos[inside], interval[inside]
        if odd:  # an odd length: the interval splits by the byte behind the pairs
            last = np.array([contents[j][p + least - 1] for j, p in zip(string.tolist(), pos.tolist())], np.int64)
            interval = interval.astype(np.int64) * 256 + last
        if string.size:
            _, group = np.unique(interval, return_inverse=True)
            low = np.full(group.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(low, group, ids[string])
            own = low[group]
            first = np.concatenate([[0], np.cumsum(windows)])
            flat = np.repeat(ids, windows)
            flat[first[string] + pos] = own
            owners = np.split(flat, first[1:-1])
        return owners

    return match


def dedup_bytes(docs: DataFrame, *, min_bytes: int = MIN_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left)."""
    def finish(table: pa.Table, t: Texts, tokens, gone: np.ndarray) -> pa.Table:
        total = lambda x: np.diff(np.append(0, np.cumsum(x))[t.off]).astype(np.int64)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        head = t.off[:-1][t.off[:-1] < gone.size]
        begins[head] = gone[head]
        removed = total(gone)
        size = np.diff(t.off)
        at = np.append(0, np.cumsum(size - removed)).tolist()
        raw = t.buf[~gone].tobytes()
        return pa.table({"doc_id": table["doc_id"], "n_bytes": pa.array(size), "n_removed": pa.array(removed), "n_spans": pa.array(total(begins)),
                         "kept": pa.array([raw[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary())})

    how = Tokens("bytes", min_bytes, min(GRAM, min_bytes))
    return remove_repeats(docs, how, match_bytes(min_bytes), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", (), block_bytes)
