"""Vectorised word and n-gram hashing over a concatenated run of texts.

A ``Texts`` is one contiguous UTF-8 buffer plus document offsets, which is the
layout Arrow already has, so no per-row Python strings are made. Hashes are
64-bit; n-gram hashes mix the hashes of their words in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
STEP = 1 << 18  # bytes hashed at a time, so that temporaries stay in cache

_rng = np.random.default_rng(20240611)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
ROOT = U64(0x9E3779B97F4A7C15)
ROOT_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(31))
    x *= U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x *= U64(0x81DADEF4BC2DD44D)
    x ^= x >> U64(33)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[:1] = 1
    size = 1
    while size < n:  # base^(size+i) = base^size * base^i
        more = min(size, n - size)
        step = U64(int(out[size - 1]) * int(base) % (1 << 64))
        out[size:size + more] = out[:more] * step
        size += more
    return out


_POW, _INV = powers(ROOT, STEP + 1), powers(ROOT_INV, STEP + 1)


def prefix_hash(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums P with P[e]-P[s] = hash of codes[s:e] times ROOT^s, and
    the factors that take ROOT^s away."""
    n = codes.size
    pw, inv = (_POW, _INV) if n <= STEP else (powers(ROOT, n + 1), powers(ROOT_INV, n + 1))
    p = np.zeros(n + 1, U64)
    np.cumsum(codes * pw[:n], out=p[1:])
    return p, inv


def span_hash(p: np.ndarray, inv: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(((p[end] - p[start]) * inv[start]) ^ (end - start).astype(U64))


def every_span(p: np.ndarray, inv: np.ndarray, k: int) -> np.ndarray:
    """``span_hash`` of the k codes at each position."""
    x = p[k:] - p[:-k]
    x *= inv[:x.size]
    x ^= U64(k)
    return mix(x)


@dataclass
class Texts:
    buf: np.ndarray  # uint8
    off: np.ndarray  # int64, one more than there are documents

    @classmethod
    def of(cls, column, lower: bool = False) -> "Texts":
        col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
        col = col.cast(pa.large_binary()).fill_null(b"")
        n = len(col)
        bufs = col.buffers()
        off = np.frombuffer(bufs[1], np.int64, n + 1, col.offset * 8).copy() if n else np.zeros(1, np.int64)
        raw = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.empty(0, np.uint8)
        raw = raw[off[0]:off[-1]]
        off -= off[0]
        return cls(LOWER_AZ[raw] if lower else raw, off)

    def __len__(self) -> int:
        return self.off.size - 1

    def part(self, a: int, b: int) -> "Texts":
        return Texts(self.buf[self.off[a]:self.off[b]], self.off[a:b + 1] - self.off[a])

    def parts(self, size: int = STEP):
        """(first document, last document) ranges of about ``size`` bytes."""
        at, n = 0, len(self)
        while at < n:
            to = max(at + 1, int(np.searchsorted(self.off, self.off[at] + size, "right")) - 1)
            yield at, min(to, n)
            at = to


@dataclass
class Words:
    start: np.ndarray  # byte positions in the buffer
    end: np.ndarray
    first: np.ndarray  # word index of each document's first word, and one more
    hash: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.first.size - 1), np.diff(self.first))


def words(t: Texts) -> Words:
    starts, ends, hashes, count = [], [], [], [np.zeros(1, np.int64)]
    total = 0
    for a, b in t.parts():
        lo, hi = int(t.off[a]), int(t.off[b])
        buf = t.buf[lo:hi]
        inside = IS_WORD[buf]
        cut = (t.off[a:b] - lo)
        cut = cut[cut < buf.size]
        s = inside.copy()
        s[1:] &= ~inside[:-1]
        s[cut] = inside[cut]
        e = inside.copy()
        e[:-1] &= ~inside[1:]
        last = cut[cut > 0] - 1
        e[last] = inside[last]
        s, e = np.flatnonzero(s), np.flatnonzero(e) + 1
        p, inv = prefix_hash(BYTE_CODE[buf])
        hashes.append(span_hash(p, inv, s, e))
        starts.append(s + lo)
        ends.append(e + lo)
        count.append(total + np.searchsorted(s, t.off[a + 1:b + 1] - lo, "left"))
        total += s.size
    cat = lambda xs, kind: np.concatenate(xs) if xs else np.empty(0, kind)
    return Words(cat(starts, np.int64), cat(ends, np.int64), np.concatenate(count), cat(hashes, U64))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k tokens that start at each position (across documents;
    callers drop those that don't fit into one)."""
    n = h.size - k + 1
    if n <= 0:
        return np.empty(0, U64)
    a = h[:n].copy()
    for j in range(1, k):
        a *= ROOT
        a += h[j:j + n]
    return mix(a)


def fits(first: np.ndarray, k: int) -> np.ndarray:
    """Positions at which k tokens of one document start."""
    n = int(first[-1])
    ok = np.zeros(n + 1, np.int32)
    size = np.diff(first)
    full = size >= k
    np.add.at(ok, first[:-1][full], 1)
    np.add.at(ok, (first[1:] - k + 1)[full], -1)
    return np.flatnonzero(np.cumsum(ok[:n]))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    size, m = 1, x
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:x.size - w + 1], m[w - size:w - size + x.size - w + 1]) if size < w else m


def planes(x: np.ndarray, keep: int) -> bytes:
    """The low ``keep`` bytes of each value, byte by byte: sorted or small
    values leave constant runs, which the shuffle's compression removes."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :keep].T).tobytes()


def unplanes(raw, n: int, keep: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :keep] = np.frombuffer(raw, np.uint8).reshape(keep, n).T
    return out.reshape(-1).view("<u8")
