"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def crc(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def sha(data):
    return hashlib.sha256(data).hexdigest()


def removed_tokens(docs, L, split):
    """doc_id -> (tokens, flags): covered by a window that a smaller id has."""
    first = {}
    cut = {i: split(t) for i, t in docs}
    for i, toks in cut.items():
        for j in range(len(toks) - L + 1):
            k = tuple(toks[j:j + L]) if not isinstance(toks, bytes) else toks[j:j + L]
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, toks in cut.items():
        gone = [False] * len(toks)
        for j in range(len(toks) - L + 1):
            k = tuple(toks[j:j + L]) if not isinstance(toks, bytes) else toks[j:j + L]
            if first[k] < i:
                gone[j:j + L] = [True] * L
        out[i] = (toks, gone)
    return out


def substring_dedup(docs, L=13):
    rows = []
    for i, (toks, gone) in removed_tokens(docs, L, words).items():
        left = " ".join(w for w, g in zip(toks, gone) if not g)
        rows.append((i, len(toks), sum(gone), sha(left.encode())))
    return sorted(rows)


def byte_dedup(docs, L=50):
    rows = []
    for i, (raw, gone) in removed_tokens(docs, L, lambda t: (t or "").encode()).items():
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        rows.append((i, len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone) if not g))))
    return sorted(rows)
