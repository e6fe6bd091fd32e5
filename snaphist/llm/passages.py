"""Windows of tokens that an earlier document already has.

Shared ground of the two substring deduplicators; what differs (how equal
windows are found among candidate stretches) is passed in as ``match``.

Tokens are words or bytes. The minimum of the k-gram hashes within a window
of L tokens names the window's anchor; equal windows have equal anchors, and a
stretch is a maximal run of windows of one text with the same anchor. So

1. blocks ask which anchors more than one document has (one packed entry per
   block and anchor);
2. for those, blocks send their distinct stretches, with the smallest id that
   has each, to the anchor's bucket. An anchor with many different stretches
   (the edge of a passage that a third of all texts hold) is split: its
   windows are sent one by one, by their own hash, where equal ones collapse;
3. the bucket finds, for every window of every stretch, the smallest id of any
   text that has that window (``match``), and answers in runs;
4. blocks mark the tokens covered by windows whose owner is smaller.

All steps see whole texts; nothing is capped. The text is shuffled once, and
that exchange serves steps 1, 2 and 4. A bucket's work is cut at anchor
boundaries into pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snaphist.llm.blocks import BLOCK_BYTES, block_count, by_bucket, runs, sorted_block, with_block
from snaphist.llm.tokens import BYTE_CODE, Texts, every_span, fits, mix, planes, powers, prefix_hash, ROOT, ROOT_INV, sliding_min, span_hash, unplanes, words

HOT = 256  # different stretches of an anchor, beyond one per block, from which its windows go one by one
U64 = np.uint64
#: match(contents, ids) -> owners: for each stretch, the smallest id for each of its windows
Match = Callable[[list[bytes], np.ndarray, np.ndarray], list[np.ndarray]]


@dataclass(frozen=True)
class Tokens:
    """How texts are cut: L tokens a window, k tokens an anchor gram."""
    kind: str  # "words" or "bytes"
    window: int
    gram: int


@dataclass
class Stretches:
    anchor: np.ndarray
    content: np.ndarray  # hash of the stretch's tokens
    doc: np.ndarray
    token: np.ndarray  # first token
    windows: np.ndarray  # how many windows
    byte: np.ndarray  # first byte
    end: np.ndarray  # byte behind it


def token_table(t: Texts, kind: str):
    """(first token of each text and one more, byte start, byte end) and the
    words' hashes; bytes are their own tokens."""
    if kind == "bytes":
        return t.off, None, None, None
    w = words(t)
    return w.first, w.start, w.end, w.hash


def stretches(t: Texts, how: Tokens, table=None) -> Stretches:
    """All maximal runs of windows with one anchor, text by text."""
    L, k = how.window, how.gram
    first, start, end, wh = table or token_table(t, how.kind)
    parts: list[tuple] = []
    step = 1 << 17
    n_docs = len(t)
    at = 0
    while at < n_docs:
        to = max(at + 1, int(np.searchsorted(first, first[at] + step, "right")) - 1)
        to = min(to, n_docs)
        lo, hi = int(first[at]), int(first[to])
        if hi - lo >= L:
            h = BYTE_CODE[t.buf[lo:hi]] if wh is None else wh[lo:hi]
            p, inv = _prefix(h)
            m = sliding_min(every_span(p, inv, k), L - k + 1)
            ok = fits(first[at:to + 1] - lo, L)
            doc = np.repeat(np.arange(to - at), np.diff(first[at:to + 1]))[ok]
            a = m[ok]
            new = np.ones(ok.size, bool)
            new[1:] = (a[1:] != a[:-1]) | (ok[1:] != ok[:-1] + 1) | (doc[1:] != doc[:-1])
            s = np.flatnonzero(new)
            n = np.diff(np.append(s, ok.size))
            tok = ok[s]
            parts.append((a[s], span_hash(p, inv, tok, tok + n + L - 1), doc[s] + at, tok + lo, n))
        at = to
    cols = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, U64), np.empty(0, U64), *[np.empty(0, np.int64)] * 3]
    a, c, d, tok, n = cols
    last = tok + n + L - 2
    return Stretches(a, c, d, tok, n, tok if start is None else start[tok], last + 1 if end is None else end[last])


def _prefix(h: np.ndarray):
    if h.size <= 1 << 18:
        return prefix_hash(h)
    p = np.zeros(h.size + 1, U64)
    np.cumsum(h * powers(ROOT, h.size), out=p[1:])
    return p, powers(ROOT_INV, h.size + 1)


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (a, b): positions of one of each, ascending by a, and the
    number of the pair of every row."""
    order = np.argsort(a)  # then by b where an ``a`` occurs again
    sa = a[order]
    same = np.append(False, sa[1:] == sa[:-1])
    same[:-1] |= same[1:]
    again = np.flatnonzero(same)
    if again.size:
        order[again] = order[again[np.lexsort((b[order[again]], sa[again]))]]
    sb = b[order]
    new = np.append(True, (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])) if a.size else np.empty(0, bool)
    number = np.empty(a.size, np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number, order


def anchors_of(s: Stretches, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors, ascending; whether two documents have one, as 32768,
    plus the number of its different stretches (to 32767)."""
    one, number, _ = _pairs(s.anchor, s.content)
    a = s.anchor[one]
    starts, run = runs(a)
    distinct = a[starts]
    of = run[number] if number.size else number
    contents = np.minimum(np.bincount(run, minlength=starts.size), 32767)
    low = np.full(starts.size, np.iinfo(np.int64).max)
    high = np.full(starts.size, np.iinfo(np.int64).min)
    np.minimum.at(low, of, ids[s.doc])
    np.maximum.at(high, of, ids[s.doc])
    return distinct, np.where(low < high, 32768, 0) + contents, of


@dataclass
class Units:
    """Distinct stretches (or single windows of hot anchors) of a block."""
    key: np.ndarray
    content: np.ndarray
    id: np.ndarray  # smallest document id
    windows: np.ndarray
    byte: np.ndarray
    end: np.ndarray
    number: np.ndarray  # of every occurrence below, its unit
    at: np.ndarray  # first token of every occurrence
    doc: np.ndarray


def units_of(s: Stretches, codes: np.ndarray, of: np.ndarray, t: Texts, how: Tokens, table, ids: np.ndarray) -> Units:
    code = codes[of] if of.size else of
    cold, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
    key, content = [s.anchor[cold]], [s.content[cold]]
    tok, n, doc = [s.token[cold]], [s.windows[cold]], [s.doc[cold]]
    if hot.size:
        reps = s.windows[hot]
        at = np.repeat(s.token[hot] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        h = _window_hash(t, how, table, at)
        key.append(mix(h ^ U64(0xA5A5A5A5A5A5A5A5)))
        content.append(h)
        tok.append(at)
        n.append(np.ones(at.size, np.int64))
        doc.append(np.repeat(s.doc[hot], reps))
    key, content, tok, n, doc = (np.concatenate(x) for x in (key, content, tok, n, doc))
    one, number, order = _pairs(key, content)
    low = np.full(one.size, np.iinfo(np.int64).max)
    np.minimum.at(low, number, ids[doc])
    _, start, end, _ = table
    b = tok[one] if start is None else start[tok[one]]
    last = tok[one] + n[one] + how.window - 2
    e = last + 1 if end is None else end[last]
    return Units(key[one], content[one], low, n[one], b, e, number, tok, doc)


def _window_hash(t: Texts, how: Tokens, table, at: np.ndarray) -> np.ndarray:
    h = np.zeros(at.size, U64)
    wh = table[3]
    for j in range(how.window):
        h *= ROOT
        h += BYTE_CODE[t.buf[at + j]] if wh is None else wh[at + j]
    return mix(h)


def squeeze(buf: np.ndarray) -> bytes:
    """Texts are most of what a bucket is sent; they shrink further than the
    shuffle's own fast compression takes them."""
    return pa.compress(np.ascontiguousarray(buf).data, codec="zstd", asbytes=True) if buf.size else b""


def unsqueeze(raw: bytes, size: int) -> bytes:
    return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _bytes(arr) -> pa.Array:
    return pa.array(arr, pa.binary())


def _ask_anchors(how: Tokens, n: int):
    def run(key, table):
        table, ids = sorted_block(table)
        t = Texts.of(table["text"])
        a, code, _ = anchors_of(stretches(t, how), ids)
        rows = [(b, at.size, planes(a[at], 6), planes(code[at], 2)) for b, at in by_bucket(a, n)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "n": pa.array([r[1] for r in rows], pa.int32()), "a": _bytes([r[2] for r in rows]), "c": _bytes([r[3] for r in rows])})
    return run


def _answer_anchors(key, table):
    """0: one document; 1: more; 2: more, and its windows go one by one."""
    table = table.combine_chunks()
    size = table["n"].to_numpy()
    a = np.concatenate([unplanes(x.as_py(), n, 6) for x, n in zip(table["a"], size)])
    code = np.concatenate([unplanes(x.as_py(), n, 2) for x, n in zip(table["c"], size)]).astype(np.int64)
    order = np.argsort(a, kind="stable")
    starts, run = runs(a[order])
    c = code[order]
    blocks = np.bincount(run, minlength=starts.size)
    many = (blocks > 1) | (np.bincount(run, weights=c >= 32768, minlength=starts.size) > 0)
    extra = np.bincount(run, weights=(c % 32768) - 1, minlength=starts.size)
    verdict = np.where(many, np.where(extra > HOT, 2, 1), 0).astype(np.uint8)
    out = np.empty(a.size, np.uint8)
    out[order] = verdict[run]
    cuts = np.append(0, np.cumsum(size))
    return pa.table({"block": table["block"], "bucket": pa.array([key[0].as_py()] * table.num_rows, pa.int32()),
                     "kind": pa.array([0] * table.num_rows, pa.int32()), "n": table["n"], "a": _bytes([out[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])]), "b": _bytes([b""] * table.num_rows), "c": _bytes([b""] * table.num_rows)})


ANSWER = "block int, bucket int, kind int, n int, a binary, b binary, c binary"


def _codes(answers: pa.Table, a: np.ndarray, n: int) -> np.ndarray:
    """Answers to ``_ask_anchors``, in the order of the distinct anchors."""
    got = {b: x for b, x, kind in zip(answers["bucket"].to_pylist(), answers["a"].to_pylist(), answers["kind"].to_pylist()) if kind == 0}
    out = np.zeros(a.size, np.int64)
    for b, at in by_bucket(a, n):
        out[at] = np.frombuffer(got[b], np.uint8)
    return out


def _block_units(docs: pa.Table, answers: pa.Table, how: Tokens, n: int):
    table, ids = sorted_block(docs)
    t = Texts.of(table["text"])
    tokens = token_table(t, how.kind)
    s = stretches(t, how, tokens)
    a, _, of = anchors_of(s, ids)
    return table, ids, t, tokens, units_of(s, _codes(answers, a, n), of, t, how, tokens, ids)


def _ask_units(how: Tokens, n: int):
    def run(key, docs, answers):
        rows = []
        if docs.num_rows:
            _, _, t, _, u = _block_units(docs, answers, how, n)
            for b, at in by_bucket(u.key, n):
                size = u.end[at] - u.byte[at]
                pick = np.repeat(u.byte[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                rows.append((b, at.size, planes(u.key[at], 6), u.content[at].tobytes(), planes(u.id[at], 8), planes(size, 4) + planes(u.windows[at], 4), squeeze(t.buf[pick])))
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()), "n": pa.array([r[1] for r in rows], pa.int32()),
                         **{c: _bytes([r[i] for r in rows]) for i, c in enumerate(("k", "h", "d", "s", "x"), 2)}})
    return run


UNIT = "bucket int, block int, n int, k binary, h binary, d binary, s binary, x binary"


def _answer_units(match: Match):
    def run(key, table):
        table = table.combine_chunks()
        size = table["n"].to_numpy()
        k = np.concatenate([unplanes(x.as_py(), n, 6) for x, n in zip(table["k"], size)])
        h = np.concatenate([np.frombuffer(x.as_py(), U64) for x in table["h"]])
        d = np.concatenate([unplanes(x.as_py(), n, 8) for x, n in zip(table["d"], size)]).astype(np.int64)
        s = np.concatenate([unplanes(x.as_py()[:4 * n], n, 4) for x, n in zip(table["s"], size)]).astype(np.int64)
        w = np.concatenate([unplanes(x.as_py()[4 * n:], n, 4) for x, n in zip(table["s"], size)]).astype(np.int64)
        cuts = np.append(0, np.cumsum(size))
        texts = [unsqueeze(x.as_py(), int(s[a:b].sum())) for x, a, b in zip(table["x"], cuts[:-1], cuts[1:])]
        first = np.concatenate([np.concatenate([[0], np.cumsum(s[a:b])[:-1]]) for a, b in zip(cuts[:-1], cuts[1:])]) if size.size else np.empty(0, np.int64)
        source = np.repeat(np.arange(size.size), size)
        one, number, _ = _pairs(k, h)
        low = np.full(one.size, np.iinfo(np.int64).max)
        np.minimum.at(low, number, d)
        owners = owners_of(k[one], low, w[one], lambda i: texts[source[one[i]]][first[one[i]]:first[one[i]] + s[one[i]]], match)
        # runs of equal owners, per distinct stretch and then per question
        n_runs = np.array([x[0].size for x in owners], np.int64) if owners else np.empty(0, np.int64)
        run_at = np.append(0, np.cumsum(n_runs))
        run_n = np.concatenate([x[0] for x in owners]) if owners else np.empty(0, np.int64)
        run_id = np.concatenate([x[1] for x in owners]) if owners else np.empty(0, np.int64)
        a_col, b_col, c_col = [], [], []
        for x, y in zip(cuts[:-1], cuts[1:]):
            num = number[x:y]
            r = n_runs[num]
            pick = np.repeat(run_at[num] - np.concatenate([[0], np.cumsum(r)[:-1]]), r) + np.arange(r.sum())
            a_col.append(planes(r, 4))
            b_col.append(planes(run_n[pick], 4))
            c_col.append(planes(run_id[pick], 8))
        return pa.table({"block": table["block"], "bucket": pa.array([key[0].as_py()] * table.num_rows, pa.int32()), "kind": pa.array([1] * table.num_rows, pa.int32()),
                         "n": table["n"], "a": _bytes(a_col), "b": _bytes(b_col), "c": _bytes(c_col)})
    return run


def owners_of(key: np.ndarray, low: np.ndarray, windows: np.ndarray, content, match: Match, piece: int = 1 << 16) -> list[tuple[np.ndarray, np.ndarray]]:
    """(run lengths, owner ids) for each distinct stretch, ``key`` ascending.
    An anchor's only stretch is its own reference, so its copies match it in
    full; the others go to ``match`` in pieces of whole anchors, smallest id
    first."""
    out: list = [(windows[i:i + 1], low[i:i + 1]) for i in range(key.size)]
    starts, run = runs(key)
    count = np.diff(np.append(starts, key.size))
    several = np.flatnonzero(count > 1)
    batch: list[int] = []
    load = 0

    def done():
        order = sorted(batch, key=lambda i: low[i])
        got = match([content(i) for i in order], low[order], windows[order])
        flat, size = np.concatenate(got), windows[order]
        new = np.append(True, flat[1:] != flat[:-1])
        new[np.cumsum(size) - size] = True  # a run ends with its stretch
        b = np.flatnonzero(new)
        length, ids = np.diff(np.append(b, flat.size)), flat[b]
        upto = np.cumsum(np.bincount(np.repeat(np.arange(size.size), size)[b], minlength=size.size)).tolist()
        for i, x, y in zip(order, [0, *upto], upto):
            out[i] = (length[x:y], ids[x:y])

    for r in several:
        batch += range(starts[r], starts[r] + count[r])
        load += int(count[r])
        if load >= piece // 16:
            done()
            batch, load = [], 0
    if batch:
        done()
    return out


def covered(u: Units, answers: pa.Table, ids: np.ndarray, n_tokens: int, how: Tokens, n: int) -> np.ndarray:
    """Tokens covered by a window that a smaller id has."""
    got = {b: (x, y, z) for b, x, y, z, kind in zip(*(answers[c].to_pylist() for c in ("bucket", "a", "b", "c", "kind"))) if kind == 1}
    n_runs = np.zeros(u.key.size, np.int64)
    parts, start, at0 = [], np.zeros(u.key.size, np.int64), 0
    for b, at in by_bucket(u.key, n):
        x, y, z = got[b]
        r = unplanes(x, at.size, 4).astype(np.int64)
        n_runs[at] = r
        start[at] = at0 + np.concatenate([[0], np.cumsum(r)[:-1]])
        total = int(r.sum())
        parts.append((unplanes(y, total, 4).astype(np.int64), unplanes(z, total, 8).astype(np.int64)))
        at0 += total
    cover = np.zeros(n_tokens + 1, np.int32)
    if parts:
        length, owner = (np.concatenate(c) for c in zip(*parts))
        before = np.concatenate([[0], np.cumsum(length)])
        r = n_runs[u.number]
        pick = np.repeat(start[u.number] - np.concatenate([[0], np.cumsum(r)[:-1]]), r) + np.arange(r.sum())
        occurrence = np.repeat(np.arange(u.number.size), r)
        hit = owner[pick] < ids[u.doc[occurrence]]
        pick, occurrence = pick[hit], occurrence[hit]
        a = u.at[occurrence] + before[pick] - before[start[u.number[occurrence]]]
        np.add.at(cover, a, 1)
        np.add.at(cover, a + length[pick] + how.window - 1, -1)
    return np.cumsum(cover[:-1]) > 0


def remove_repeats(docs: DataFrame, how: Tokens, match: Match, finish, schema: str, keep: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``finish(table, texts, token table, covered tokens)`` of every block
    gives the rows of ``schema``; its table has doc_id, text and ``keep``."""
    n = block_count(docs, block_bytes=block_bytes)
    blocks = with_block(docs, n, keep)
    by_block = blocks.groupBy("block")
    anchors = by_block.applyInArrow(_ask_anchors(how, n), "bucket int, block int, n int, a binary, c binary") \
        .groupBy("bucket").applyInArrow(_answer_anchors, ANSWER)
    units = by_block.cogroup(anchors.groupBy("block")).applyInArrow(_ask_units(how, n), UNIT) \
        .groupBy("bucket").applyInArrow(_answer_units(match), ANSWER)

    def end(key, rows, answers):
        table, ids, t, tokens, u = _block_units(rows, answers, how, n)
        return finish(table, t, tokens, covered(u, answers, ids, int(tokens[0][-1]), how, n))

    return by_block.cogroup(anchors.unionByName(units).groupBy("block")).applyInArrow(end, schema)
