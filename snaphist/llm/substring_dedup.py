"""Substring deduplication with suffix automata of reference shards.

A reference shard holds the stretches of earlier texts that other texts may
share (see ``passages``); its suffix automaton is built word by word, smallest
document id first, so every state knows the first document that has its
strings. Texts are streamed through it for matching statistics: the state
after each word gives the longest match that ends there, and from
``min_words`` words on the state of exactly that length names the earliest
owner. Words covered by such a match with a smaller owner are removed, which
takes out maximal spans above the threshold.

A shard is sent only what shares an anchor with it, rather than broadcast to
every text: streaming each text past all shards would cost the square of the
input. Shards are cut to a bounded size.

Defined results: NULL and empty texts have no words; a repeated id is never
smaller than itself, so its rows don't remove each other; a NULL id is larger
than all; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from snaphist.llm.blocks import BLOCK_BYTES
from snaphist.llm.passages import Tokens, remove_repeats
from snaphist.llm.tokens import Texts

MIN_WORDS, GRAM = 13, 5


class SuffixAutomaton:
    """Of several texts; ``owner`` is the first text's label per state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [-1]

    def add(self, tokens: list, label: int) -> None:
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        last = 0
        for c in tokens:
            p = last
            q = nxt[p].get(c)
            if q is not None:  # another text has this already
                if length[q] == length[p] + 1:
                    last = q
                else:
                    last = self._split(p, q, c)
                continue
            last = len(nxt)
            nxt.append({})
            length.append(length[p] + 1)
            owner.append(label)
            link.append(0)
            while p >= 0:
                q = nxt[p].get(c)
                if q is not None:
                    break
                nxt[p][c] = last
                p = link[p]
            if p >= 0:
                link[last] = q if length[q] == length[p] + 1 else self._split(p, q, c)

    def _split(self, p: int, q: int, c) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.owner.append(self.owner[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def matches(self, tokens: list, least: int):
        """For each end of a match of ``least`` tokens or more: (end, owner of
        those last ``least`` tokens)."""
        nxt, link, length, owner = self.next, self.link, self.length, self.owner
        v = size = 0
        for i, c in enumerate(tokens, 1):
            while v and c not in nxt[v]:
                v = link[v]
                size = length[v]
            q = nxt[v].get(c)
            if q is None:
                continue
            v, size = q, size + 1
            while length[link[v]] >= least:
                v = link[v]
                size = length[v]
            if size >= least:
                yield i, owner[v]


def match_words(least: int):
    """Owners of every window, by one automaton for the stretches given."""
    def match(contents: list[bytes], ids: np.ndarray, windows: np.ndarray) -> list[np.ndarray]:
        automaton, texts = SuffixAutomaton(), [x.split() for x in contents]
        for i, words in zip(ids.tolist(), texts):
            automaton.add(words, i)
        out = []
        for words, n in zip(texts, windows.tolist()):
            owners = np.empty(n, np.int64)
            for end, owner in automaton.matches(words, least):
                owners[end - least] = owner
            out.append(owners)
        return out
    return match


def cleaned(t: Texts, tokens, gone: np.ndarray, keep_space: bool) -> list[bytes]:
    """Each text without the words ``gone``: the rest joined by one space, or
    with the white space that followed each kept word."""
    first, start, end, _ = tokens
    kept = np.flatnonzero(~gone)
    text_of = np.searchsorted(first, kept, "right") - 1
    last = np.append(text_of[1:] != text_of[:-1], True) if kept.size else np.empty(0, bool)
    if keep_space:
        to = np.append(start[1:], t.buf.size)[kept] if kept.size else kept
        to = np.minimum(to, t.off[1:][text_of])
        to = np.where(last, np.minimum(to, np.where(kept + 1 == first[1:][text_of], to, end[kept])), to)
        mark = np.zeros(t.buf.size + 1, np.int32)
        head = np.flatnonzero(np.diff(np.append(-1, text_of))) if kept.size else kept
        begin = start[kept].copy()
        lead = kept[head] == first[text_of[head]]  # white space before a text's first word
        begin[head[lead]] = t.off[text_of[head][lead]]
        np.add.at(mark, begin, 1)
        np.add.at(mark, to, -1)
        buf, on = t.buf, np.cumsum(mark[:-1]) > 0
    else:
        mark = np.zeros(t.buf.size + 1, np.int32)
        np.add.at(mark, start[kept], 1)
        np.add.at(mark, np.where(last, end[kept], end[kept] + 1), -1)
        on = np.cumsum(mark[:-1]) > 0
        buf = t.buf.copy()
        buf[end[kept[~last]]] = 32
    at = np.append(0, np.cumsum(on))[t.off]
    raw = buf[on].tobytes()
    return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def dedup_substrings(docs: DataFrame, *, min_words: int = MIN_WORDS, keep: tuple[str, ...] = (), keep_space: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, text (what is left) and ``keep`` of every
    document. With ``keep_space`` a text that loses nothing stays as it was,
    and the others keep the white space behind the words that stay."""
    names = [c for c in keep if c not in ("doc_id", "text")]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema]

    def finish(table: pa.Table, t: Texts, tokens, gone: np.ndarray) -> pa.Table:
        first = tokens[0]
        removed = np.diff(np.append(0, np.cumsum(gone))[first]).astype(np.int64)
        left = pa.array(cleaned(t, tokens, gone, keep_space), pa.binary()).cast(pa.string())
        if keep_space:
            left = pc.if_else(pa.array(removed == 0), table["text"].combine_chunks(), left)
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(np.diff(first)), "n_removed": pa.array(removed), "text": left,
                         **{c: table[c] for c in names}})

    how = Tokens("words", min_words, min(GRAM, min_words))
    schema = ", ".join(["doc_id long, n_words long, n_removed long, text string", *kept])
    return remove_repeats(docs, how, match_words(min_words), finish, schema, tuple(names), block_bytes)
