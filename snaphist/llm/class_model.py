"""Language-model scoring with Brown class n-grams.

P(word | previous) = P(class | previous class) * P(word | class). Classes come
from exchange clustering in two steps, both for the mutual information of
adjacent classes. The first finds a start: units are moved, most frequent
first, to the class that raises it most, until a round of moves doesn't; units
are the ``FREQUENT`` most frequent words, and the other words by their ending
(``ENDINGS`` of them). The second moves every word of the training texts by
itself: in each round the blocks count the classes before and after each word,
and the word's bucket moves it to its best class. A round's moves don't see
each other, so the words take turns in ``PARTS`` rounds; a round that lowers
the mutual information is taken back, and from then on it takes twice as many.
Rounds go on until no word moves or one raises it by less than ``LEAST`` of
it. Only words that no training text has get the class of their ending. The end of a text is a class of its own, and
the context of a first word. Transitions are smoothed towards the classes'
shares; a word emits with (c + 0.5) / (N_class + 0.5 (V_class + 1)), where one
unknown word per class has count 0, so each class's words add up to 1.

The texts are read and shuffled once, into blocks that keep them coded: their
distinct words and, of each text, the words' numbers. Counts, units, rounds and
scores work on these. Counts cover all training texts: blocks send each distinct word once, with its
count, to the word's bucket, which adds them up and answers; no table of words
is broadcast or collected. The driver holds the frequent units, one matrix of
unit pairs and one of class pairs, all of fixed size.

Defined results: NULL and empty texts consist of their end; without training
texts N is 0 and every token unknown; rows with equal ids are separate; a NULL
id is a training row; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.llm.blocks import block_count, by_bucket, sorted_block, with_block
from snaphist.llm.lineage import cut, cut_as_dealt, release
from snaphist.llm.passages import squeeze, unsqueeze
from snaphist.llm.tokens import Texts, Words, mix, planes, unplanes, words

FREQUENT, ENDINGS, CLASSES = 768, 255, 48
UNITS = FREQUENT + ENDINGS + 1  # the last is the end of a text
END = UNITS - 1
SLICES = 16
K = CLASSES + 1
PARTS, LEAST = 2, 1e-3
TABLED = 32  # gains of so many occurrences at most are looked up
TEXT_BYTES = 8 << 20  # of a block: larger ones share more words
BLOCKS_A_BUCKET = 4
U64 = np.uint64


def endings(t: Texts, w: Words) -> np.ndarray:
    """Number of each word's ending: a hash of its last two bytes."""
    last = t.buf[w.end - 1].astype(np.uint32)
    before = np.where(w.end - w.start > 1, t.buf[np.maximum(w.end - 2, 0)], 0).astype(np.uint32)
    return (((last << 8 | before) * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(ENDINGS)).astype(np.int64)


def unit_of(h: np.ndarray, ending: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """``frequent``: ascending (48-bit) hashes of the frequent words."""
    if not frequent.size:
        return FREQUENT + ending
    low = h & U64((1 << 48) - 1)
    at = np.minimum(np.searchsorted(frequent, low), frequent.size - 1)
    return np.where(frequent[at] == low, at, FREQUENT + ending)


CODED = "block int, n long, size long, held_size long, trained long, h binary, ending binary, seq binary, held binary, ids array<bigint>, tokens array<int>"
LOW = U64((1 << 48) - 1)


def _order(h: np.ndarray, n: int) -> np.ndarray:
    """The words' places (ascending hashes), bucket by bucket."""
    return np.concatenate([np.empty(0, np.int64), *(at for _, at in by_bucket(h, n))])


def _code(n: int):
    """A block without its texts: its distinct words, bucket by bucket, with
    their endings, the ids and tokens of its documents (the ``trained`` ones
    first), and their texts as sequences of word numbers (the one after the
    last: an end), apart for training (``seq``) and held-out ones."""
    def run(key, table):
        table, _ = sorted_block(table)
        train = table["train"].to_numpy(zero_copy_only=False)
        table = table.take(pa.array(np.argsort(~train, kind="stable")))
        t = Texts.of(table["text"], lower=True)
        w = words(t)
        h, at, number = np.unique(w.hash, return_index=True, return_inverse=True)
        order = _order(h, n)
        place = np.empty(h.size, np.int32)
        place[order] = np.arange(h.size)
        seq, first = with_ends(w, lambda _: place[number], h.size)
        trained = int(train.sum())
        size = int(first[trained])
        ending = endings(t, Words(w.start[at], w.end[at], w.first, h))
        parts = [squeeze(x.astype(np.int32).view(np.uint8)) for x in (seq[:size], seq[size:])]
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "n": [h.size], "size": [size], "held_size": [seq.size - size], "trained": [trained],
                         "h": pa.array([_pack(h[order], 8)], pa.binary()), "ending": pa.array([_pack(ending[order], 1)], pa.binary()),
                         "seq": pa.array(parts[:1], pa.binary()), "held": pa.array(parts[1:], pa.binary()),
                         "ids": pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64())), "tokens": pa.array([np.diff(first).astype(np.int32)], pa.list_(pa.int32()))})
    return run


def _read(raw, n: int, keep: int) -> np.ndarray:
    return unplanes(unsqueeze(raw, n * keep), n, keep)


def _sequence(r: dict, part: str = "seq") -> np.ndarray:
    size = r["size" if part == "seq" else "held_size"]
    return np.frombuffer(unsqueeze(r[part], 4 * size), np.int32)


def _pack(x: np.ndarray, keep: int) -> bytes:
    return squeeze(np.frombuffer(planes(x.astype(U64), keep), np.uint8))


def _table(rows: list[tuple], schema: str) -> pa.Table | pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


ASKED = "bucket int, block int, n int, h binary, c binary, e binary"


def _ask(n: int):
    """Each block's words, counts in training texts and endings, per bucket."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                h, ending = _read(r["h"], r["n"], 8), _read(r["ending"], r["n"], 1)
                count = np.bincount(_sequence(r), minlength=r["n"] + 1)[:r["n"]]
                yield _table([(b, r["block"], at.size, planes(h[at], 6), planes(count[at], 4), planes(ending[at], 1)) for b, at in by_bucket(h, n)], ASKED)
    return run


COUNTED = "kind int, block int, bucket int, a long, b long, c long, counts binary"


def _count(key, table):
    """kind 0: counts for a block; 1: frequent words (hash, count, ending);
    2: an ending's tokens and words in this bucket."""
    table = table.combine_chunks()
    size = table["n"].to_numpy()
    read = lambda c, keep: np.concatenate([unplanes(x.as_py(), n, keep) for x, n in zip(table[c], size)]).astype(np.int64)
    h, c, e = read("h", 6), read("c", 4), read("e", 1)
    word, first, number = np.unique(h, return_index=True, return_inverse=True)
    total = np.bincount(number, weights=c, minlength=word.size).astype(np.int64)
    ending = e[first]
    cuts = np.append(0, np.cumsum(size))
    back = [planes(total[number[x:y]], 5) for x, y in zip(cuts[:-1], cuts[1:])]
    seen = total > 0
    top = np.lexsort((word, -total))[:FREQUENT]
    top = top[total[top] > 0]
    tokens = np.bincount(ending[seen], weights=total[seen], minlength=ENDINGS).astype(np.int64)
    kinds = np.bincount(ending[seen], minlength=ENDINGS)
    n, m = table.num_rows, top.size
    bucket = key[0].as_py()
    cat = lambda *x: np.concatenate([np.asarray(v, np.int64) for v in x])
    none, none_m, none_e = np.zeros(n), np.zeros(m), np.zeros(ENDINGS)
    return pa.table({"kind": pa.array(np.repeat(np.array([0, 1, 2], np.int32), [n, m, ENDINGS])), "block": pa.array(cat(table["block"].to_numpy(), none_m, none_e).astype(np.int32)),
                     "bucket": pa.array(np.full(n + m + ENDINGS, bucket, np.int32)), "a": cat(none, word[top], np.arange(ENDINGS)), "b": cat(none, total[top], tokens), "c": cat(none, ending[top], kinds),
                     "counts": pa.array(back + [None] * (m + ENDINGS), pa.binary())})


def unit_pairs(coded: DataFrame, frequent: np.ndarray, tasks: int) -> np.ndarray:
    """How often one unit follows another in the training texts."""
    def count(batches):
        m = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                unit = unit_of(_read(r["h"], r["n"], 8), _read(r["ending"], r["n"], 1).astype(np.int64), frequent)
                seq = np.append(unit, END)[_sequence(r)]
                m += np.bincount(np.append(END, seq[:-1])[:seq.size] * UNITS + seq, minlength=m.size)
        step = UNITS * UNITS // SLICES
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([planes(m[i * step:(i + 1) * step].astype(U64), 5) for i in range(SLICES)], pa.binary())], names=["slice", "m"])

    # one row per task and slice; a tree of additions keeps each step small
    part = coded.select("n", "size", "h", "ending", "seq").coalesce(tasks).mapInArrow(count, "slice int, m binary").withColumn("some", F.pmod(F.spark_partition_id(), F.lit(16)))
    half = part.groupBy("slice", "some").applyInArrow(add_to(5), "slice int, m binary")
    done = half.groupBy("slice").applyInArrow(add_to(8), "slice int, m binary").collect()
    out = np.zeros((SLICES, UNITS * UNITS // SLICES), np.int64)
    for r in done:
        out[r["slice"]] = unplanes(r["m"], out.shape[1], 8).astype(np.int64)
    return out.reshape(UNITS, UNITS)


def add_to(keep: int):
    """Adds the packed slices of a group, of ``keep`` bytes a number."""
    def add(key, table):
        step = UNITS * UNITS // SLICES
        total = np.zeros(step, U64)
        for x in table["m"]:
            total += unplanes(x.as_py(), step, keep)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "m": pa.array([planes(total, 8)], pa.binary())})
    return add


def with_ends(w: Words, value, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of all words with ``end`` behind each text, and each text's
    first position."""
    size = np.diff(w.first)
    first = np.append(0, np.cumsum(size + 1))
    out = np.full(int(first[-1]), end, np.int64)
    inner = np.ones(out.size, bool)
    inner[first[1:] - 1] = False
    out[inner] = value(w)
    return out, first


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int | None = None) -> np.ndarray:
    """Class of each unit, when a round moves nothing or raises
    nothing, or after ``rounds``; the end of a text stays alone in the last one."""
    f = lambda x: x * np.log(np.maximum(x, 1))
    n = pairs.sum(0) + pairs.sum(1)
    n[END] = 0
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    cls = np.zeros(UNITS, np.int64)
    cls[order] = np.arange(order.size) % classes
    cls[END] = classes
    k = classes + 1
    member = np.eye(k)[cls]
    c = member.T @ pairs @ member
    last = information(c)
    for _ in range(rounds) if rounds is not None else itertools.count():
        moved = 0
        for u in order:
            a = cls[u]
            right, left, own = np.bincount(cls, weights=pairs[u], minlength=k), np.bincount(cls, weights=pairs[:, u], minlength=k), float(pairs[u, u])
            right[a] -= own
            left[a] -= own
            c[a] -= right
            c[:, a] -= left
            c[a, a] -= own
            rows, cols = c.sum(1), c.sum(0)
            gain = (f(c + right) - f(c)).sum(1) + (f(c + left[:, None]) - f(c)).sum(0)
            d = np.diag(c)
            gain += f(d + right + left + own) - f(d + right) - f(d + left) + f(d)
            size_r, size_l = right.sum() + own, left.sum() + own
            gain -= f(rows + size_r) - f(rows) + f(cols + size_l) - f(cols)
            gain[-1] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            c[b] += right
            c[:, b] += left
            c[b, b] += own
            moved += a != b
            cls[u] = b
        now = information(c)
        if not moved or now <= last:
            break
        last = now
    return cls


def _start(counted: DataFrame, coded: DataFrame, tasks: int) -> dict:
    """The frequent words, the first class of each unit, and the totals: of
    fixed size, whatever the input's."""
    tops = counted.where("kind = 1").orderBy(F.desc("b"), "a").limit(FREQUENT).select("a", "b").collect()
    total = counted.where("kind = 2").agg(F.sum("b").alias("b"), F.sum("c").alias("c")).first()
    frequent = np.sort(np.array([r["a"] for r in tops], np.int64)).astype(U64)
    docs_trained = coded.agg(F.sum("trained")).first()[0] or 0
    return {"frequent": frequent, "cls": exchange(unit_pairs(coded, frequent, tasks)), "n": (total["b"] or 0) + docs_trained,
            "v": (total["c"] or 0) + int(docs_trained > 0), "ends": docs_trained}


ROUND = "block int, bucket int, n int, size int, h binary, cls binary, data binary, pairs binary"
MOVED = "block int, bucket int, moved long, cls binary"


def takes_turn(h: np.ndarray, turn: int, parts: int) -> np.ndarray:
    """Which words (48-bit hashes) may move in this round."""
    return mix(h) % U64(parts) == U64(turn % parts)


def _classes(r: dict, state: pa.Table) -> np.ndarray:
    """A block's classes in the state."""
    return _read(next(x for x in state["state"].to_pylist() if x is not None), r["n"], 1).astype(np.int64)


def _state(r: dict, cls: np.ndarray) -> tuple:
    """A block's classes and its class pairs, as a ROUND without bucket."""
    after = np.append(cls, CLASSES).astype(np.int16)[_sequence(r)]
    pairs = np.bincount(after[:-1] * np.int16(K) + after[1:], minlength=K * K)
    if after.size:
        pairs[CLASSES * K + after[0]] += 1
    return r["block"], None, None, None, None, _pack(cls, 1), None, planes(pairs.astype(U64), 5)


def _beside(r: dict, cls: np.ndarray, h: np.ndarray, n: int, turn: int, parts: int):
    """A block's words of this turn for each bucket, with classes and, of each,
    what occurs beside it: ``data`` is the number of entries of each word, their
    codes (class after it, or ``K`` and the class before it) and counts, and
    how often each word follows itself."""
    turns = np.flatnonzero(takes_turn(h & LOW, turn, parts))
    kind = np.int32 if turns.size * 2 * K < 2**31 else np.int64
    number = np.full(h.size + 1, -1, kind)
    number[turns] = np.arange(turns.size)
    seq = _sequence(r)
    of, me = np.append(cls, CLASSES).astype(kind)[seq], number[seq]
    mine = np.flatnonzero(me >= 0)  # an end follows every word, and another or an end is before it
    me = me[mine]
    first = mine[:1] == 0
    own = np.bincount(me[(seq[mine] == seq[mine - 1]) & (mine > 0)], minlength=turns.size)
    code = np.concatenate([me * kind(2 * K) + of[mine + 1], me * kind(2 * K) + kind(K) + of[mine - 1]])
    if first.any():
        code[me.size] = me[0] * (2 * K) + K + CLASSES
    code, many = np.unique(code, return_counts=True)
    at_word = np.searchsorted(code, (np.arange(turns.size + 1) * (2 * K)).astype(np.int64))
    code = (code % kind(2 * K)).astype(np.uint8)
    many, own, to = many.astype(np.uint32), own.astype(np.uint32), cls[turns].astype(np.uint8)
    for b, at in by_bucket(h[turns], n):
        lo, hi = int(at[0]), int(at[-1]) + 1  # a block's words are in the order of their buckets
        u, v = at_word[lo], at_word[hi]
        data = b"".join((np.diff(at_word[lo:hi + 1]).astype(np.uint8).tobytes(), code[u:v].tobytes(), many[u:v].tobytes(), own[lo:hi].tobytes()))
        yield r["block"], b, at.size, int(v - u), planes(h[turns[lo:hi]], 6), to[lo:hi].tobytes(), squeeze(np.frombuffer(data, np.uint8)), None


def _begin(start: dict, n: int, parts: int):
    """Each block's first classes, and what the first turn asks."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                h = _read(r["h"], r["n"], 8)
                cls = start["cls"][unit_of(h, _read(r["ending"], r["n"], 1).astype(np.int64), start["frequent"])]
                yield _table([_state(r, cls), *_beside(r, cls, h, n, 0, parts)], ROUND)
    return run


def _settle(n: int, turn: int, parts: int):
    """A block's classes after a round's answers, and what the next turn asks."""
    def run(key, coded, news):
        rows = []
        for r in coded.to_pylist():
            h, cls = _read(r["h"], r["n"], 8), _classes(r, news)
            got = {b: x for b, x in zip(news["bucket"].to_pylist(), news["cls"].to_pylist()) if x is not None}
            turns = np.flatnonzero(takes_turn(h & LOW, turn, parts))
            for b, at in by_bucket(h[turns], n):
                cls[turns[at]] = np.frombuffer(got[b], np.uint8)
            rows += [_state(r, cls), *_beside(r, cls, h, n, turn + 1, parts)]
        return pa.Table.from_batches([_table(rows, ROUND)])
    return run


def _contexts(n: int, turn: int, parts: int):
    """What a turn asks, for classes that were settled before another turn."""
    def run(key, coded, state):
        rows = []
        for r in coded.to_pylist():
            rows += _beside(r, _classes(r, state), _read(r["h"], r["n"], 8), n, turn, parts)
        return pa.Table.from_batches([_table(rows, ROUND)])
    return run


def _trained(n: int):
    """A block's training words for a bucket, with their classes."""
    def run(key, coded, state):
        rows = []
        for r in coded.to_pylist():
            size = r["n"]
            h, cls = _read(r["h"], size, 8), _classes(r, state)
            seen = np.flatnonzero(np.bincount(_sequence(r), minlength=size + 1)[:size])
            rows += [(b, at.size, planes(h[seen[at]], 6), planes(cls[seen[at]].astype(U64), 1)) for b, at in by_bucket(h[seen], n)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "n": pa.array([r[1] for r in rows], pa.int32()), **{c: pa.array([r[i] for r in rows], pa.binary()) for i, c in enumerate(("h", "cls"), 2)}})
    return run


def _kinds(key, table):
    """How many of a bucket's words each class has."""
    size = table["n"].to_pylist()
    h, cls = (np.concatenate([unplanes(x.as_py(), n, keep) for x, n in zip(table[c], size)]) for c, keep in (("h", 6), ("cls", 1)))
    first = np.unique(h, return_index=True)[1]
    return pa.table({"block": pa.array([-1], pa.int32()), "bucket": pa.array([key[0].as_py()], pa.int32()), "kinds": pa.array([planes(np.bincount(cls[first].astype(np.int64), minlength=K).astype(U64), 5)], pa.binary())})


def _xlogx(x):
    return x * np.log(np.maximum(x, 1))


def best_moves(c: np.ndarray, cls: np.ndarray, beside: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Best class of each word, all others staying. ``beside``: occurrences of
    the classes after (``K`` columns) and before each word; ``own``: how often
    it follows itself. Works on the classes a word really stands beside, so a
    word costs its different neighbouring classes, not all pairs of classes."""
    out = cls.copy()
    rows, cols, d = c.sum(1), c.sum(0), np.diag(c)
    looked = [np.concatenate([_xlogx(m.T + r) - _xlogx(m.T) for r in range(TABLED + 1)]) for m in (c, c.T)]
    sort = np.argsort(-np.count_nonzero(beside, axis=1), kind="stable")  # alike words together
    for lo in range(0, cls.size, 4096):
        at = sort[lo:lo + 4096]
        a, o = cls[at], own[at].astype(float)
        right, left = (beside[at, x].astype(float) for x in (slice(K), slice(K, 2 * K)))
        i = np.arange(a.size)
        right[i, a] -= o
        left[i, a] -= o
        rest = d[a] - right[i, a] - left[i, a] - o  # the pairs of the word's class with itself, without the word
        gain = np.zeros((a.size, K))
        for m, x, other, table in ((c, right, left, looked[0]), (c.T, left, right, looked[1])):
            gain += _one_side(m, x, other, table, a, rest)
        w, k = np.nonzero(left)  # on both sides of one class
        both = (right[w, k] > 0) & (o[w] == 0)
        follows = np.flatnonzero(o)  # or of itself
        for w, k in ((w[both], k[both]), (np.repeat(follows, K), np.tile(np.arange(K), follows.size))):  # noqa: PLW2901
            now, r, l, s = np.where(k == a[w], rest[w], d[k]), right[w, k], left[w, k], o[w]  # noqa: E741
            gain[w, k] += _xlogx(now + r + l + s) - _xlogx(now + r) - _xlogx(now + l) + _xlogx(now)
        for total, s in ((rows, right.sum(1) + o), (cols, left.sum(1) + o)):  # what the classes have in all
            sizes, which = np.unique(s, return_inverse=True)
            gain -= (_xlogx(total + sizes[:, None]) - _xlogx(total))[which]
            gain[i, a] += _xlogx(total[a] + s) - 2 * _xlogx(total[a]) + _xlogx(total[a] - s)
        gain[:, -1] = -np.inf
        b = gain.argmax(1)
        out[at] = np.where(gain[i, b] > gain[i, a] + 1e-9, b, a)
    return out


def _one_side(m: np.ndarray, x: np.ndarray, other: np.ndarray, table: np.ndarray, a: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """What the pairs on one side of the words add in each class: ``x`` are the
    classes beside, a word's own class is ``a``. Small counts are looked up."""
    order = np.argsort(-np.count_nonzero(x, axis=1), kind="stable")
    x, other, a, rest = x[order], other[order], a[order], rest[order]
    word, k = np.nonzero(x)
    r, mine = x[word, k], k == a[word]
    many = np.flatnonzero((r > TABLED) & ~mine)
    line = r.astype(np.int64) * K + k
    line[many] = 0  # no occurrences: nothing
    line[mine] = 0
    size = np.bincount(word, minlength=a.size)
    first = np.cumsum(size) - size
    gain = np.zeros((a.size, K))
    for j in range(int(size[0]) if size.size else 0):  # the words with more classes beside them come first
        to = int(np.searchsorted(-size, -j, "left"))
        gain[:to] += table.take(line[first[:to] + j], axis=0)
    now = m.T[k[many]]
    _add_rows(gain, word[many], _xlogx(now + r[many, None]) - _xlogx(now))
    at = word[mine]  # beside its own class, which has less without the word
    now = m.T[a[at]] - other[at]
    now[np.arange(at.size), a[at]] = rest[at]
    gain[at] += _xlogx(now + r[mine, None]) - _xlogx(now)
    # staying adds what the word has taken away
    now = m[a[word], k]
    stay = _xlogx(now) - _xlogx(now - r)
    was = np.flatnonzero(mine)
    stay[was] = _xlogx(rest[at] + r[was]) - _xlogx(rest[at])
    gain[np.arange(a.size), a] = np.bincount(word, weights=stay, minlength=a.size)
    out = np.empty_like(gain)
    out[order] = gain
    return out


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds ``rows`` to the rows ``at`` (ascending, with repeats)."""
    if at.size:
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        to[at[first]] += np.add.reduceat(rows, first, axis=0)


def _move(c: np.ndarray):
    """The words' best classes, in the order of each block's question."""
    def run(key, table):
        table = table.combine_chunks().sort_by("block")
        size, entries = table["n"].to_numpy().astype(np.int64), table["size"].to_numpy().astype(np.int64)
        h = np.concatenate([unplanes(x.as_py(), n, 6) for x, n in zip(table["h"], size)])
        word, first, number = np.unique(h, return_index=True, return_inverse=True)
        cls = np.frombuffer(b"".join(table["cls"].to_pylist()), np.uint8).astype(np.int64)[first]
        raw = [np.frombuffer(unsqueeze(x, 5 * n + 5 * e), np.uint8) for x, n, e in zip(table["data"].to_pylist(), size, entries)]
        degree, code, many, self_ = [], [], [], []
        for x, n, e in zip(raw, size, entries):
            for to, part in zip((degree, code, many, self_), np.split(x, (n, n + e, n + 5 * e))):
                to.append(part)
        degree, code = np.concatenate(degree), np.concatenate(code)
        many, self_ = (np.concatenate(x).view(np.uint32) for x in (many, self_))
        of = np.repeat(number, degree)  # the entries' words
        own = np.bincount(number, weights=self_, minlength=word.size).astype(np.int64)
        new = cls.copy()
        step = 1 << 14
        for lo in range(0, word.size, step):
            hi = min(lo + step, word.size)
            use = np.flatnonzero((of >= lo) & (of < hi))
            beside = np.bincount((of[use] - lo) * (2 * K) + code[use], weights=many[use], minlength=(hi - lo) * 2 * K).reshape(-1, 2 * K)
            can = np.flatnonzero(beside.any(1))
            new[lo + can] = best_moves(c, cls[lo + can], beside[can], own[lo + can])
        answers = [new[number[y - n:y]].astype(np.uint8).tobytes() for y, n in zip(np.cumsum(size), size)]
        moved = np.zeros(size.size, np.int64)
        moved[0] = (new != cls).sum()
        return pa.table({"block": table["block"], "bucket": table["bucket"], "moved": moved, "cls": pa.array(answers, pa.binary())})
    return run


def _total(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Sum of packed numbers (a row each); the driver reads 16 sums."""
    def add(key, table):
        total = np.zeros(size, U64)
        for x in table["x"]:
            total += unplanes(x.as_py(), size, 5)
        return pa.table({"x": pa.array([planes(total, 8)], pa.binary())})

    some = rows.select(F.pmod(F.hash("block", "bucket"), F.lit(16)).alias("some"), F.col(column).alias("x"))
    return sum((unplanes(r["x"], size, 8).astype(float) for r in some.groupBy("some").applyInArrow(add, "x binary").collect()), np.zeros(size))


def information(c: np.ndarray) -> float:
    """What the exchange raises: the mutual information of adjacent classes,
    but for a factor and the words' own shares."""
    return float(_xlogx(c).sum() - _xlogx(c.sum(1)).sum() - _xlogx(c.sum(0)).sum() + _xlogx(c.sum()))


def cluster(coded: DataFrame, start: dict, n: int) -> tuple[DataFrame, np.ndarray, np.ndarray, list[float]]:
    """Each block's classes (the rows of ROUND without bucket), the class pairs,
    the words per class, and the mutual information of each round.

    Blocks keep their coded texts where they are; what a round sends is the
    words of its turn with their neighbouring classes, and the answers. A block
    that takes in a round's answers asks for the next turn at once; only if the
    round is taken back, or moved nothing, it asks again."""
    needs = coded.select("block", "n", "size", "h", "seq")

    def at_blocks(f, other: DataFrame, schema: str) -> DataFrame:
        return needs.groupBy("block").cogroup(other.groupBy("block")).applyInArrow(f, schema)

    settled = lambda state: state.where("bucket IS NULL")
    known = lambda state: settled(state).select("block", "bucket", F.lit(None).cast("binary").alias("cls"), F.col("cls").alias("state"))
    state, asked = cut(coded.select("block", "n", "size", "h", "ending", "seq").mapInArrow(_begin(start, n, PARTS), ROUND)), (0, PARTS)
    best, course, parts, still, moved = None, [], PARTS, 0, 0
    for turn in itertools.count():
        if not still:
            c = _total(settled(state).select("block", F.lit(0).alias("bucket"), "pairs"), "pairs", K * K).reshape(K, K)
            course.append(information(c))
            gain = course[-1] - best["value"] if best else np.inf
            if gain > 0:
                best = {"value": course[-1], "c": c, "state": state}
                if gain < LEAST * best["value"]:
                    break
            elif moved == 1:
                break
            else:  # too many moves at once
                parts *= 2
        if asked == (turn, parts) and best["state"] is state:
            questions = state.where("bucket IS NOT NULL")
        else:
            questions = at_blocks(_contexts(n, turn, parts), known(best["state"]), ROUND)
        after = cut(questions.groupBy("bucket").applyInArrow(_move(best["c"]), MOVED))
        moved = after.agg(F.sum("moved")).first()[0] or 0
        still = 0 if moved else still + 1
        if still == parts:
            break
        if moved:
            news = known(best["state"]).unionByName(after.select("block", "bucket", "cls", F.lit(None).cast("binary").alias("state")))
            state, asked = cut(at_blocks(_settle(n, turn, parts), news, ROUND)), (turn + 1, parts)
        release(coded.sparkSession)
    kinds = _total(at_blocks(_trained(n), known(best["state"]), "bucket int, n int, h binary, cls binary").groupBy("bucket").applyInArrow(_kinds, "block int, bucket int, kinds binary"), "kinds", K)
    return settled(best["state"]), best["c"], kinds, course


def _model(start: dict, c: np.ndarray, kinds: np.ndarray) -> dict:
    """Everything ``score`` needs besides the words' counts and classes."""
    n_class, v_class = c.sum(0), kinds.copy()
    v_class[CLASSES] = int(start["ends"] > 0)
    share = (n_class + 1) / (n_class.sum() + K)
    go = np.log10((c + K * share) / (c.sum(1, keepdims=True) + K))
    emit = np.log10(n_class + 0.5 * (v_class + 1))  # to be taken from log10(count + 0.5)
    return {**start, "go": go, "emit": emit}


def _score(model: dict, n: int):
    def run(key, coded, answers):
        out = []
        for r in coded.to_pylist():
            h, size = _read(r["h"], r["n"], 8), np.array(r["tokens"], np.int64)
            kind = answers["kind"].to_numpy()
            counts = answers.filter(pa.array(kind == 0))
            got = dict(zip(counts["bucket"].to_pylist(), counts["counts"].to_pylist()))
            total = np.zeros(r["n"] + 1, np.int64)
            total[-1] = model["ends"]
            for b, at in by_bucket(h, n):
                total[at] = unplanes(got[b], at.size, 5)
            cls = np.append(_read(answers["cls"].to_pylist()[int(np.flatnonzero(kind == 1)[0])], r["n"], 1).astype(np.int64), CLASSES)
            seq = np.concatenate([_sequence(r), _sequence(r, "held")])
            log = np.log10(total + 0.5)
            base = (log - np.log10(model["n"] + 0.5 * (model["v"] + 1)))[seq]
            emit = np.where(cls == CLASSES, 0.0, log - model["emit"][cls])[seq]
            after = cls[seq]
            before = np.append(CLASSES, after[:-1])  # each text's last class is the end's
            first = np.cumsum(size) - size
            add = lambda x: np.add.reduceat(x, first)  # noqa: E731, B023
            out.append(pa.table({"doc_id": pa.array(r["ids"], pa.int64()), "held_out": pa.array(np.arange(size.size) >= r["trained"]), "n_tokens": pa.array(size),
                                 "n_known": pa.array(add((total > 0).astype(np.int64)[seq])), "train_tokens": pa.array(np.full(size.size, model["n"], np.int64)),
                                 "base_score": pa.array(add(base)), "score": pa.array(add(model["go"][before, after] + emit))}))
        return pa.concat_tables(out)
    return run


def score_texts(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every text; ``train`` marks the rows to learn from. The texts are read and
    shuffled once; all else works on the blocks' coded texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    blocks, least = block_count(rows, block_bytes=TEXT_BYTES), 2 * docs.sparkSession.sparkContext.defaultParallelism
    n = max(-(-blocks // BLOCKS_A_BUCKET), min(blocks, least))
    coded = cut_as_dealt(with_block(rows, blocks, ("train",)).groupBy("block").applyInArrow(_code(n), CODED).repartition(blocks, "block"))
    release(docs.sparkSession)
    counted = cut(coded.select("block", "n", "size", "h", "ending", "seq").mapInArrow(_ask(n), ASKED).groupBy("bucket").applyInArrow(_count, COUNTED))
    start = _start(counted, coded, n)
    release(docs.sparkSession)
    state, c, kinds, _ = cluster(coded, start, n)
    release(docs.sparkSession)
    model = _model(start, c, kinds)
    answers = counted.where("kind = 0").select(F.lit(0).alias("kind"), "block", "bucket", "counts", F.lit(None).cast("binary").alias("cls")) \
        .unionByName(state.select(F.lit(1).alias("kind"), "block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("counts"), "cls"))
    return coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(model, n), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
