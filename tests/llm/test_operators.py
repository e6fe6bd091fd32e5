"""The document operators against plain versions, on small tables with hard
cases: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL
from snaphist.llm import (
    class_model, decontaminate, html_extract, language_id, lineage, mixing, ngram_join, passages, quality_model, quality_rules,
    substring_dedup, suffix_dedup,
)
from snaphist.llm.components import components
from snaphist.llm.ship import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, as extra columns of the input.
CLASH = ("block", "bucket", "kind", "n", "key", "th", "size", "target", "ord", "slice", "h", "held", "train", "score", "edits", "item_id")


@pytest.fixture(autouse=True)
def sources(spark):
    ship(spark)


def table(spark, rows):
    """(doc_id, text) or (doc_id, text, lang, source) rows, with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASH})


def corpus(seed, n=90):
    rng = random.Random(seed)
    vocab = ["a", "b", "cc", "dd", "é", "the", "zeta", "omega", "ÑU", "x1"]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    base = [text(rng.randint(20, 70)) for _ in range(6)]
    makers = [lambda: text(rng.randint(0, 50)), lambda: rng.choice(base), lambda: text(9) + " " + rng.choice(base)[15:110] + "\n " + text(8),
              lambda: "x y " * rng.randint(3, 40), lambda: None, lambda: "", lambda: " \n\t "]
    rows = [(i * 3 % (n + 1), rng.choice(makers)()) for i in range(n)]
    return [*rows, (1000, text(6000) + " " + base[0] * 3), (1001, "long" * 20000)]


# ------------------------------------------------------------------ 1 and 5
@pytest.mark.parametrize("seed, hot", [(1, 256), (2, 0)])
def test_substring_dedup(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    rows = corpus(seed)
    got = substring_dedup.dedup_substrings(table(spark, rows)).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert sorted(map(tuple, got.collect())) == brute.substring_dedup(rows)


@pytest.mark.parametrize("seed, hot, least", [(1, 256, 50), (2, 0, 50), (3, 256, 21)])
def test_byte_dedup(spark, monkeypatch, seed, hot, least):
    monkeypatch.setattr(passages, "HOT", hot)
    rows = corpus(seed)[:-1]
    got = suffix_dedup.dedup_bytes(table(spark, rows), min_bytes=least).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == brute.byte_dedup(rows, least)


def test_dedup_of_null_ids_repeats_and_nothing(spark):
    t = " ".join(f"w{i}" for i in range(30))
    got = substring_dedup.dedup_substrings(table(spark, [(None, t), (5, t), (5, t), (9, t)]))
    assert sorted((r.doc_id or -1, r.n_removed) for r in got.collect()) == [(-1, 30), (5, 0), (5, 0), (9, 30)]
    for f in (substring_dedup.dedup_substrings, suffix_dedup.dedup_bytes):
        assert f(table(spark, []).limit(0)).count() == 0


def test_kept_white_space(spark):
    t = " ".join(f"w{i}" for i in range(20))
    rows = [(1, t), (2, f"  one\n{t}\n\ntwo  "), (3, " \n "), (4, None), (5, "as\tit  is\n")]
    got = {r.doc_id: r.text for r in substring_dedup.dedup_substrings(table(spark, rows), keep_space=True, keep=("lang",)).collect()}
    assert got == {1: t, 2: "  one\ntwo  ", 3: " \n ", 4: None, 5: "as\tit  is\n"}


def test_suffix_automaton_against_search():
    rng = random.Random(4)
    for _ in range(40):
        texts = [[rng.choice("ab") for _ in range(rng.randint(0, 25))] for _ in range(5)]
        sam = substring_dedup.SuffixAutomaton()
        for i, t in enumerate(texts):
            sam.add(t, i)
        first = {}
        for i, t in enumerate(texts):
            for j in range(len(t) - 3):
                first.setdefault(tuple(t[j:j + 4]), i)
        for t in texts:
            assert list(sam.matches(t, 4)) == [(j + 4, first[tuple(t[j:j + 4])]) for j in range(len(t) - 3)]


def test_merged_transforms_equal_direct_sorting():
    rng = np.random.default_rng(1)
    chains = [rng.integers(0, 3, rng.integers(0, 30)).astype(">u2") for _ in range(24)]
    parts = [suffix_dedup.Transform(chains[i::3]) for i in range(3)]
    at, interval = suffix_dedup.repeated_intervals(parts, 4)
    whole = [(k, p) for i in range(3) for k, p in _suffixes(parts[i], chains[i::3])]
    groups = {}
    for a, g in zip(at, interval):
        groups.setdefault(g, []).append(whole[a][0][:4])
    assert all(len(set(v)) == 1 and len(v) > 1 and len(v[0]) == 4 for v in groups.values())
    counts = Counter(k[:4] for k, _ in whole if len(k) >= 4)
    assert sorted(len(v) for v in groups.values()) == sorted(n for n in counts.values() if n > 1)


def _suffixes(t, chains):
    flat = [(tuple(c[p:].tolist()), (i, p)) for i, c in enumerate(chains) for p in range(c.size + 1)]
    return [flat[i] for i in t.order]


# ------------------------------------------------------------------ 2
def near_corpus(seed):
    rng = random.Random(seed)
    vocab = [a + b for a in "abcdefgh" for b in "xyzuvw"]
    base = [[rng.choice(vocab) for _ in range(rng.randint(5, 120))] for _ in range(8)]
    rows = []
    for i in range(260):
        b = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            b[rng.randrange(len(b))] = rng.choice(vocab)
        if rng.random() < 0.2:
            b += [rng.choice(vocab) for _ in range(rng.randint(1, 5))]
        t = " ".join(b)
        rows.append((i * 7 % 261, rng.choice([None, "", "a b", "A b", "\n", t.upper()]) if rng.random() < 0.1 else t))
    return rows


def near_brute(rows, k=4, percent=85):
    sets = {}
    for i, t in rows:
        w = brute.words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, seed):
    rows = near_corpus(seed)
    got = ngram_join.near_duplicates(table(spark, rows).repartition(4)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == near_brute(rows)


@pytest.mark.parametrize("changes", [2, 12])
def test_ngram_join_with_a_third_near_copies_of_one_text(spark, changes):
    """Copies that link, and copies just too different to."""
    rng = random.Random(changes)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(150):
        w = list(base) if i % 3 == 0 else [f"x{rng.randint(0, 400)}" for _ in range(rng.randint(3, 90))]
        for j in rng.sample(range(len(w)), min(changes, len(w))) if i % 3 == 0 else ():
            w[j] = f"y{rng.randint(0, 10_000)}"
        rows.append((i, " ".join(w)))
    for k, percent in ((4, 85), (5, 80)):
        got = ngram_join.near_duplicates(table(spark, rows), shingle=k, percent=percent).select("doc_id", "n_shingles", "component_id")
        assert sorted(map(tuple, got.collect())) == near_brute(rows, k, percent)


def test_ngram_join_of_repeats_null_ids_and_nothing(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(7, t), (7, t), (3, t + " end"), (None, t), (None, "only here at all"), (8, None)]
    got = ngram_join.near_duplicates(table(spark, rows)).select("doc_id", "component_id", "stays").collect()
    assert sorted(((r.doc_id or -1, r.component_id or -1, r.stays) for r in got)) == [
        (-1, -1, True), (-1, 3, False), (3, 3, True), (7, 3, False), (7, 3, False), (8, 8, True)]
    assert ngram_join.near_duplicates(table(spark, []).limit(0)).count() == 0


def test_signature_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 2**63, 60).astype(np.uint64) for _ in range(6)]
    sets = []
    for i in range(90):
        b = base[i % 6].copy()
        b[: rng.integers(0, 8)] = rng.integers(0, 2**63, 1)[0]
        sets.append(np.unique(b))
    n = np.array([s.size for s in sets])
    comp = rng.integers(0, 4, len(sets))
    order = np.lexsort((n, comp))
    sets, n, comp = [sets[i] for i in order], n[order], comp[order]
    sig = [ngram_join.signature(s) for s in sets]
    tree = ngram_join.SignatureTree(n, comp, np.stack([ngram_join.fold(x[None], min(y.size for y in sig))[0] for x in sig]))
    got = {(min(i, j), max(i, j)) for x, y in tree.pairs(85) for i, j in zip(x.tolist(), y.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            o = np.intersect1d(sets[i], sets[j]).size
            if comp[i] != comp[j] and 100 * o >= 85 * (n[i] + n[j] - o):
                assert (j, i) in got


@pytest.mark.parametrize("one_task", [0, 100_000])
def test_components_of_chains_and_stars(spark, one_task):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(200, 230)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(30)]
    edges = [e for e in edges if e[0] != e[1]]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "u long, v long"), one_task)
    assert {r.node: r.component for r in got.collect()} == {x: find(x) for x in parent}


# ------------------------------------------------------------------ 3
def fill(sizes, weights, cap=3):
    total, clamped = sum(sizes), set()
    while True:
        words, weight = total - sum(cap * sizes[i] for i in clamped), sum(w for i, w in enumerate(weights) if i not in clamped)
        new = {i for i, w in enumerate(weights) if i not in clamped and weight and w * words >= cap * sizes[i] * weight}
        if not new:
            return [cap * sizes[i] if i in clamped else w * words / weight for i, w in enumerate(weights)]
        clamped |= new


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30))) or None, "en", rng.choice(["a", "b", "Ä", "z", None])) for i in range(300)]
    rows += [(1000 + i, "w " * 40, "en", "tiny") for i in range(2)] + [(2000, None, "en", "empty")]
    df = table(spark, rows)
    got = {r.doc_id: r for r in mixing.mix_sources(df).collect()}
    again = {r.doc_id: r for r in mixing.mix_sources(df.repartition(5)).collect()}
    assert {i: r.taken for i, r in got.items()} == {i: r.taken for i, r in again.items()}
    size = {}
    for i, t, _, s in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    targets = dict(zip(names, fill([size[s] for s in names], [i % 3 + 1 for i in range(len(names))])))
    for i, t, _, s in rows:
        r = got[i]
        assert (r.size, r.source_size) == (len(brute.words(t)), size[s]) and r.taken <= 3 * r.size
        assert math.isclose(r.target, targets[s])
    for s in names:
        assert abs(sum(got[r[0]].taken for r in rows if r[3] == s) - targets[s]) <= 1
    assert math.isclose(sum(targets.values()), min(sum(size.values()), 3 * sum(size.values())))


def test_mixing_nothing(spark):
    assert mixing.mix_sources(table(spark, []).limit(0)).count() == 0
    only = mixing.mix_sources(table(spark, [(1, None), (2, "")])).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2


# ------------------------------------------------------------------ 4
def test_class_model(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(90001, None), (90002, ""), (90003, "Unseen UNSEEN words"), (90003, "Unseen UNSEEN words")]
    train = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 1
    got = class_model.score_texts(table(spark, rows), train).collect()
    low = lambda t: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in brute.words(t)]
    count = Counter()
    for i, t in rows:
        if brute.crc(i, 5) != 1:
            count.update([*low(t), "\n"])
    n, v = sum(count.values()), len(count)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        toks = [*low(texts[r.doc_id]), "\n"]
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in toks)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(toks), sum(count[x] > 0 for x in toks), n, brute.crc(r.doc_id, 5) == 1)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert class_model.score_texts(table(spark, []).limit(0), train).count() == 0
    none = class_model.score_texts(table(spark, [(1, "a b"), (2, None)]), F.lit(False)).collect()  # nothing to learn from
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in none) == [(1, 3, 0, 0), (2, 1, 0, 0)]


def test_class_model_probabilities_add_up():
    """Over all words and one unknown word per class, given any class before."""
    rng = np.random.default_rng(5)
    pairs = rng.poisson(0.05, (class_model.UNITS, class_model.UNITS))
    cls = class_model.exchange(pairs, rounds=2)
    k = class_model.CLASSES + 1
    assert cls[class_model.END] == k - 1 and (np.delete(cls, class_model.END) < k - 1).all()
    member = np.eye(k)[cls]
    c, n_class = member.T @ pairs @ member, member.T @ pairs.sum(0)
    share = (n_class + 1) / (n_class.sum() + k)
    assert np.allclose(((c + k * share) / (c.sum(1, keepdims=True) + k)).sum(1), 1)


def plain_exchange(texts):
    """Words' classes and counts by the rule of the operator, with the mutual
    information of all texts computed anew for every move tried."""
    m, k, end = class_model, class_model.K, class_model.CLASSES
    seqs = [t.split(" ") for t in texts]
    count = Counter(w for s in seqs for w in s)
    names = sorted(count)
    t = m.Texts.of(pa.chunked_array([names]), lower=True)
    h = m.words(t).hash & m.LOW
    frequent = np.array(sorted(x for _, x in sorted((-count[w], int(x)) for w, x in zip(names, h))[:m.FREQUENT]), np.uint64)
    unit = dict(zip(names, m.unit_of(h, m.endings(t, m.words(t)), frequent)))
    pairs = np.zeros((m.UNITS, m.UNITS))
    steps = [(a, b) for s in seqs for a, b in zip([None, *s], [*s, None])]
    for a, b in steps:
        pairs[unit.get(a, m.END), unit.get(b, m.END)] += 1
    units = m.exchange(pairs)

    def table_of(cls):
        c = np.zeros((k, k))
        for a, b in steps:
            c[cls.get(a, end), cls.get(b, end)] += 1
        return c

    def moved(cls, word, to):
        """Class pairs with one more word moved."""
        c, other = table.copy(), {**cls, word: to}
        for a, b in near[word]:
            c[cls.get(a, end), cls.get(b, end)] -= 1
            c[other.get(a, end), other.get(b, end)] += 1
        return c

    near = {w: [(a, b) for a, b in steps if w in (a, b)] for w in names}
    now, best, parts, turn = {w: int(units[unit[w]]) for w in names}, None, m.PARTS, 0
    while True:
        value = m.information(table_of(now))
        if best is None or value > best[0]:
            done = best is not None and value - best[0] < m.LEAST * value
            best = (value, now)
            if done:
                break
        elif len([w for w in now if now[w] != best[1][w]]) == 1:
            break
        else:
            parts *= 2
        for _ in range(parts):  # until a turn in which a word moves
            table, now = table_of(best[1]), dict(best[1])
            for w, x in zip(names, h):
                if m.takes_turn(np.array([x]), turn, parts)[0]:
                    gain = [m.information(moved(best[1], w, to)) for to in range(end)]
                    if max(gain) > gain[best[1][w]] + 1e-7:
                        now[w] = int(np.argmax(gain))
            turn += 1
            if now != best[1]:
                break
        else:
            break
    assert any(best[1][w] != units[unit[w]] for w in names)
    return best[1], units, count, table_of(best[1])


def test_class_model_against_plain_exchange(spark):
    """The scores of all texts, with every move tried by hand."""
    rng = random.Random(11)
    words = [f"{a}{i}" for a in "abcd" for i in range(210)]  # some more than the units of the first step
    near = {w: rng.sample(words, 4) for w in words}

    def line(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(near[out[-1]]) if rng.random() < 0.8 else rng.choice(words))
        return " ".join(out)

    rows = [(i, line(rng.randint(5, 120))) for i in range(60)]
    got = {r.doc_id: r.score for r in class_model.score_texts(table(spark, [*rows, (100, line(40)), (101, "new a1 words a2")]), F.col("doc_id") < 100).collect()}
    texts = dict(rows)
    cls, units, count, c = plain_exchange(list(texts.values()))
    k, end = class_model.K, class_model.CLASSES
    share = [(c[:, j].sum() + 1) / (c.sum() + k) for j in range(k)]
    kinds = Counter(cls.values())

    def score(text):
        total, before = 0.0, end
        for w in [*text.split(" "), None]:
            if w in cls or w is None:
                to = cls.get(w, end)
            else:
                t = class_model.Texts.of(pa.chunked_array([[w]]), lower=True)
                to = int(units[class_model.FREQUENT + class_model.endings(t, class_model.words(t))[0]])
            total += math.log10((c[before, to] + k * share[to]) / (c[before].sum() + k))
            if w is not None:
                total += math.log10((count[w] + 0.5) / (c[:, to].sum() + 0.5 * (kinds[to] + 1)))
            before = to
        return total

    for i, t in texts.items():
        assert math.isclose(got[i], score(t), rel_tol=1e-9), i
    assert math.isclose(got[101], score("new a1 words a2"), rel_tol=1e-9)


def test_best_moves_of_words():
    """Against the mutual information after each possible move."""
    rng = np.random.default_rng(7)
    k, v = class_model.K, 400
    seq = rng.integers(0, v, 3000) * rng.integers(0, 2, 3000)
    cls = np.append(rng.integers(0, k - 1, v), k - 1)
    pairs = np.zeros((v + 1, v + 1))
    np.add.at(pairs, (np.append(v, seq), np.append(seq, v)), 1)
    member = np.eye(k)[cls]
    beside = np.concatenate([pairs @ member, pairs.T @ member], 1)[:v]
    got = class_model.best_moves(member.T @ pairs @ member, cls[:v], beside, np.diag(pairs)[:v])
    for w in range(0, v, 13):
        value = np.empty(k - 1)
        for b in range(k - 1):
            other = cls.copy()
            other[w] = b
            m = np.eye(k)[other]
            value[b] = class_model.information(m.T @ pairs @ m)
        assert value[got[w]] >= value.max() - 1e-6


def test_rare_words_are_clustered_by_their_neighbours(spark):
    """More words than the frequent ones, all with one ending."""
    rng = random.Random(8)
    xs, ys = [[f"{g}{i}zz" for i in range(1000)] for g in "xy"]
    line = lambda n: " ".join(rng.choice(xs if i % 2 else ys) for i in range(n))
    rows = [(i, line(40)) for i in range(400)]
    count = Counter(w for _, t in rows for w in t.split())
    x, y = ([w for w in sorted(g, key=lambda w: (count[w], w)) if 3 <= count[w]][:20] for g in (xs, ys))
    for i, (a, b, c, d) in enumerate(zip(x[::2], x[1::2], y[::2], y[1::2])):
        rows += [(1000 + 2 * i, f"{c} {a} {d} {b}"), (1001 + 2 * i, f"{c} {d} {a} {b}")]
    got = {r.doc_id: r.score for r in class_model.score_texts(table(spark, rows), F.col("doc_id") < 1000).collect()}
    assert sum(got[1000 + 2 * i] > got[1001 + 2 * i] for i in range(10)) >= 9


def test_class_model_shuffles_its_texts_once(spark, tmp_path):
    """Scores come from the blocks' coded texts, which stay as they are dealt."""
    table(spark, [(i, f"a{i % 7} b{i % 5} c") for i in range(60)]).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = class_model.score_texts(docs, F.col("doc_id") < 40)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower() and plan.count("Exchange hashpartitioning") == 1


def test_cut_keeps_how_rows_are_dealt(spark):
    rows = lineage.cut_as_dealt(spark.range(100).repartition(7, "id"))
    assert "Exchange" not in rows.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_near_duplicates_free_finished_steps(spark, monkeypatch):
    """The driver holds no finished step's plans while later ones run."""
    calls = []
    monkeypatch.setattr(ngram_join, "release", calls.append)
    rows = [(i, " ".join(f"w{j}" for j in range(40)) + f" x{i}") for i in range(6)]
    got = ngram_join.near_duplicates(table(spark, rows)).collect()
    assert {r.component_id for r in got} == {0} and len(calls) == 4


def test_near_duplicates_plan_few_shuffles_a_step(spark, monkeypatch):
    """The driver holds the plans and task reports of a few shuffles at once."""
    sizes, kind = [], type(spark.range(0))
    checkpoint = kind.checkpoint

    def counted(df, *args):
        sizes.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return checkpoint(df, *args)

    monkeypatch.setattr(kind, "checkpoint", counted)
    rows = [(i, " ".join(f"w{j}" for j in range(40)) + f" x{i}") for i in range(6)]
    assert ngram_join.near_duplicates(table(spark, rows)).count() == 6
    assert len(sizes) > 10 and max(sizes) <= 8, sizes


def test_exchange_raises_mutual_information():
    rng = np.random.default_rng(6)
    u = class_model.UNITS
    group = np.arange(u) % 2
    pairs = np.zeros((u, u))
    for _ in range(30000):
        a = rng.integers(0, 60)
        pairs[a, rng.choice(np.flatnonzero((group == group[a]) & (np.arange(u) < 60)))] += 1
    cls = class_model.exchange(pairs, classes=2)
    side = [set(cls[np.flatnonzero((group == g) & (np.arange(u) < 60))]) for g in (0, 1)]
    assert len(side[0]) == len(side[1]) == 1 and side[0] != side[1]


# ------------------------------------------------------------------ 6
def test_leaks(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(14, 40))) for i in range(20)] + [(50, "short it"), (51, "tiny"), (52, None), (53, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    docs, want = [], set()
    for d in range(120):
        t = text(rng.randint(5, 200))
        if d % 4 == 0:
            i, leak = items[d // 4 % 20]
            leak = list(leak)
            for _ in range(int(0.08 * len(leak)) if d % 8 else 0):
                at = rng.randrange(len(leak))
                leak[at:at + 1] = rng.choice([[], ["z"], [leak[at], "q"]])
            if brute_edits("".join(leak), items[d // 4 % 20][1]) <= int(0.08 * len(items[d // 4 % 20][1])):
                want.add((d, i))
            t = f"{text(9)}\n{''.join(leak).upper()}\t{t}"
        docs.append((d, t))
    docs += [(900, None), (901, ""), (902, "here is a short it is"), (902, "here is a short it is"), (903, "x" * 100000)]
    want.add((902, 50))
    df = table(spark, docs)
    got = decontaminate.find_leaks(df, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} >= want
    assert {r.doc_id for r in got.collect()} <= {d for d, _ in docs if d % 4 == 0 or d == 902}
    assert sum(r.doc_id == 902 for r in got.collect()) == 2
    left = decontaminate.drop_leaks(df, bench)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {r.doc_id for r in got.collect()}
    assert decontaminate.find_leaks(df.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(df, bench.limit(0)).count() == 0


def brute_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def sellers(item, text):
    """Fewest edits of the item against stretches that end at each position."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row = _next(row, i, x, text)
    return row


def test_leaks_against_all_alignments(spark):
    """Items of every length, few letters (many chance finds), any edits."""
    rng = random.Random(17)
    for letters in ("ab", "abc ", "abcdefghijkl"):
        some = lambda n: "".join(rng.choice(letters) for _ in range(n))
        items = [(i, some(n)) for i, n in enumerate([1, 2, 5, 7, 8, 12, 13, 14, 15, 22, 30, 60])]
        docs = []
        for d in range(40):
            text = some(rng.randint(0, 50))
            for _ in range(rng.randint(0, 2)):
                leak = list(rng.choice(items)[1])
                for _ in range(rng.randint(0, int(0.08 * len(leak)) + 1)):
                    at = rng.randrange(len(leak) + 1)
                    leak[at:at + 1] = rng.choice([[], [rng.choice(letters)], [rng.choice(letters)] * 2])
                text += "".join(leak) + some(rng.randint(0, 8))
            docs.append((d, text))
        got = {}
        for r in decontaminate.find_leaks(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect():
            got.setdefault((r.doc_id, r.item_id), []).append((r.edits, r.end, r.start))
        for d, text in docs:
            text = decontaminate.normal(text)
            for i, item in items:
                item = decontaminate.normal(item)
                finds, ends = sorted(got.pop((d, i), [])), sellers(item, text)
                if item and min(ends) <= int(0.08 * len(item)):
                    assert finds[0][:2] == (min(ends), ends.index(min(ends)))
                    assert all(brute_edits(item, text[a:b]) == n for n, b, a in finds)
                    assert all(b <= a2 or b2 <= a for n, b, a in finds for n2, b2, a2 in finds if (b, a) != (b2, a2))
                else:
                    assert not finds
        assert not got


def test_shards_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 100)
    items = [(i, f"question number {i} asks for the capital of country {i}") for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = table(spark, [(i, "intro " + t + " outro") for i, t in items] + [(99, "nothing of the kind")])
    assert len(decontaminate.shards(bench)) > 3
    exact = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect() if r.edits == 0}
    assert exact >= {(i, i) for i, _ in items}
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()] == [99]


# ------------------------------------------------------------------ 7
def test_quality_model(spark):
    rng = random.Random(3)
    good = lambda: " ".join("".join(rng.choice("aeioumnrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 60)))
    bad = lambda: " ".join(w + rng.choice(["$$$", "###", "!!"]) for w in good().upper().split())
    rows, labels = [], []
    for i in range(400):
        y = rng.random() < 0.7
        rows.append((i, good() if y else bad()))
        labels.append((i, int(y)))
    rows += [(1000, None), (1001, ""), (1002, "longer " * 20000), (5, rows[5][1])]
    lab = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, quality int")
    df = table(spark, rows)
    model = quality_model.fit(df, lab.where("doc_id % 5 <> 0"))
    got = {r.doc_id: r.score for r in quality_model.score(df, model, "doc_id").collect()}
    assert len(got) == 403 and all(0 <= s <= 1 for s in got.values())
    held = [(i, y) for i, y in labels if i % 5 == 0]
    assert sum((got[i] >= 0.3) == bool(y) for i, y in held) / len(held) > 0.95
    again = quality_model.fit(df.repartition(3), lab.where("doc_id % 5 <> 0"))
    assert {r.doc_id: round(r.score, 6) for r in quality_model.score(df, again, "doc_id").collect()} == {i: round(s, 6) for i, s in got.items()}
    nothing = quality_model.fit(df, lab.limit(0))
    assert {r.score for r in quality_model.score(df, nothing, "doc_id").collect()} == {1.0}
    assert quality_model.score(df.limit(0), model, "doc_id").count() == 0


# ------------------------------------------------------------------ 8
PAGES = [
    ("<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
     "<div class='ad'>Buy</div><article><h1>Head</h1><p>One &amp; two<br>three</p><p> a\n b&nbsp;c </p></article>"
     "<footer>&copy; x</footer></body></html>", "Head\nOne & two\nthree\na b c"),
    ("<body><header>Site</header><main><p>Body<script>if(a<b){x('</p>')}</script> text</p><form>Name <input></form>"
     "<div class=\"comment-list\"><p>reader</p></div><aside>side</aside><p>End</p></main>", "Body text\nEnd"),
    ("<div id=\"cookie-banner\">We use</div><div>" + "word " * 30 + "</div><p>more text here</p><div role=navigation>next</div>", ("word " * 30).strip() + "\nmore text here"),
    ("<p>short</p>", "short"), ("plain &lt;b&gt; text", "plain <b> text"), ("", ""), (None, ""), ("<nav>only</nav>", ""),
    ("<article><p title='a>b'>cut off <b>here", "cut off here"),
    ("<!-- <p>no</p> --><article><p>yes</p></article>", "yes"),
    ("<article>" + "<p>x y</p>" * 20000 + "</article>", "\n".join(["x y"] * 20000)),
]


def test_html(spark):
    df = spark.createDataFrame([(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0])], "page_id long, url string, html string") \
        .withColumn("text", F.lit("clash"))
    got = html_extract.extract(df).collect()
    assert len(got) == len(PAGES) + 1
    for r in got:
        assert r.text == PAGES[r.page_id][1] and r.n_chars == len(r.text) and r.url == f"u{r.page_id}"
    assert html_extract.extract(df.limit(0)).count() == 0


def test_html_main_text_outside_a_marked_article():
    body = "<p>" + "long words " * 40 + "</p>"
    teaser = "<article><a href=/>Another page</a></article>"
    got = html_extract.main_text(f"<body><div>{body}{body}</div>{teaser}</body>")
    assert got == "\n".join(["long words " * 39 + "long words"] * 2)
    # a marked article counts more than the same text outside, and is kept whole
    page = "<div>short note</div><article><p>short body</p><aside>x</aside><aside>y</aside><p>end</p></article><div>short note</div>"
    assert html_extract.main_text(page) == "short body\nend"


def menu(n, tag="div"):
    return "".join(f"<{tag}><a href='/{i}'>Menu entry number {i}</a></{tag}>" for i in range(n))


def test_html_menus_that_nothing_names():
    """Text outside of links decides, not class names."""
    article = [f"Sentence {i} of the story, with a few words more." for i in range(8)]
    body = "".join(f"<p>{x}</p>" for x in article)
    want = "\n".join(article)
    for page in (f"<div>{menu(6)}</div><div>{body}</div><div>{menu(9)}</div>",
                 f"<ul>{menu(2, 'li')}</ul>{body}<ul>{menu(1, 'li')}</ul>",  # shorter than a window
                 f"{menu(12)}<h3>Menu</h3>{menu(12)}{body}<div><a href=x><div>More stories</div></a></div>",
                 f"<table><tr><td><a href=1>One</a> | <a href=2>Two</a></td></tr></table>{body}".replace(" | ", " ")):
        assert html_extract.main_text(page) == want, page
    # links within the text stay, alone on a line or not
    page = f"<div>{body}<p><a href=x>See the list of sources</a></p><p>And <a href=y>so</a> on.</p></div>"
    assert html_extract.main_text(page) == want + "\nSee the list of sources\nAnd so on."
    # an anchor is no link; a link without an end ends with its block
    assert html_extract.main_text(f"<a name=top>{body}") == want
    assert html_extract.main_text(f"{menu(5)}<p><a href=x>Start</p>{body}") == want
    # a page of nothing but links
    assert html_extract.main_text("<p><a href=x>only this</a></p>") == "only this"


def test_html_left_out_lines_are_no_gap_of_their_own():
    long = "Body text that goes on for a while. " * 5
    for ad in ("<div class=ad>Buy this</div>", "<div class=ad><p>Buy</p><p>this</p></div>", "<script>x</script>", "<form></form>", "<div class=ad></div>" * 5):
        got = html_extract.main_text(f"<p>Short intro.</p>{ad}<p>{long}</p>{ad}<p>End.</p>")
        assert got == f"Short intro.\n{long.strip()}\nEnd.", ad
    # a list of some lines is one
    assert html_extract.main_text(f"<p>Skip this</p><nav><ul><li>One<li>Two<li>Three<li>Four</ul></nav><p>{long}</p>") == long.strip()
    # not within an article
    page = f"<article><p>Intro.</p><aside>{'<p>note</p>' * 9}</aside><p>{long}</p></article>"
    assert html_extract.main_text(page) == f"Intro.\n{long.strip()}"


def test_html_end_tags_that_are_left_out():
    body = "The text " * 12
    want = body.strip()
    for page in (f"<div><p class=ad>Buy<p>{body}</div>", f"<div><p class=ad>Buy <b>now</div><div>{body}</div>", f"<div><p class=ad>Buy<h2>{body}</h2></div>",
                 f"<ul><li class=ad>Buy<ul><li>more</ul><li>{body}</ul>", f"<ul><li class=ad>Buy</ul>{body}", f"<div><p class=ad>Buy</b> now<br>more</p>{body}</div>",
                 f"<table><tr><td class=ad>Buy<table><tr><td>x</table><td>{body}</table>", f"<table><tr><td class=ad>Buy<tr><td>{body}</table>"):
        assert html_extract.main_text(page) == want, page


def test_line_blocks():
    assert html_extract.text_blocks([0, 0, 5, 0, 7, 0, 0, 0, 3, 0]) == [(2, 5), (8, 10)]
    assert html_extract.text_blocks([]) == [] and html_extract.text_blocks([0, 0]) == []


def test_html_of_the_given_pages(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    n = 0
    for r in html_extract.extract(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect():
        i = r.url.split("?")[0].split("#")[0].rpartition("/")[2]
        if i.isdigit() and int(i) in docs:
            lines = [" ".join(x.split()) for x in docs[int(i)].split("\n")]
            assert r.text.split("\n")[1:] == [x for x in lines if x]
            n += 1
    assert n > 20


# ------------------------------------------------------------------ 9
def counts_brute(t):
    w = brute.words(t)
    lines = [x for x in (t or "").split("\n") if brute.words(x)]
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    many = {k for k, c in Counter(win).items() if c > 1}
    cover = {i + j for i, k in enumerate(win) if k in many for j in range(5)}
    return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_quality_rules(spark):
    rng = random.Random(12)
    plain = lambda: " ".join("".join(rng.choice("aeioumnérst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(15, 60)))
    rows = [(i, plain(), rng.choice(["en", "fr"]), rng.choice(["s1", "s2", None])) for i in range(300)]
    junk = {}
    for i in range(20):
        junk[1000 + i] = [" ".join(w + "$$$" for w in plain().split()), "ab cd\n" * 30, "buy now or never ok " * 12][i % 3]
    rows += [(i, t, "en", "s1") for i, t in junk.items()] + [(2000, None, None, None), (2001, "", "en", "s1"), (2002, "few words", "en", "s1"), (2003, "a#b\n\na#b\n \na#b", "xx", "new")]
    rows.append(rows[0])
    got = quality_rules.judge(table(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        c = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert c == counts_brute(texts[r.doc_id]), r.doc_id
        assert r.base_failed == (c[0] < 10 or 100 * c[4] > 20 * c[0])
        assert not (r.base_failed and r.kept)
    assert all(r.kept for r in got if r.doc_id < 1000) and not any(r.kept for r in got if r.doc_id >= 1000)
    assert quality_rules.judge(table(spark, []).limit(0)).count() == 0


def plain_kept(rows):
    """(lang, source, five counts) -> kept, by the rule as the module states it."""
    rate = {"symbol_rate": lambda c: min(2000, 1000 * c[2] // max(c[1], 1)), "repeat_rate": lambda c: min(2000, 1000 * c[4] // max(c[0], 1)),
            "dup_line_rate": lambda c: min(2000, 1000 * c[3] // max(c[0], 1)), "word_length": lambda c: min(2000, 10 * c[1] // max(c[0], 1))}

    def quartile(values, q):
        v = sorted(values)
        return next(x for k, x in enumerate(v, 1) if 4 * k >= q * len(v))

    out = []
    for la, so, c in rows:
        ok = not (c[0] < 10 or 100 * c[4] > 20 * c[0])
        for name, f in rate.items():
            own = [f(x) for a, b, x in rows if (a, b) == (la, so)]
            lang, whole = [f(x) for a, b, x in rows if a == la], [f(x) for *_, x in rows]
            q1, q3 = ((len(own) * quartile(own, q) + 50 * ((len(lang) * quartile(lang, q) + 50 * quartile(whole, q)) / (len(lang) + 50))) / (len(own) + 50) for q in (1, 3))
            slack, two = quality_rules.RATES[name]
            ok = ok and f(c) <= q3 + 3 * (q3 - q1) + slack and (not two or f(c) >= q1 - 3 * (q3 - q1) - slack)
        out.append(ok)
    return out


def odd_source(n, first=0, seed=3):
    """Texts full of symbols: normal in a source of their own."""
    rng = random.Random(seed)
    return [(first + i, " ".join("ab$" * rng.randint(1, 2) for _ in range(rng.randint(12, 40))) + f" {i}", "en", "odd") for i in range(n)]


@pytest.mark.parametrize("n_odd", [1, 40, 200])
def test_kept_against_plain_limits(spark, n_odd):
    rng = random.Random(n_odd)
    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(rng.randint(2, 9)))
    rows = [(i, " ".join(word() + rng.choice(["", "", "", "#"]) for _ in range(rng.randint(5, 60))), rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for i in range(150)]
    rows += odd_source(n_odd, 1000) + [(2000, "x$$$$$$ " * 3 + " ".join(word() for _ in range(20)), "en", "a"), (2001, None, "en", "a")]
    got = {r.doc_id: r.kept for r in quality_rules.judge(table(spark, rows)).collect()}
    assert got == dict(zip([r[0] for r in rows], plain_kept([(r[2], r[3], counts_brute(r[1])) for r in rows])))


def test_limits_have_no_step(spark):
    """With each further document of a source its limits move a little: there
    is no size at which another rule takes over."""
    plain = [(i, " ".join("word" for _ in range(9)) + f" {i} " + "other words here", "en", "a") for i in range(200)]
    highs = []
    for n in (10, 30, 49, 50, 51):
        rated = quality_rules.rates(quality_rules.text_counts(table(spark, plain + odd_source(n, 1000)), "doc_id", "lang", "source"))
        highs.append(quality_rules.limits(quality_rules.sketches(rated)).where("source = 'odd'").first().symbol_rate_high)
    assert highs == sorted(highs) and highs[-1] > 1.9 * highs[0]
    assert max(highs[3] - highs[2], highs[4] - highs[3]) < 10


def test_sketches_merge(spark):
    rows = [(i, " ".join("x" * (i % 7 + 1) for _ in range(12)) + str(i), "en", "s") for i in range(100)]
    rated = quality_rules.rates(quality_rules.text_counts(table(spark, rows), "doc_id", "lang", "source"))
    whole = {(r.rate, r.bin): r.n for r in quality_rules.merge(quality_rules.sketches(rated)).collect()}
    halves = quality_rules.sketches(rated.where("doc_id < 40")).unionByName(quality_rules.sketches(rated.where("doc_id >= 40")))
    assert {(r.rate, r.bin): r.n for r in quality_rules.merge(halves).collect()} == whole


# ------------------------------------------------------------------ 10
def test_every_language_is_learned(spark):
    """However many there are, and however unequal; copies count once, and the
    sample depends on the rows alone."""
    rows = [(i, f"text {i} of language {i % 1100}", f"l{i % 1100}") for i in range(1200)] + [(5000, "the same copy", "hot")] * 900 + [(6000 + i, f"hot text {i}", "hot") for i in range(500)]
    df = table(spark, rows)
    text, lang = language_id.training_windows(df)
    assert set(lang) == {r[2] for r in rows} and lang.count("hot") == 2 and len(text) <= 1101 * 2
    assert (text, lang) == language_id.training_windows(df.repartition(7))


def test_language(spark):
    rng = random.Random(1)
    stems = {"en": ["the", "ing", "wh", "tion"], "de": ["sch", "ung", "ä", "keit"], "es": ["ción", "os", "ll", "ñ"]}
    text = lambda lang, n: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = []
    for i in range(450):
        lang = rng.choice(list(stems))
        rows.append((i, text(lang, rng.randint(8, 120)), lang))
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "123 -- 456", "en"), (1003, "ñññ ñ", None), (1004, text("de", 20000), "de"), (5, rows[5][1], rows[5][2])]
    df = table(spark, rows)
    model = language_id.fit(df.where("doc_id % 3 <> 1"))
    assert model["names"] == ["de", "en", "es"]
    got = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    assert len(got) == 455 and all(0 <= r.score <= 1 for r in got.values())
    held = [r for r in rows[:450] if r[0] % 3 == 1]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) / len(held) > 0.97
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1003].lang_pred != "und" and got[1004].lang_pred == "de"
    assert {r.lang_pred for r in language_id.identify(df, language_id.fit(df.where("false"))).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0


def test_pair_tables_equal_the_network():
    rng = np.random.default_rng(2)
    p = {"emb": rng.normal(size=(256, language_id.EMBED)), "out": np.eye(24, 3), "bias": np.zeros(3)}
    for k in language_id.WIDTHS:
        p[f"w{k}"], p[f"b{k}"] = rng.normal(size=(k * language_id.EMBED, language_id.FILTERS)), rng.normal(size=language_id.FILTERS)
    x = rng.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    model = {"names": ["a", "b", "c"], **language_id.pair_tables(p), "out": np.eye(24, 3), "bias": np.zeros(3)}
    e, f = p["emb"][x], []
    for k in language_id.WIDTHS:
        cols = np.concatenate([e[:, j:language_id.WINDOW - k + 1 + j] for j in range(k)], axis=2)
        f.append(np.maximum((cols @ p[f"w{k}"] + p[f"b{k}"]).max(1), 0))
    s = np.concatenate(f, 1) @ model["out"]
    s = np.exp(s - s.max(1, keepdims=True))
    assert np.allclose(language_id.predict(model, x), s / s.sum(1, keepdims=True), atol=1e-4)


def test_folds():
    assert zlib.crc32(b"12") % 5 == brute.crc(12, 5)
