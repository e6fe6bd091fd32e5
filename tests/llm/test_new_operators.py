"""WARC archives, ranked lexical search and importance resampling against
plain versions, with hard cases."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from snaphist.llm import importance, lexical_search, queries, warc
from snaphist.llm.ship import ship

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ("key", "uri", "payload", "first_key", "digest", "n", "bucket", "score", "rank", "part", "at", "salt", "term", "item")


@pytest.fixture(autouse=True)
def sources(spark):
    ship(spark)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASH})


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumns({c: F.lit("x") for c in CLASH})


def texts(seed, n=60):
    rng = random.Random(seed)
    vocab = ["a", "B", "the", "The", "naïve", "ÑU", "x1", "É", "zeta", "w_o", "0"]
    seps = [" ", "\n", "-", "'", "_", "  ", "\x00", " "]
    some = lambda k: "".join(rng.choice(vocab) + rng.choice(seps) for _ in range(k))
    base = some(30)
    rows = [(i * 7 % 101, rng.choice([some(rng.randint(0, 60)), base, "", None, " -- ", some(22)])) for i in range(n)]
    return [*rows, (2000, some(30_000)), (2001, "q" * 100_000 + " the"), (2002, base)]


# ------------------------------------------------------------------------ 11
def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in CLASH})


def archived(spark, tmp_path, rows, name="a", **options):
    path = str(tmp_path / name)
    warc.write_archive(pages(spark, rows), path, **options)
    return path


def expected_pages(rows):
    sha = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for k, _, h in rows:
        if k is not None:
            first[sha(h)] = min(first.get(sha(h), k), k)
    out = []
    for k, _, h in rows:
        f = first.get(sha(h))
        again = f is not None and f != k
        out.append((k, len((h or "").encode()), sha(h), "revisit" if again else "response", f if again else None))
    return Counter(out)


HARD = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
PAGES = [(4, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (9, None, None), (8, "", ""), (7, "http://b\r\nX: y", HARD * 9), (5, "u", "0\r\n\r\n" * 40),
         (3, "long", "<b>ñ" * 60_000), (6, "long again", "<b>ñ" * 60_000), (None, "n", "<p>é</p>"), (None, "m", "only without id"), (2, "http://a/2", "<p>é</p>"), (11, "s", "WARC/1.1\r\n" * 30)]


@pytest.mark.parametrize("segment, compression", [(16 << 10, "gzip"), (40, "none"), (301, "gzip")])
def test_archive_round_trip(spark, tmp_path, segment, compression):
    path = archived(spark, tmp_path, PAGES, segment_bytes=segment, compression=compression)
    got = warc.read_archive(spark, path)
    rows = got.collect()
    assert {r.fault for r in rows} == {None}
    html = {(k, h or "") for k, _, h in PAGES}
    assert all((r.key, bytes(r.payload).decode()) in html for r in rows if r.record_type == "response")
    assert {r.uri for r in rows if r.key == 7} == {"http://b%0D%0AX: y"} and {r.uri for r in rows if r.key in (8, 9)} == {None}
    sizes = warc.payload_sizes(got).select("key", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, sizes.collect())) == expected_pages(PAGES)


def test_archive_is_plain_warc(spark, tmp_path):
    path = archived(spark, tmp_path, PAGES, segment_bytes=1000)
    raw = b"".join(gzip.open(f).read() for f in sorted((tmp_path / "a").glob("*.gz")))
    kinds, ids, at = Counter(), set(), 0
    while at < len(raw):  # by Content-Length alone
        head, _, _ = raw[at:].partition(b"\r\n\r\n")
        f = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n")
        kinds[f[b"WARC-Type"]] += 1
        ids.add(f[b"WARC-Record-ID"])
        at += len(head) + 4 + int(f[b"Content-Length"])
        assert raw[at:at + 4] == b"\r\n\r\n"
        at += 4
    assert kinds[b"revisit"] == 4 and kinds[b"response"] == 8 and kinds[b"continuation"] > 200 and len(ids) == sum(kinds.values())
    assert warc.read_archive(spark, path).count() == len(PAGES)


def test_small_payloads_are_never_revisits(spark, tmp_path):
    path = archived(spark, tmp_path, [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")], min_revisit_bytes=3)
    assert sorted((r.key, r.record_type) for r in warc.read_archive(spark, path).collect()) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty_archive(spark, tmp_path):
    path = archived(spark, tmp_path, [])
    assert warc.payload_sizes(warc.read_archive(spark, path)).count() == 0


def damaged(spark, tmp_path, change):
    """Faults by key after ``change`` of the list of records."""
    new = iter(range(10_000))
    kept = []
    for k, text in ((1, "abc" * 500), (2, "one"), (3, "z" * 1000)):
        kept += list(warc.page_records(k, "u", text.encode(), None, lambda: f"<urn:x:{next(new)}>", 400, warc.DATE))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "part.txt").write_bytes(b"".join(r + b"\r\n" for r in change(kept)))
    rows = warc.read_archive(spark, str(tmp_path / "d"))
    found = {r.key: r.fault for r in rows.collect() if r.fault}
    if found:
        with pytest.raises(Exception, match="with a fault"):
            warc.payload_sizes(rows)
    return found


def test_order_of_segments_does_not_matter(spark, tmp_path):
    assert damaged(spark, tmp_path, lambda r: r[::-1]) == {}


@pytest.mark.parametrize("change, fault", [
    (lambda r: [x for x in r if b"Segment-Number: 2" not in x], {1: "segments", 3: "segments"}),
    (lambda r: [x for x in r if b"Total-Length" not in x], {1: "segments", 3: "segments"}),
    (lambda r: [x.replace(b"Total-Length: 1", b"Total-Length: 2") for x in r], {1: "total_length", 3: "total_length"}),
    (lambda r: [x.replace(b"one", b"two") for x in r], {2: "digest"}),
    (lambda r: [x.replace(b"\r\n3\r\none", b"\r\n9\r\none") for x in r], {2: "chunks"}),
    (lambda r: r[:-1] + [r[-1][:-40]], {3: "content_length", }),
])
def test_faults(spark, tmp_path, change, fault):
    got = damaged(spark, tmp_path, change)
    assert {k: v for k, v in got.items() if k is not None} == fault


def test_dechunk():
    assert warc.dechunk(b"3;x=1\r\nabc\r\n2 \r\nde\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcde"
    for bad in (b"", b"3\r\nab", b"x\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"0\r\n", b"0\r\n\r\nmore"):
        assert warc.dechunk(bad) is None
    for n in (0, 1, 4096, 4097, 20_000):
        assert warc.dechunk(warc.chunked(b"q" * n)) == b"q" * n


def test_records_that_run_into_one_row():
    """The line reader may miss a separator, or see one inside a block."""
    new = iter(range(99))
    recs = [r for k, p in ((1, b"a"), (2, HARD.encode()), (3, b"")) for r in warc.page_records(k, "u", p, None, lambda: f"<{next(new)}>", 9999, warc.DATE)]
    plain = warc.record("response", "<x>", b"HTTP/1.1 200 OK\r\n\r\n" + HARD.encode(), warc.DATE, Record_Key=4)
    raw = b"".join(r + b"\r\n" for r in [*recs, plain])
    want = [f["warc-record-id"] for f, _, fault in warc.split_records(iter([raw])) if not fault]
    for rows in ([raw], raw.split(warc.NEXT_RECORD), raw.replace(warc.NEXT_RECORD, b"\0", 1).split(b"\0")):
        got = list(warc.split_records(iter(rows)))
        assert [f["warc-record-id"] for f, _, _ in got] == want and {x[2] for x in got} == {None} and got[-1][1].endswith(HARD.encode())


# ------------------------------------------------------------------------ 12
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, asked, top=20):
    terms = lambda t: TERM.findall((t or "").translate(ASCII_LOWER))
    tf = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in tf)
    length = sum(c.total() for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for w, n in df.items()}
    by_item: dict = {}
    for i, t in asked:
        if i is not None:
            by_item[i] = by_item.get(i, Counter()) + Counter(terms(t))
    out = []
    for i, q in by_item.items():
        found = []
        for d, c in tf:
            m = 100 - 25 + ((25 * c.total() * n_docs) // length if length else 0)
            score = sum(k * weight[w] * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m)) for w, k in q.items() if c[w])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, k, x[3], -x[0]) for k, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, shard", [(1, 4 << 20), (2, 30)])
def test_search(spark, monkeypatch, seed, shard):
    monkeypatch.setattr(lexical_search, "CHUNK_BYTES", 4000)
    docs = [*texts(seed), (None, "naïve zeta"), (7, "zeta zeta x1")]
    asked = [(1, "The naïve x1"), (2, "zeta ZETA É"), (3, None), (4, "--"), (5, "nowhere"), (6, "q" * 100_000), (2, "a"), (None, "the"), (8, "ñu w o 0"), (9, "ÑU")]
    got = lexical_search.search(documents(spark, docs), items(spark, asked), shard_bytes=shard)
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == plain_search(docs, asked)


def test_search_keeps_ties_by_id_and_all_of_few(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", 3)
    docs = [(k, "same words") for k in range(50, 0, -1)] + [(99, "same"), (None, "same words")] + [(k, "other") for k in range(100, 180)]
    asked = [(1, "words"), (2, "same")]
    got = lexical_search.search(documents(spark, docs).repartition(7), items(spark, asked))
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == plain_search(docs, asked)
    none = documents(spark, docs).limit(0)
    assert lexical_search.search(none, items(spark, asked)).count() == 0
    assert lexical_search.search(documents(spark, docs), items(spark, asked).limit(0)).count() == 0


# ------------------------------------------------------------------------ 13
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_resample(docs, target):
    def buckets(t):
        w = WORD.findall((t or "").translate(ASCII_LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    each = [(i, *buckets(t)) for i, t in docs]
    s, t = Counter(b for *_, f in each for b in f), Counter(b for x in target for b in buckets(x)[1])
    big_s, big_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    out, n = [], 0
    for i, words, f in each:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        n += words >= 20
    able = sorted((x for x, (_, words, _) in zip(out, each) if words >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for k, x in enumerate(able[:5 * n // 100], 1):
        x[4] = k
    return Counter(map(tuple, out))


@pytest.mark.parametrize("seed, chunk", [(3, 1 << 20), (4, 500)])
def test_resampling(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(importance, "CHUNK_BYTES", chunk)
    docs = [*texts(seed, 150), (None, "a " * 25), (None, None), (3, "the zeta " * 15), (3, "the zeta " * 15)]
    target = ["the zeta the zeta x1", None, "", "naïve ÑU"]
    got = importance.resample(documents(spark, docs).repartition(5), items(spark, list(enumerate(target))))
    assert Counter(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect())) == plain_resample(docs, target)


def test_resampling_of_equal_rows_and_nothing(spark):
    docs = [(5, "the zeta " * 15)] * 400
    asked = items(spark, [(1, "the")])
    ranks = sorted(r.rank for r in importance.resample(documents(spark, docs), asked).collect() if r.rank)
    assert ranks == list(range(1, 21))
    assert importance.resample(documents(spark, docs).limit(0), asked).count() == 0
    assert importance.resample(documents(spark, docs), asked.limit(0)).where("rank IS NOT NULL").count() == 20


def test_joined_checksums():
    import numpy as np
    rng = random.Random(5)
    some = [(rng.randbytes(rng.randint(0, 9)), rng.randbytes(rng.choice([0, 1, 3, 70, 5000]))) for _ in range(200)]
    left, right = (np.array([zlib.crc32(x[k]) for x in some], np.uint32) for k in (0, 1))
    got = importance.crc_joined(left, right, np.array([len(b) for _, b in some], np.int64))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in some]


def test_registered_queries_agree_on_rerun(spark):
    for name in ("op12_lexical_search", "op13_importance_resampling"):
        assert Counter(map(tuple, queries.QUERIES[name](spark, SF_SMALL).collect())) == Counter(map(tuple, queries.QUERIES[name](spark, SF_SMALL).collect()))
