"""The pipeline's stages, each on its own input, against plain versions."""

import brute
import pytest
import corpus_pipeline as cp
from conftest import SF_SMALL
from pyspark.sql import functions as F
from snaphist.llm import quality_model
from snaphist.llm.queries import fold
from snaphist.llm.ship import ship
from test_operators import near_brute


@pytest.fixture(autouse=True)
def sources(spark):
    ship(spark)


def stage(spark, k, docs, sf=SF_SMALL):
    return cp.STAGES[k][1](spark, docs, sf)


def documents(spark):
    """The smallest tables, with rows that have NULLs and odd columns."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(90001, None, None, None, None), (90002, "", "en", "src0", 0), (90003, "w " * 30, "en", None, 60)], docs.schema)
    return docs.unionByName(odd).withColumns({c: F.lit(1) for c in ("block", "score", "size", "n")})


def test_stage_names_and_columns(spark):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "mix_sources"]
    docs = documents(spark)
    for k in range(4):
        assert stage(spark, k, docs).columns == cp.COLUMNS
        assert stage(spark, k, docs.limit(0)).count() == 0


def test_quality_stage_keeps_what_the_model_keeps(spark):
    docs = documents(spark)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = quality_model.fit(docs, labels.where(fold(5) != 0))
    scores = {r.doc_id: r.score for r in quality_model.score(docs, model, "doc_id").collect()}
    kept = {r.doc_id for r in stage(spark, 0, docs).collect()}
    assert kept == {i for i, s in scores.items() if s >= quality_model.THRESHOLD}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    wrong = [i for i, y in truth.items() if (i in kept) != bool(y)]
    assert len(wrong) <= 0.05 * len(truth)


def test_near_duplicate_stage(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    first = {i for i, _, c in near_brute(rows, 5, 80) if i == c}
    assert {r.doc_id for r in stage(spark, 1, docs).collect()} == first


def test_near_duplicate_stage_has_its_own_rule_and_drops_equal_rows(spark):
    """Five words and 0.8 (op2: four words and 0.85), one of each equal row."""
    a = [f"w{i}" for i in range(100)]
    b = [*a[:50], "new", *a[51:]]  # 4 words: 93 of 101 common, 5 words: 91 of 101
    c = [f"v{i}" for i in range(100)]
    d = ["x", *c[1:40], "y", *c[41:80], "z", *c[81:]]  # 4 words: 88 of 106 (0.83), 5 words: 85 of 107 (0.79)
    e = [f"u{i}" for i in range(100)]
    f = [*e[:50], "y", *e[51:97], "z", *e[98:]]  # 4 words: 90 of 104 (0.87), 5 words: 88 of 104 (0.85)
    g = [f"t{i}" for i in range(60)]
    h = ["x", *g[1:30], "y", *g[31:]]  # 4 words: 52 of 62 (0.84), 5 words: 50 of 62 (0.81)
    rows = [(i, " ".join(x), "en", "s", 1) for i, x in enumerate((a, b, c, d, e, f, g, h))]
    rows += [(20, "equal in both " * 4, "en", "s", 1), (20, "equal in both " * 4, "en", "r", 1), (20, "equal in id only", "en", "s", 1),
             (None, "no id here at all", "en", "s", 1), (None, "no id here at all", "en", "s", 1), (None, None, None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, (r.text or "")[:9], r.source) for r in stage(spark, 1, docs).collect()), key=str)
    want = [(0, "w0 w1 w2 ", "s"), (2, "v0 v1 v2 ", "s"), (3, "x v1 v2 v", "s"), (4, "u0 u1 u2 ", "s"), (6, "t0 t1 t2 ", "s"),
            (20, "equal in ", "r"), (20, "equal in ", "s"), (None, "no id her", "s"), (None, "", None)]
    assert got == sorted(want, key=str)


def test_repeated_passages_stage(spark):
    docs = documents(spark)
    rows = {r.doc_id: r for r in docs.collect()}
    gone = brute.removed_tokens([(i, r.text) for i, r in rows.items()], 13, brute.words)
    got = {r.doc_id: r for r in stage(spark, 2, docs).collect()}
    for i, (words, flags) in gone.items():
        if words and all(flags):
            assert i not in got
        elif not any(flags):
            assert (got[i].text, got[i].n_chars) == (rows[i].text, rows[i].n_chars)
        else:
            assert brute.words(got[i].text) == [w for w, g in zip(words, flags) if not g]
            assert got[i].n_chars == len(got[i].text)


def test_leak_stage(spark):
    docs = documents(spark)
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = {r.doc_id for r in stage(spark, 3, docs).collect()}
    for r in docs.collect():
        text = " ".join((r.text or "").lower().split())
        if any(x in text for x in items):
            assert r.doc_id not in got
        elif r.doc_id > 90000:
            assert r.doc_id in got


def test_run_chains_the_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for k in range(4):
        docs = stage(spark, k, docs).checkpoint()
    want = {(r.doc_id, r.size, r.taken) for r in stage(spark, 4, docs).collect()}
    got = cp.run(spark, SF_SMALL)
    assert {(r.doc_id, r.size, r.taken) for r in got.collect()} == want
    assert cp.ORACLE_SQL is None
