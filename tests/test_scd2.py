"""SCD2 merge semantics, both plan forms against a brute-force model, and
replay against iterated merges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snaphist.contracts import crm_contracts
from snaphist.contracts import ts_literal
from snaphist.operators.scd2 import GENERAL, RUN_COLUMNS, SPLIT, UNION, change_summary, run_ends, scd2_merge, scd2_replay, scd2_splice

DEALS = crm_contracts("source")["deals"]
COLS = DEALS.columns
T0 = datetime(2024, 1, 1)
ATTRS = ("properties_json", "archived", "source_updated_at", "source_created_at")


def stg(spark, rows, run, ts):
    """rows: (id, props, created) -> staging rows of a run."""
    data = [{"source_id": i, "properties_json": p, "source_created_at": c, "raw_json": f"raw-{run}-{i}",
             "archived": False, "_ingested_at": ts, "_ingestion_run_id": run, "_source_system": "crm",
             "_valid_from": ts, "_valid_to": None, "_is_current": True, "object_type": "deals"}
            for i, p, c in rows]
    return spark.createDataFrame(data, DEALS.schema) if data else spark.createDataFrame([], DEALS.schema)


def tup(df):
    return sorted(((r.source_id, r.properties_json, r._ingestion_run_id, r._valid_from, r._valid_to, r._is_current)
                   for r in df.collect()), key=repr)


# ---------------------------------------------------------------- brute force
def sig(r):
    return tuple("" if r[a] is None else (str(r[a]).lower() if isinstance(r[a], bool) else str(r[a]))
                 for a in ATTRS)


def brute_merge(target, staging, close_missing=True):
    """The three statements, executed literally on lists of dicts."""
    t = [dict(r) for r in target]
    smax = max((s["_valid_from"] for s in staging), default=None)
    for r in t:  # close changed
        if r["_is_current"] is True:
            same = [s for s in staging if s["source_id"] is not None and s["source_id"] == r["source_id"]]
            if any(sig(s) != sig(r) for s in same):
                r["_valid_to"] = max(s["_valid_from"] for s in same)
                r["_is_current"] = False
    if close_missing:
        for r in t:
            if r["_is_current"] is True and not any(
                    s["source_id"] is not None and s["source_id"] == r["source_id"] for s in staging):
                r["_valid_to"] = smax
                r["_is_current"] = False
    ins = [dict(s) for s in staging if not any(
        r["source_id"] is not None and r["source_id"] == s["source_id"] and r["_is_current"] is True for r in t)]
    return t + ins


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_forms_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    target = spark.createDataFrame([], DEALS.schema)
    model = []
    for run in range(5):
        ts = T0 + timedelta(days=run)
        n = 0 if (seed == 2 and run == 3) else rnd.randint(5, 25)  # seed 2 has an empty extract
        ids = rnd.sample(range(30), n)
        rows = [(str(i), rnd.choice(['{"a":1}', '{"a":2}', None, ""]), rnd.choice([None, "", "c"])) for i in ids]
        s = stg(spark, rows, f"r{run}", ts)
        cm = not (seed == 3 and run == 2)
        model = brute_merge(model, as_dicts(s), close_missing=cm)
        general = scd2_merge(target, s, DEALS, close_missing=cm, form=GENERAL)
        split = scd2_merge(target, s, DEALS, close_missing=cm, form=SPLIT)
        g = tup(general)
        assert g == tup(split)
        assert g == tup(scd2_merge(target, s, DEALS, close_missing=cm, form=UNION))
        want = sorted(((r["source_id"], r["properties_json"], r["_ingestion_run_id"], r["_valid_from"],
                        r["_valid_to"], r["_is_current"]) for r in model), key=repr)
        assert g == want
        target = spark.createDataFrame(general.collect(), DEALS.schema)


def test_null_equals_blank_and_raw_only_change(spark):
    h1 = scd2_merge(spark.createDataFrame([], DEALS.schema), stg(spark, [("1", None, "")], "r1", T0), DEALS)
    s2 = stg(spark, [("1", "", None)], "r2", T0 + timedelta(days=1))
    h2 = scd2_merge(h1, s2, DEALS, form=SPLIT)
    rows = h2.collect()
    assert len(rows) == 1 and rows[0]._ingestion_run_id == "r1" and rows[0].raw_json == "raw-r1-1"


def test_empty_extract_closes_all_with_null_end(spark):
    h1 = scd2_merge(spark.createDataFrame([], DEALS.schema), stg(spark, [("1", "a", "c"), ("2", "b", "c")], "r1", T0),
                    DEALS)
    h2 = scd2_merge(h1, stg(spark, [], "r2", T0), DEALS, form=SPLIT)
    assert [(r._is_current, r._valid_to) for r in h2.collect()] == [(False, None), (False, None)]


def test_reopen_leaves_gap(spark):
    e = spark.createDataFrame([], DEALS.schema)
    h = scd2_merge(e, stg(spark, [("1", "a", "c"), ("2", "a", "c")], "r1", T0), DEALS)
    h = scd2_merge(h, stg(spark, [("2", "a", "c")], "r2", T0 + timedelta(days=1)), DEALS, form=SPLIT)
    h = scd2_merge(h, stg(spark, [("1", "a", "c"), ("2", "a", "c")], "r3", T0 + timedelta(days=2)), DEALS,
                   form=SPLIT)
    got = [(r.source_id, r._ingestion_run_id, r._valid_to, r._is_current)
           for r in h.where("source_id = '1'").orderBy("_valid_from").collect()]
    assert got == [("1", "r1", T0 + timedelta(days=1), False), ("1", "r3", None, True)]


def test_partial_extract_keeps_missing_open(spark):
    e = spark.createDataFrame([], DEALS.schema)
    h = scd2_merge(e, stg(spark, [("1", "a", "c"), ("2", "a", "c")], "r1", T0), DEALS)
    h = scd2_merge(h, stg(spark, [("2", "b", "c")], "r2", T0 + timedelta(days=1)), DEALS, close_missing=False,
                   form=SPLIT)
    assert tup(h.where("_is_current")) == [
        ("1", "a", "r1", T0, None, True), ("2", "b", "r2", T0 + timedelta(days=1), None, True)]


def test_corrupt_target_general_form(spark):
    """Two current rows for a key: each closes on its own difference; no
    insert while one stays open; NULL-key current rows close as missing."""
    s1 = stg(spark, [("1", "a", "c")], "r1", T0)
    dup = stg(spark, [("1", "b", "c"), (None, "z", "c")], "r0", T0)
    target = s1.unionByName(dup)
    for form in (GENERAL, UNION):
        out = scd2_merge(target, stg(spark, [("1", "a", "c")], "r2", T0 + timedelta(days=1)), DEALS, form=form)
        got = sorted(((r.source_id, r.properties_json, r._is_current) for r in out.collect()), key=repr)
        assert got == sorted([(None, "z", False), ("1", "a", True), ("1", "b", False)], key=repr)


def test_change_summary(spark):
    e = spark.createDataFrame([], DEALS.schema)
    h = scd2_merge(e, stg(spark, [("1", "a", "c"), ("2", "a", "c"), ("3", "a", "c")], "r1", T0), DEALS)
    s2 = stg(spark, [("2", "b", "c"), ("3", "a", "c"), ("4", "a", "c")], "r2", T0 + timedelta(days=1))
    r = change_summary(h, s2, DEALS).first().asDict()
    assert r == {"staged": 3, "opened": 2, "inserted_new": 1, "closed_changed": 1, "closed_missing": 1,
                 "unchanged": 1}


def test_replay_equals_iterated_merges(spark):
    """D7 over the sf0.001 events equals merging the daily snapshots one by one."""
    from conftest import SF_SMALL
    from snaphist.plans.queries import event_staging
    staged, runs = event_staging(spark, SF_SMALL)
    replayed = tup(scd2_replay(staged, runs, DEALS))
    run_rows = runs.orderBy("run_seq").collect()
    hist = spark.createDataFrame([], DEALS.schema)
    for i, r in enumerate(run_rows):
        day = staged.where(F.col("run_seq") == r.run_seq).select(*COLS)
        hist = scd2_merge(hist, day, DEALS, form=SPLIT)
        if i % 5 == 4:
            hist = hist.checkpoint()  # cut lineage in the shared checkpoint dir
    assert replayed == tup(hist)


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the extract and of the open target rows: the
    general form stays exact and the gate reports the repeats as one row."""
    from snaphist.operators import gates
    rnd = random.Random(7)
    t_rows = [("hot", rnd.choice(["a", "b"]), "c") for _ in range(60)] + [(str(i), "a", "c") for i in range(120)]
    s_rows = [("hot", rnd.choice(["a", "b"]), "c") for _ in range(60)] + [(str(i), rnd.choice(["a", "b"]), "c")
                                                                        for i in range(60, 180)]
    target = stg(spark, t_rows, "r1", T0)
    staging = stg(spark, s_rows, "r2", T0 + timedelta(days=1))
    got = tup(scd2_merge(target, staging, DEALS, form=GENERAL))
    assert got == tup(scd2_merge(target, staging, DEALS, form=UNION))
    model = brute_merge(as_dicts(target), as_dicts(staging))
    want = sorted(((r["source_id"], r["properties_json"], r["_ingestion_run_id"], r["_valid_from"],
                    r["_valid_to"], r["_is_current"]) for r in model), key=repr)
    assert got == want
    dup = [r for r in gates.violations(staging, DEALS, source_system="crm").collect() if r.rule == "duplicate_key"]
    assert len(dup) == 1 and dup[0].occurrences == 59


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_union_form_on_doubled_keys(spark, seed):
    """Repeated keys on either side, NULL keys, NULL and false open flags."""
    rnd = random.Random(seed)
    rows = lambda n: [(rnd.choice(["1", "2", "3", "4", "5", None]), rnd.choice(["a", "b", None]), "c") for _ in range(n)]
    target = stg(spark, rows(14), "r1", T0).withColumn("_is_current", F.when(F.rand(seed) < 0.8, F.rand(seed + 1) < 0.8))
    target = spark.createDataFrame(target.collect(), DEALS.schema)
    staging = stg(spark, rows(9), "r2", T0 + timedelta(days=1)).unionByName(stg(spark, rows(3), "r2", T0 + timedelta(days=2)))
    for cm in (True, False):
        want = brute_merge(as_dicts(target), as_dicts(staging), close_missing=cm)
        got = as_dicts(scd2_merge(target, staging, DEALS, close_missing=cm, form=UNION))
        key = lambda r: repr([(c, r[c]) for c in COLS])
        assert sorted(map(key, got)) == sorted(map(key, want))


def random_runs(spark, rnd, n, sampled=()):
    """Per run its rows (some runs are empty), and the run list."""
    runs = []
    for i in range(n):
        keys = [] if rnd.random() < 0.15 else rnd.sample(range(8), rnd.randint(1, 8))
        runs.append([(str(k), rnd.choice("abb"), "c") for k in keys])
    listed = spark.createDataFrame([(i + 1, T0 + timedelta(days=i), i in sampled) for i in range(n)], "run_seq int, _valid_from timestamp, sampled boolean")
    return runs, listed


def snapshots(spark, runs, listed, leave_out=()):
    rows = [r for i, x in enumerate(runs) if i not in leave_out for r in stg(spark, x, f"r{i}", T0 + timedelta(days=i)).withColumn("run_seq", F.lit(i + 1)).collect()]
    schema = stg(spark, [], "r", T0).withColumn("run_seq", F.lit(1)).schema
    df = spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)
    listed = listed.where(~F.col("run_seq").isin([i + 1 for i in leave_out]))
    return df.join(run_ends(listed, df).select(*RUN_COLUMNS), "run_seq"), listed


def merged(spark, runs, sampled=()):
    model = []
    for i, rows in enumerate(runs):
        model = brute_merge(model, as_dicts(stg(spark, rows, f"r{i}", T0 + timedelta(days=i))), close_missing=i not in sampled)
    return sorted(((r["source_id"], r["properties_json"], r["_ingestion_run_id"], r["_valid_from"], r["_valid_to"], r["_is_current"]) for r in model), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_replay_with_sampled_runs_equals_iterated_merges(spark, seed):
    rnd = random.Random(seed)
    sampled = {i for i in range(9) if rnd.random() < (0.9 if seed == 5 else 0.4)}
    runs, listed = random_runs(spark, rnd, 9, sampled)
    staged, listed = snapshots(spark, runs, listed)
    assert tup(scd2_replay(staged, listed, DEALS)) == merged(spark, runs, sampled)


@pytest.mark.parametrize("seed", range(8))
def test_late_run_equals_a_full_rebuild(spark, seed):
    rnd = random.Random(100 + seed)
    runs, listed = random_runs(spark, rnd, 6)
    late = seed % 5
    if seed >= 6:
        runs[late] = [] if seed == 6 else runs[late]
        runs[late + 1] = [] if seed == 7 else runs[late + 1]
    staged, others = snapshots(spark, runs, listed, (late,))
    history = scd2_replay(staged, others, DEALS)
    empty = [ts_literal(T0 + timedelta(days=i)) for i, r in enumerate(runs) if not r and i != late]
    clock = lambda i: ts_literal(T0 + timedelta(days=i))
    rows = lambda i: stg(spark, runs[i], f"r{i}", T0 + timedelta(days=i))
    got = scd2_splice(history, rows(late), rows(late + 1), DEALS, at=clock(late), next_at=clock(late + 1), empty_runs=F.array(*empty).cast("array<timestamp>"))
    assert tup(got) == merged(spark, runs)
    raws = sorted((r.source_id, r.raw_json) for r in got.collect())
    whole, listed = snapshots(spark, runs, listed)
    assert raws == sorted((r.source_id, r.raw_json) for r in scd2_replay(whole, listed, DEALS).collect())
