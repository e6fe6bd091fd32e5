"""Post-load audits, consumer reads, and the stored ingest run end to end."""

import json
import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from snaphist.contracts import crm_contracts
from snaphist.operators import audits, gates, reads
from snaphist.plans import carriers as CR
from snaphist.plans.ingest import audit_run, ingest_run
from snaphist.plans.pipeline import RunInputs, map_run
from snaphist.sources.footers import schema_report
from snaphist.sources.landing import chain_faults, envelope_results, page_faults
from snaphist.sources.store import RunConflict, Store
from snaphist.streaming.landing_stream import landed_inputs
from test_plans import plan

C = crm_contracts("source")
EDGE = C["contact_company_associations"]


def test_unique_keys_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([("1", "2", None, None), ("1", "2", None, None), ("1", "3", "A", 1)],
                               "contact_id string, company_id string, association_category string, "
                               "association_type_id long")
    r = audits.key_uniqueness(df, list(EDGE.business_keys)).first()
    assert (r.total, r.distinct_keys) == (3, 2)
    with pytest.raises(ValueError, match="3 rows but 2 keys"):
        audits.assert_unique(df, EDGE.business_keys, label="edges")
    with pytest.raises(ValueError, match="audit/no-keys"):
        audits.assert_unique(df, (), label="edges")


def test_keys_of_equal_hash_are_told_apart(spark):
    # NULLs are skipped by the hash: these two keys share one
    rows = map_run(RunInputs(owners=spark.createDataFrame([('{"id":"1"}',), ('{"id":"2"}',)], "doc string")), C, run_id="a", ingested_at="2024-01-01 00:00:00", source_system="crm")["owners"]
    two = rows.select(*[F.when(F.col("owner_id") == "1", F.lit("x")).alias("owner_id") if c == "owner_id" else F.when(F.col("owner_id") == "2", F.lit("x")).alias(c) if c == "_ingestion_run_id" else c for c in rows.columns])
    contract = C["owners"]
    assert gates.hashed_keys(two, contract.history_keys()).distinct().count() == 1
    counted = {"rows": 2, **{f"blank_{c}": 0 for c in contract.stored_required()}}
    assert audits.check_written(two, contract, counted) == 2
    with pytest.raises(ValueError, match="2 rows but 1 keys"):
        audits.check_written(rows.where("owner_id = '1'").unionByName(rows.where("owner_id = '1'")), contract, counted)


def test_one_current_and_required(spark):
    df = spark.createDataFrame([("1", True, "x"), ("1", True, "y"), ("2", True, " "), ("3", False, None)],
                               "source_id string, _is_current boolean, raw_json string")
    assert [r.source_id for r in audits.multi_current(df, ["source_id"]).collect()] == ["1"]
    with pytest.raises(ValueError, match="audit/one-open"):
        audits.assert_one_current(df, "source_id", label="deals")
    with pytest.raises(ValueError, match=r"deals.raw_json: NULL or blank in 1 of 3 rows"):
        audits.assert_required(df, ["raw_json"], label="deals", current_only=True)
    r = audits.blank_counts(df, ["raw_json"]).first()
    assert (r.rows, r.raw_json) == (4, 2)


def test_reads(spark):
    t = lambda s: datetime.fromisoformat(s)
    h = spark.createDataFrame([
        ("1", t("2024-01-01 00:00:00"), t("2024-01-02 00:00:00"), False, "r1", t("2024-01-01 00:00:00")),
        ("1", t("2024-01-02 00:00:00"), None, True, "r2", t("2024-01-02 00:00:00")),
        ("2", t("2024-01-01 00:00:00"), None, False, "r1", t("2024-01-01 00:00:00")),
    ], "source_id string, _valid_from timestamp, _valid_to timestamp, _is_current boolean, "
       "_ingestion_run_id string, _ingested_at timestamp")
    assert [r._ingestion_run_id for r in reads.as_of(h, "2024-01-01 12:00:00").collect()] == ["r1"]
    assert [r._ingestion_run_id for r in reads.as_of(h, "2024-01-03 00:00:00").collect()] == ["r2"]
    assert [r._ingestion_run_id for r in reads.version_history(h, ["source_id"]).collect()] == ["r2", "r1", "r1"]
    assert reads.latest_run(h).count() == 1
    f = reads.freshness(h, "2024-01-02 06:00:00").first()
    assert f.age_hours == 6.0 and f.fresh
    kept = reads.retention_window(h, "2024-03-31 12:00:00", days=90)
    assert [r._ingestion_run_id for r in kept.collect()] == ["r2"]
    # an open version is kept however old its ingest is
    assert [r._is_current for r in reads.retention_window(h, "2030-01-01 00:00:00").collect()] == [True]


def small_inputs(spark, run):
    return RunInputs(
        entities={"deals": CR.order_docs(spark, SF_SMALL, run)},
        owners=CR.supplier_docs(spark, SF_SMALL, run),
        pipelines=CR.part_pipeline_docs(spark, SF_SMALL),
        associations={},
    )


def test_stored_runs_publish_and_audit(spark, scratch):
    store = Store(spark, f"{scratch}/bronze", C)
    with pytest.raises(RuntimeError, match="not-bootstrapped"):
        store.assert_tables_exist()
    assert "deals" in store.bootstrap()
    store.assert_tables_exist()
    _, c1, ch1 = ingest_run(store, small_inputs(spark, "r1"), run_id="r1", ingested_at=CR.RUNS["r1"], source_system="crm")
    _, c2, ch2 = ingest_run(store, small_inputs(spark, "r2"), run_id="r2", ingested_at=CR.RUNS["r2"], source_system="crm",
                            audit_scope="table")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    r2_ids = orders.where(~((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"))).count()
    assert c2["deals"] == r2_ids
    assert ch1["deals"] == (c1["deals"], c1["deals"], 0) and ch2["deals"].staged == r2_ids
    was = store.read("deals")
    assert ch2["deals"].closed == was.where("NOT _is_current").count()
    assert ch2["deals"].opened == was.where("_is_current AND _ingestion_run_id = 'r2'").count()
    deals = store.read("deals")
    audits.check_scd2(deals, C["deals"])
    store.register_views(["deals"])
    assert spark.sql("SELECT count(*) FROM deals WHERE _is_current = true").first()[0] == r2_ids
    assert deals.where("_is_current").count() == r2_ids
    assert c2["owners"] == c1["owners"] + store.read("owners").where("_ingestion_run_id = 'r2'").count()
    # re-running the same extract is a no-op for SCD2 and one more run for append tables
    _, c3, _ = ingest_run(store, small_inputs(spark, "r2"), run_id="r2b", ingested_at=CR.RUNS["r3"],
                       source_system="crm")
    assert c3["deals"] == c2["deals"]
    assert store.read("deals").count() == deals.count()
    assert c3["deal_pipeline_stages"] == 3 * c1["deal_pipeline_stages"]
    # superseded open snapshots can be dropped without changing any read
    before = sorted(map(tuple, store.read("deals").collect()), key=repr)
    assert len(store.vacuum("deals", keep=1)) == 2
    assert sorted(map(tuple, store.read("deals").collect()), key=repr) == before


def docs(spark, objs):
    return spark.createDataFrame([(json.dumps(o),) for o in objs], "doc string")


def deal(i, amount="1"):
    return {"id": i, "properties": {"amount": amount}, "createdAt": "c", "updatedAt": "u"}


def content(store, name):
    return sorted((tuple(r) for r in store.read(name).collect()), key=repr)


def new_store(spark, root):
    store = Store(spark, root, C)
    store.bootstrap()
    return store


def ingest(store, run_id, day, deals, owners=()):
    return ingest_run(store, RunInputs(entities={"deals": docs(store.spark, deals) if deals else docs(store.spark, [{}]).limit(0)},
                                       owners=docs(store.spark, owners) if owners else docs(store.spark, [{}]).limit(0)),
                      run_id=run_id, ingested_at=f"2024-01-0{day} 00:00:00", source_system="crm")


@pytest.mark.parametrize("second", [
    [deal(1), deal(2), deal(3)],      # the full extract again: closes nothing
    [],                               # an empty extract: closes all
    [deal(2, "9")],                   # another extract
])
def test_retry_after_failed_audit_equals_clean_store(spark, scratch, monkeypatch, second):
    """What a failed attempt wrote is never read, whatever the retry holds."""
    clean, store = new_store(spark, f"{scratch}/clean"), new_store(spark, f"{scratch}/retried")
    for s in (clean, store):
        ingest(s, "a", 1, [deal(1), deal(2), deal(3)], [{"id": 7}])
    real = audits.check_written
    monkeypatch.setattr(audits, "check_written", lambda rows, c, *a, **k: real(rows, c, *a, **k) if c.name == "deals" else (_ for _ in ()).throw(ValueError("audit")))
    with pytest.raises(ValueError, match="audit"):
        ingest(store, "b", 2, [deal(1, "5")], [{"id": 8}, {"id": 9}])
    monkeypatch.setattr(audits, "check_written", real)
    assert content(store, "deals") == content(clean, "deals")
    for s in (clean, store):
        ingest(s, "b", 2, second)     # owners: no rows this time
    for t in ("deals", "owners"):
        assert content(store, t) == content(clean, t)


def test_a_run_id_is_ingested_once(spark, scratch):
    store = new_store(spark, f"{scratch}/bronze")
    ingest(store, "a", 1, [deal(1)])
    before = content(store, "deals")
    with pytest.raises(RunConflict, match="committed already"):
        ingest(store, "a", 2, [deal(2)])
    assert content(store, "deals") == before


def test_of_two_interleaved_runs_one_is_refused(spark, scratch, monkeypatch):
    store = new_store(spark, f"{scratch}/bronze")
    ingest(store, "a", 1, [deal(1)])
    other = Store(spark, store.root, C)
    real = audits.check_written
    calls = []

    def meanwhile(*a, **k):
        if not calls:
            calls.append(1)
            ingest(other, "c", 2, [deal(1), deal(3)])
        return real(*a, **k)

    monkeypatch.setattr(audits, "check_written", meanwhile)
    with pytest.raises(RunConflict):
        ingest(store, "b", 2, [deal(1), deal(2)])
    assert [r for r, _ in store.committed("deals")] == ["a", "c"]
    assert sorted(r.source_id for r in store.read("deals").collect()) == ["1", "3"]


def test_corrupt_page_fails_the_run_and_closes_nothing(spark, scratch):
    store = new_store(spark, f"{scratch}/bronze")
    ingest(store, "a", 1, [deal(1), deal(2)])
    before = content(store, "deals")
    good = json.dumps({"results": [deal(1)]})
    for bad in (good[: len(good) // 2], '{"status":"error"}'):
        pages = spark.createDataFrame([(good,), (bad,)], "value string")
        assert page_faults(pages).count() == 1
        with pytest.raises(Exception, match="(?i)malformed|results list"):
            ingest_run(store, RunInputs(entities={"deals": envelope_results(pages)}), run_id="b",
                       ingested_at="2024-01-02 00:00:00", source_system="crm")
        assert content(store, "deals") == before


def page(request, after, results=()):
    return json.dumps({**({"request": {"after": request}} if request else {}), "results": list(results), **({"paging": {"next": {"after": after}}} if after else {})})


def chain_of(spark, pages):
    rows = spark.createDataFrame([("x", page(*p)) for p in pages], "extract string, value string")
    return Counter((r.fault, r.cursor, r.pages) for r in chain_faults(rows, "extract").collect())


CHAIN = [(None, "b"), ("b", "c"), ("c", "d"), ("d", None)]


@pytest.mark.parametrize("pages, want", [
    (CHAIN, {}), (CHAIN[::-1], {}), ([(None, None)], {}), ([(None, None)] * 3, {}), ([(None, "")], {}),
    (CHAIN[1:], {("first_page", None, 0), ("unreached_page", "b", 1)}),
    (CHAIN[:1] + CHAIN[2:], {("lost_page", "b", 1), ("unreached_page", "c", 1)}),
    (CHAIN[:-1], {("lost_page", "d", 1), ("last_page", None, 0)}),
    (CHAIN + CHAIN[1:2], {("doubled_page", "b", 2)}),
    (CHAIN + CHAIN[:1], {("first_page", None, 2)}),
    (CHAIN + [(None, "q"), ("q", None)], {("first_page", None, 2), ("last_page", None, 2)}),
    (CHAIN + [("q", "r"), ("r", "s"), ("s", "q")], {("endless_page", "q", 1), ("endless_page", "r", 1), ("endless_page", "s", 1)}),
    (CHAIN + [("q", "q")], {("endless_page", "q", 1)}),
    (CHAIN + [("q", "c")], {("unreached_page", "q", 1), ("forked_page", "c", 2)}),
])
def test_cursor_chain(spark, pages, want):
    assert chain_of(spark, pages) == Counter(want)


def test_long_chain_is_whole(spark):
    names = [None, *(f"c{i}" for i in range(1, 300)), None]
    assert not chain_of(spark, list(zip(names, names[1:])))
    names = [None, *("c%d" % i for i in range(1, 300))]
    assert sum(chain_of(spark, [*zip(names, names[1:]), ("c299", "c150")]).values()) == 1 + 299 + 1  # no last page, all endless, a fork


@pytest.mark.parametrize("lost", [0, 1, 2, "again"])
def test_a_lost_page_refuses_the_run_and_closes_nothing(spark, scratch, lost):
    store = new_store(spark, f"{scratch}/bronze")
    landing = f"{scratch}/landing"
    pages = [page(None, "2", [deal(1)]), page("2", "3", [deal(2)]), page("3", None, [deal(3)])]

    def land(run, some):
        os.makedirs(f"{landing}/{run}/entities/deals")
        with open(f"{landing}/{run}/entities/deals/part-0.jsonl", "w") as f:
            f.write("\n".join(some) + "\n")
        return ingest_run(store, landed_inputs(spark, landing, run), run_id=run, ingested_at="2024-01-01 00:00:00", source_system="crm")

    land("a", pages)
    before = content(store, "deals")
    assert len(before) == 3
    with pytest.raises(ValueError, match="cursor-chain.*\n.*entities/deals"):
        land("b", [*pages, pages[1]] if lost == "again" else pages[:lost] + pages[lost + 1:])
    assert content(store, "deals") == before and [r for r, _ in store.committed("deals")] == ["a"]
    land("c", pages[::-1])


def test_projection_at_ingest(spark, scratch):
    store = new_store(spark, f"{scratch}/bronze")
    full = {"id": 1, "properties": {"amount": "3", "color": "red"}, "createdAt": "c", "archived": False}
    ingest_run(store, RunInputs(entities={"deals": docs(spark, [full])}), run_id="a", ingested_at="2024-01-01 00:00:00",
               source_system="crm", project=True)
    r = store.read("deals").first()
    assert json.loads(r.properties_json) == {"amount": "3"} and r.source_id == "1" and r.archived is False
    assert json.loads(r.raw_json) == {**full, "properties": {"amount": "3"}}


def test_schema_is_checked_at_write(spark, scratch):
    store = new_store(spark, f"{scratch}/bronze")
    rows = spark.createDataFrame([], C["owners"].schema).withColumn("archived", F.lit("no"))
    with pytest.raises(ValueError, match="store/schema.*owners.archived"):
        store.write_run("owners", rows, "x")
    with pytest.raises(ValueError, match="store/run-id"):
        store.write_run("owners", rows.withColumn("archived", F.lit(True)), "a/b")


@pytest.mark.parametrize("change, fault", [
    (lambda df: df.drop("raw_json"), "missing_column raw_json"),
    (lambda df: df.withColumn("new", F.lit(1)), "extra_column new: int"),
    (lambda df: df.withColumn("archived", F.lit("yes")), "other_type archived: string, contract boolean"),
])
def test_a_drifted_file_is_refused(spark, scratch, change, fault):
    """Read with the contract's schema, a column that a file lacks would be
    NULL: every current row would count as changed."""
    store = new_store(spark, f"{scratch}/bronze")
    ingest(store, "a", 1, [deal(1), deal(2)], [{"id": 7}])
    part = store.part_path("deals", "a") + "/_is_current=true"
    rows = spark.createDataFrame(spark.read.parquet(part).collect(), store.file_schema(C["deals"]))
    change(rows.limit(1)).coalesce(1).write.mode("append").parquet(part)
    fresh = Store(spark, store.root, C)
    for read in (lambda: fresh.read("deals"), lambda: fresh.read_open("deals"), lambda: ingest(fresh, "b", 2, [deal(1)])):
        with pytest.raises(ValueError, match="(?s)store/schema-drift.*" + fault):
            read()
    assert fresh.read("owners").count() == 1 and fresh.committed("deals") == [("a", 1)]
    assert [(r.fault, r.files) for r in schema_report(fresh.schema_faults("deals", ["a"])).collect()] == [(fault.split()[0], 1)]


def test_purge_rewrites_only_what_it_must(spark, scratch):
    store = new_store(spark, f"{scratch}/bronze")
    ingest(store, "a", 1, [deal(1), deal(2), deal(3)], [{"id": 7}])
    ingest(store, "b", 2, [deal(1, "5"), deal(2)], [{"id": 7}, {"id": 8}])   # closes 1 and 3 of run a
    ingest(store, "c", 3, [deal(1, "6"), deal(2)], [{"id": 9}])              # closes 1 of run b
    ingest(store, "d", 4, [deal(1, "7"), deal(2, "9")], [{"id": 9}])         # closes 1 of run c and 2 of run a
    before = content(store, "deals")
    first = {r.part: (r.kept, r.dropped) for r in store.purge("deals", "2024-01-12 12:00:00", days=10).collect()}
    assert first == {"b": (0, 2), "c": (0, 1), "d": (1, 1)}   # versions that runs a and b opened
    cutoff = datetime(2024, 1, 2, 12)
    kept = [r for r in before if r[C["deals"].columns.index("_is_current")] or r[C["deals"].columns.index("_ingested_at")] >= cutoff]
    assert len(kept) < len(before) and content(store, "deals") == sorted(kept, key=repr)
    assert [r.dropped for r in store.purge("deals", "2024-01-12 12:00:00", days=10).collect()] == [0]
    report = {r.part: (r.kept, r.dropped) for r in store.purge("owners", "2024-01-12 12:00:00", days=10).collect()}
    assert report == {"a": (0, 1), "b": (0, 2), "c": (1, 0), "d": (1, 0)}
    assert sorted(r._ingestion_run_id for r in store.read("owners").collect()) == ["c", "d"]
    counts = ingest(store, "e", 5, [deal(1, "7")], [{"id": 1}]).counts
    assert counts["owners"] == 3 == store.read("owners").count()
    store.rewrite_closed("deals")
    assert [(r.kept, r.dropped) for r in store.purge("deals", "2024-02-12 12:00:00", days=10).collect()] == [(0, 2)]
    assert store.read("deals").count() == 1


def test_landed_json_is_parsed_by_the_staging_write_only(spark, scratch, monkeypatch):
    """Gate, merge and write read the staging tables; the counts are observed."""
    import contextlib
    import io
    store = new_store(spark, f"{scratch}/bronze")
    edges = docs(spark, [{"from": {"id": 1}, "to": [{"toObjectId": 10}]}])
    seen = {}

    def watch(owner, name, rows_at):
        real = getattr(owner, name)

        def call(*a, **k):
            text = io.StringIO()
            with contextlib.redirect_stdout(text):
                a[rows_at].explain()
            seen.setdefault(name, []).append("json" in text.getvalue().replace("raw_json", "").replace("properties_json", "").replace("teams_json", "").replace("metadata_json", ""))
            return real(*a, **k)
        monkeypatch.setattr(owner, name, call)

    watch(Store, "load_staging", 2)
    watch(Store, "write_run", 2)
    watch(gates, "duplicate_keys", 0)
    inputs = RunInputs(entities={"deals": docs(spark, [deal(1), deal(2)])}, owners=docs(spark, [{"id": 7}]), associations={"deal_company_associations": edges})
    result = ingest_run(store, inputs, run_id="a", ingested_at="2024-01-01 00:00:00", source_system="crm")
    assert seen == {"load_staging": [True] * 3, "write_run": [False] * 3, "duplicate_keys": [False] * 3}
    assert result.counts == {"deals": 2, "owners": 1, "deal_company_associations": 1} and result.changes["deals"] == (2, 2, 0)


def test_point_and_as_of_reads_skip_files(spark, scratch):
    store = new_store(spark, f"{scratch}/bronze")
    for i, run in enumerate(("r1", "r2", "r3"), 1):
        ingest_run(store, RunInputs(entities={"deals": CR.order_docs(spark, SF_SMALL, run)}), run_id=run, ingested_at=f"2024-01-0{i} 00:00:00", source_system="crm")
    before = content(store, "deals")
    assert store.rewrite_closed("deals", partitions=6) == "closed-3" and store.rewrite_closed("deals") is None
    assert content(store, "deals") == before
    closed = store.read("deals").where("NOT _is_current")
    key = closed.agg(F.max("source_id")).first()[0]
    one = closed.where(F.col("source_id") == key)
    text = one._jdf.queryExecution().toString()
    assert "EqualTo(source_id" in text
    files = closed.withColumn("f", F.input_file_name()).groupBy("f").agg(F.min("source_id").alias("lo"), F.max("source_id").alias("hi")).collect()
    assert len(files) == 6 and sum(r.lo <= key <= r.hi for r in files) == 1 and one.count() >= 1
    path = next(r.f for r in files)
    import pyarrow.parquet as pq
    meta = pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0)
    col = next(meta.column(i) for i in range(meta.num_columns) if meta.column(i).path_in_schema == "source_id")
    assert col.statistics.has_min_max
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    text = plan(reads.as_of(store.read("deals"), "2024-01-02 12:00:00"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(_valid_from" in text and "GreaterThan(_valid_to" in text
    assert store.vacuum("deals", keep=1) and content(store, "deals") == before


def test_edges_without_their_entity_are_none(spark, scratch):
    edges = docs(spark, [{"from": {"id": 1}, "to": [{"toObjectId": 10}]}])
    mapped = map_run(RunInputs(associations={"deal_company_associations": edges}), C, run_id="a",
                     ingested_at="2024-01-01 00:00:00", source_system="crm")
    assert mapped["deal_company_associations"].count() == 0


def test_failed_run_stays_invisible(spark, scratch):
    store = Store(spark, f"{scratch}/bronze", C)
    store.bootstrap()
    ingest_run(store, small_inputs(spark, "r1"), run_id="r1", ingested_at=CR.RUNS["r1"], source_system="crm")
    before = store.read("deals").count()
    bad = small_inputs(spark, "r2")
    bad.entities["deals"] = bad.entities["deals"].unionByName(bad.entities["deals"].limit(1))
    with pytest.raises(ValueError, match="duplicate_key"):
        ingest_run(store, bad, run_id="r2", ingested_at=CR.RUNS["r2"], source_system="crm")
    assert store.read("deals").count() == before
    assert [r for r, _ in store.committed("deals")] == ["r1"]


def test_sampled_run_audit(spark, scratch):
    store = Store(spark, f"{scratch}/bronze", C)
    store.bootstrap()
    ingest_run(store, small_inputs(spark, "r3"), run_id="s1", ingested_at=CR.RUNS["r1"], source_system="crm",
               sample_limit=25)
    with pytest.raises(ValueError, match="run-incomplete.*contacts"):
        audit_run(store, "s1", sample_limit=25)
    names = ("deals", "owners", "deal_pipeline_stages")
    part = Store(spark, store.root, {n: c for n, c in C.items() if n in names or c.pattern == "staging"})
    counts = audit_run(part, "s1", sample_limit=25)
    assert counts["deals"] == 25 and 0 < counts["owners"] <= 25
    with pytest.raises(ValueError, match="at least 1"):
        store.vacuum("deals", keep=0)


def test_ingest_scopes_associations_to_extracted_ids(spark, scratch):
    deals = docs(spark, [{"id": 1, "properties": {"dealname": "a"}}, {"id": 2, "properties": {"dealname": "b"}}])
    edges = docs(spark, [{"from": {"id": 1}, "to": [{"toObjectId": 10, "associationTypes": [
                      {"category": "X", "typeId": 3, "label": "l"}]}]},
                  {"from": {"id": 2}, "to": [{"toObjectId": 11}]},
                  {"from": {"id": 3}, "to": [{"toObjectId": 12}]}])          # 3 was not extracted
    store = Store(spark, f"{scratch}/bronze", C)
    store.bootstrap()
    _, counts, _ = ingest_run(store, RunInputs(entities={"deals": deals},
                                            associations={"deal_company_associations": edges}),
                           run_id="r1", ingested_at="2024-01-01 00:00:00", source_system="crm")
    got = sorted((r.deal_id, r.company_id, r.association_type_id)
                 for r in store.read("deal_company_associations").collect())
    assert got == [("1", "10", 3), ("2", "11", None)]
    assert counts == {"deals": 2, "deal_company_associations": 2}
