"""Optional bucketed catalog mode of the store: same results as the path
layout, and the merge no longer shuffles the open set."""

from conftest import SF_SMALL
from snaphist.contracts import crm_contracts
from snaphist.operators.scd2 import scd2_merge_open
from snaphist.plans import carriers as CR
from snaphist.plans.ingest import ingest_run
from snaphist.plans.pipeline import RunInputs
from snaphist.plans.queries import deal_rows
from snaphist.sources.store import Store
from test_plans import hash_exchanges, plan

C = crm_contracts("source")


def inputs(spark, run):
    return RunInputs(entities={"deals": CR.order_docs(spark, SF_SMALL, run)},
                     owners=CR.supplier_docs(spark, SF_SMALL, run))


def rows(store, name):
    return sorted(map(tuple, store.read(name).collect()), key=repr)


def test_bucketed_store_equals_path_store(spark, scratch):
    path_store = Store(spark, f"{scratch}/plain", C)
    bucketed = Store(spark, f"{scratch}/bucketed", C, database="bz_test", buckets=4)
    for s in (path_store, bucketed):
        s.bootstrap()
        for run in ("r1", "r2", "r3"):
            ingest_run(s, inputs(spark, run), run_id=run, ingested_at=CR.RUNS[run], source_system="crm")
    assert spark.catalog.tableExists("bz_test.deals")
    assert rows(bucketed, "deals") == rows(path_store, "deals")
    assert rows(bucketed, "owners") == rows(path_store, "owners")

    # the open set is read as a bucketed scan: only the extract is shuffled
    merge = scd2_merge_open(bucketed.read_open("deals"), deal_rows(spark, SF_SMALL, "r3"), C["deals"])
    text = plan(merge)
    assert "Bucketed: true" in text
    assert hash_exchanges(text) == 1
    assert hash_exchanges(plan(scd2_merge_open(path_store.read_open("deals"), deal_rows(spark, SF_SMALL, "r3"),
                                               C["deals"]))) == 2

    before = rows(bucketed, "deals")
    assert len(bucketed.vacuum("deals", keep=1)) >= 2
    assert rows(bucketed, "deals") == before


def test_rewriting_closed_versions_keeps_reads_in_both_modes(spark, scratch):
    plain = Store(spark, f"{scratch}/ref", C)
    stores = [Store(spark, f"{scratch}/cp", C), Store(spark, f"{scratch}/cb", C, database="bz_cmp", buckets=4)]
    for s in [plain] + stores:
        s.bootstrap()
    for i, run in enumerate(("r1", "r2", "r3")):
        for s in [plain] + stores:
            ingest_run(s, inputs(spark, run), run_id=run, ingested_at=CR.RUNS[run], source_system="crm")
        for s in stores:
            if i >= 1:
                assert s.rewrite_closed("deals") == f"closed-{i + 1}"
                assert s.rewrite_closed("deals") is None          # nothing new
                assert rows(s, "deals") == rows(plain, "deals")
                s.vacuum("deals", keep=1)
            assert rows(s, "deals") == rows(plain, "deals")
    purged = {r.part: (r.kept, r.dropped) for s in stores for r in s.purge("deals", "2030-01-01 00:00:00").collect()}
    assert list(purged) == ["closed-3"] and purged["closed-3"][0] == 0
    for s in stores:
        assert all(r[-1] for r in rows(s, "deals")) and len(rows(s, "deals")) == plain.read("deals").where("_is_current").count()
