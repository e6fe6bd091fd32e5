"""Physical-plan properties that matter at scale, read from explain output."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from snaphist.contracts import crm_contracts
from snaphist.operators import audits, gates
from snaphist.operators.scd2 import SPLIT, scd2_merge, scd2_merge_open
from snaphist.plans.carriers import lineitem_assoc_docs, table
from snaphist.plans.queries import QUERIES, deal_rows, edge_rows
from snaphist.sources.store import Store

C = crm_contracts("source")
DEALS = C["deals"]
KEYS = list(C["deal_company_associations"].business_keys)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def hash_exchanges(text: str) -> int:
    # operator headers of the formatted plan, e.g. "(7) Exchange" followed by
    # "Arguments: hashpartitioning(...)"
    return len(re.findall(r"Arguments: hashpartitioning", text))


def stored(spark, scratch, df, name):
    path = f"{scratch}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_split_merge_shuffles_each_side_once_and_never_history(spark, scratch):
    h1 = stored(spark, scratch, scd2_merge(spark.createDataFrame([], DEALS.schema),
                                           deal_rows(spark, SF_SMALL, "r1"), DEALS), "h1")
    staging = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r2"), "stg")
    text = plan(scd2_merge(h1, staging, DEALS, form=SPLIT))
    assert hash_exchanges(text) == 2                      # open rows + staging, once each
    assert "BroadcastExchange" not in text                # tests run with auto-broadcast off
    # the uncorrelated MAX(_valid_from) reads a single column
    assert "ReadSchema: struct<_valid_from:timestamp>" in text


def test_run_filters_reach_the_scan(spark):
    text = plan(deal_rows(spark, SF_SMALL, "r1"))
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate", text)
    assert "o_orderkey" in text and "ReadSchema" in text


def test_mappers_add_no_hash_shuffle(spark):
    assert hash_exchanges(plan(edge_rows(spark, SF_SMALL))) == 0
    assert hash_exchanges(plan(deal_rows(spark, SF_SMALL, "r2"))) == 0


def test_gate_and_audit_aggregate_once_with_map_side_combine(spark, scratch):
    staging = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r2"), "stg2")
    v = plan(gates.violations(staging, DEALS, source_system="crm", scd2=True))
    assert hash_exchanges(v) == 1
    a = plan(audits.audit_report(staging, DEALS))
    assert hash_exchanges(a) == 1
    assert re.search(r"partial_count", a)                 # combined before the shuffle


def test_general_merge_partitions_only_on_the_key(spark, scratch):
    from snaphist.operators.scd2 import GENERAL
    h1 = stored(spark, scratch, scd2_merge(spark.createDataFrame([], DEALS.schema),
                                           deal_rows(spark, SF_SMALL, "r1"), DEALS), "g1")
    staging = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r2"), "gstg")
    text = plan(scd2_merge(h1, staging, DEALS, form=GENERAL))
    keys = re.findall(r"Arguments: hashpartitioning\(([a-z_]+)#", text)
    assert len(keys) == hash_exchanges(text) == 5
    assert set(keys) == {"source_id"}


def test_documents_are_parsed_once(spark):
    """One parse per document level, with its whole schema, however many
    fields the mapper takes."""
    from snaphist.plans import carriers as CR
    from snaphist.plans.queries import company_rows, owner_rows
    for df in (company_rows(spark, SF_SMALL), owner_rows(spark, SF_SMALL, "r1")):
        schemas = set(re.findall(r"from_json\((StructField\(.*?\)), \(mode", df._jdf.queryExecution().optimizedPlan().toString()))
        assert len(schemas) == 1
    assert CR.PREFIX


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_deals_rows_round_robin(spark, name):
    assert "RoundRobinPartitioning" not in plan(QUERIES[name](spark, SF_SMALL))


def test_multi_run_state_is_linear_in_the_runs(spark):
    from snaphist.plans.queries import deal_state
    scans = [plan(deal_state(spark, SF_SMALL, ("r1", "r2", "r3")[:n])).count("Scan parquet") for n in (2, 3)]
    exchanges = [hash_exchanges(plan(deal_state(spark, SF_SMALL, ("r1", "r2", "r3")[:n]))) for n in (2, 3)]
    assert exchanges == [1, 1] and scans[1] - scans[0] <= 2


def test_audit_of_current_rows_prunes_closed_ones(spark, scratch):
    rows = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r2"), "aud")
    assert re.search(r"PushedFilters: \[.*_is_current", plan(audits.audit_report(rows, DEALS)))


def test_union_merge_shuffles_once(spark, scratch):
    from snaphist.operators.scd2 import UNION
    h1 = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r1"), "u1")
    staging = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r2"), "ustg")
    text = plan(scd2_merge(h1, staging, DEALS, form=UNION))
    assert re.findall(r"Arguments: hashpartitioning\(([a-z_]+)#", text) == ["source_id"] and "Join" not in text


def test_late_run_leaves_untouched_versions_in_place(spark, scratch):
    """Stored history is read by two filters: versions near the late run go
    through the one exchange, the others to the output as they are."""
    from snaphist.contracts import ts_literal
    from snaphist.operators.scd2 import scd2_splice
    h = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r1"), "s1")
    rows = stored(spark, scratch, deal_rows(spark, SF_SMALL, "r2"), "s2")
    text = plan(scd2_splice(h, rows, rows, DEALS, at=ts_literal("2024-01-02 00:00:00"), next_at=ts_literal("2024-01-03 00:00:00")))
    assert re.findall(r"Arguments: hashpartitioning\(([a-z_]+)#", text) == ["source_id"] and "Join" not in text
    top = text[text.index("== Physical Plan =="):text.index("(1) ")]
    branches = re.split(r"\n:- |\n\+- ", top[top.index("Union"):].replace("   ", ""))
    far = [b for b in branches if "Scan parquet" in b and "Exchange" not in b]
    assert far and len(re.findall("Scan parquet", top)) == 4


def test_association_documents_are_built_in_several_tasks_per_core(spark):
    docs = lineitem_assoc_docs(spark, SF_SMALL, dealt=True)
    assert docs.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert docs.exceptAll(lineitem_assoc_docs(spark, SF_SMALL)).isEmpty() and docs.count() == table(spark, SF_SMALL, "lineitem").count()
    for name in ("flatten_associations", "audit_unique_keys_nulls", "run_summary"):
        assert "REPARTITION_BY_NUM" in plan(QUERIES[name](spark, SF_SMALL)), name


def test_uniqueness_checks_shuffle_hashes_and_a_first_merge_nothing(spark, scratch):
    edges = stored(spark, scratch, edge_rows(spark, SF_SMALL), "edges")
    hashed = plan(gates.duplicate_keys(gates.hashed_keys(edges, KEYS), ["key"]))
    moved = re.findall(r"Arguments: hashpartitioning\(([^,]*), ", hashed)
    assert len(moved) == 1 and moved[0].startswith("key#"), moved
    store = Store(spark, f"{scratch}/bronze", {"deals": DEALS})
    first = scd2_merge_open(store.read_open("deals"), stored(spark, scratch, deal_rows(spark, SF_SMALL, "r1"), "r1"), DEALS)
    assert "Join" not in plan(first) and hash_exchanges(plan(first)) == 0
    assert first.count() == deal_rows(spark, SF_SMALL, "r1").count()
