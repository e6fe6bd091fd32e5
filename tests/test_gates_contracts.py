"""Pre-load gate cases and contract behaviour."""

import os
import subprocess
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from snaphist.contracts import conform, crm_contracts, schema_mismatches
from snaphist.operators import gates

C = crm_contracts("source")
OWNERS = C["owners"]
DEALS = C["deals"]
EDGE = C["contact_company_associations"]
NOW = datetime(2031, 5, 17, 8, 30, tzinfo=timezone.utc)
STAMP = {"_ingested_at": NOW, "_ingestion_run_id": "may-17", "_source_system": "shop"}


def batch(spark, contract, *changes):
    """A clean row per change, keyed k0, k1, .., with the change applied."""
    key = contract.business_keys[0]
    rows = [{key: f"k{i}", "raw_json": '{"k":%d}' % i, **STAMP, "_valid_from": NOW, "_is_current": True, **c} for i, c in enumerate(changes)]
    kinds = {"_ingested_at": "timestamp", "_valid_from": "timestamp", "_is_current": "boolean"}
    return conform(spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in rows[0])), contract)


def found(df, contract, **kw):
    return sorted((v["rule"], v["field"], v["occurrences"]) for v in gates.violations(df, contract, source_system="shop", **kw).collect())


FAULTS = [
    # contract, change, rule, field
    ("owners", {"owner_id": None}, "required_key", "owner_id"),
    ("owners", {"owner_id": "\t\n"}, "required_key", "owner_id"),
    ("owners", {"raw_json": None}, "raw_json", "raw_json"),
    ("owners", {"raw_json": "  "}, "raw_json", "raw_json"),
    ("owners", {"_ingested_at": None}, "tech_field", "_ingested_at"),
    ("owners", {"_ingestion_run_id": None}, "tech_field", "_ingestion_run_id"),
    ("owners", {"_ingestion_run_id": ""}, "tech_field", "_ingestion_run_id"),
    ("owners", {"_source_system": None}, "tech_field", "_source_system"),
    ("owners", {"_source_system": "till"}, "source_system", "_source_system"),
    ("deals", {"_valid_from": None}, "scd2_seed", "_valid_from"),
    ("deals", {"_is_current": None}, "scd2_seed", "_is_current"),
    ("deals", {"_is_current": False}, "scd2_seed", "_is_current"),
]


@pytest.mark.parametrize("table, change, rule, field", FAULTS)
def test_each_fault_is_one_breach(spark, table, change, rule, field):
    df = batch(spark, C[table], {}, change, {})
    scd2 = table == "deals"
    assert found(df, C[table], scd2=scd2) == [(rule, field, 1)]
    with pytest.raises(ValueError, match=rf"\[gate/{table}\] 1 breaches.*\n  {rule}\({field}\)"):
        gates.validate(df, C[table], source_system="shop", scd2=scd2)


def test_clean_and_empty_batches_pass(spark):
    for name in ("owners", "deals"):
        gates.validate(batch(spark, C[name], {}, {}, {}), C[name], source_system="shop", scd2=name == "deals")
        gates.validate(spark.createDataFrame([], C[name].schema), C[name], source_system="shop", scd2=name == "deals")


def test_repeats_after_the_first_are_counted(spark):
    same = {"owner_id": "twin"}
    assert found(batch(spark, OWNERS, same, {}, same, same), OWNERS) == [("duplicate_key", "owner_id", 2)]


def test_report_shows_ten_of_twelve(spark):
    df = batch(spark, OWNERS, *[{"raw_json": ""}] * 12)
    with pytest.raises(ValueError) as e:
        gates.validate(df, OWNERS, source_system="shop")
    assert "12 breaches, 10 shown" in str(e.value) and str(e.value).count("\n") == 10
    row = gates.gate_report(gates.violations(df, OWNERS, source_system="shop")).first()
    assert row.issues == 12 and len(row.examples) == 10


def test_edge_with_null_type_needs_only_ids(spark):
    row = {"contact_id": "c-9", "company_id": "o-4", "raw_json": "[]", **STAMP}
    df = conform(spark.createDataFrame([row], "contact_id string, company_id string, raw_json string, "
                                             "_ingested_at timestamp, _ingestion_run_id string, "
                                             "_source_system string"), EDGE)
    gates.validate(df, EDGE, source_system="shop")
    with pytest.raises(ValueError, match="association_category"):
        gates.validate(df, EDGE, source_system="shop", required_keys=EDGE.business_keys)


def test_tab_is_blank_before_load_but_not_after(spark):
    from snaphist.functions.predicates import blank_preload, blank_stored
    df = spark.createDataFrame([("\t",), (" ",), ("\x1f",), (" ",), ("a",), (None,)], "v string")
    got = df.select(blank_preload(F.col("v")).alias("pre"), blank_stored(F.col("v")).alias("post")).collect()
    assert [(r.pre, r.post) for r in got] == [
        (True, False), (True, False), (True, False), (True, True), (False, False), (True, True)]


def test_contracts_shape():
    assert len(C) == 11
    assert [n for n in C][:6] == ["contacts", "companies", "deals", "_stg_contacts", "_stg_companies", "_stg_deals"]
    assert len(DEALS.columns) == 13 and len(OWNERS.columns) == 13
    assert len(C["deal_pipeline_stages"].columns) == 17 and len(EDGE.columns) == 9
    assert DEALS.history_keys() == ("source_id", "_ingestion_run_id")
    assert DEALS.version_keys() == ("source_id", "_valid_from")
    assert DEALS.change_attrs == ("properties_json", "archived", "source_updated_at", "source_created_at")


def test_conform_orders_nulls_and_drops(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "source_id long, object_type string, extra double")
    out = conform(df, DEALS)
    assert out.columns == DEALS.columns
    assert schema_mismatches(out.schema, DEALS) == []
    r = out.first()
    assert r.source_id == "1" and r.object_type == "x" and r._valid_to is None
    assert schema_mismatches(df.schema, DEALS)


CLOCK = """
from datetime import datetime
from snaphist.contracts import ts_literal
from snaphist.session import build_session
spark = build_session("local[1]", extra={"spark.sql.session.timeZone": "Asia/Tokyo"})
row = spark.range(1).select(*[ts_literal(v).cast("long").alias(n) for n, v in
    (("a", "2024-03-01 00:00:00"), ("b", datetime(2024, 3, 1)), ("c", "2024-03-01T01:00:00+01:00"))]).first()
print("SECONDS", *row)
"""


def test_clock_does_not_depend_on_host_or_session_zone():
    env = os.environ | {"TZ": "America/New_York", "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", CLOCK], env=env, capture_output=True, text=True, timeout=300).stdout
    assert out.rpartition("SECONDS")[2].split() == ["1709251200"] * 3


def test_checkpoint_folder_is_never_invented_on_a_cluster(spark, monkeypatch):
    from snaphist import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
