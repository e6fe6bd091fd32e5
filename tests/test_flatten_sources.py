"""Mappers and the landing reader on hand-written documents."""

import json

from snaphist.contracts import crm_contracts
from snaphist.operators.flatten import (
    associations_to_rows, objects_to_rows, owners_to_rows, pipelines_to_stage_rows,
)
from snaphist.sources.landing import envelope_results, next_cursor, read_objects, sample_first, scope_to_ids

C = crm_contracts("source")
STAMP = dict(run_id="run-a", ingested_at="2024-01-01 00:00:00", source_system="crm")


def docs(spark, objs):
    return spark.createDataFrame([(json.dumps(o, separators=(",", ":")),) for o in objs], "doc string")


def test_object_mapper(spark):
    d = docs(spark, [{"id": 7, "properties": {"email": "a@x", "firstname": "Ä"}, "createdAt": "c",
                      "updatedAt": "u", "archived": True},
                     {"id": "8", "properties": None}])
    rows = {r.source_id: r for r in objects_to_rows(d, C["contacts"], **STAMP).collect()}
    a, b = rows["7"], rows["8"]
    assert a.object_type == "contacts" and a.archived is True and a.source_created_at == "c"
    assert json.loads(a.properties_json) == {"email": "a@x", "firstname": "Ä"}
    assert a._is_current is True and a._valid_to is None and a._valid_from == a._ingested_at
    assert b.properties_json == "{}" and b.archived is False and b.source_updated_at is None
    assert a.raw_json.startswith('{"id":7')


def test_owner_mapper_defaults(spark):
    d = docs(spark, [{"id": 1, "userId": 5, "email": "e", "teams": [{"id": "t"}]}, {"id": 2, "userId": None}])
    rows = {r.owner_id: r for r in owners_to_rows(d, C["owners"], **STAMP).collect()}
    assert rows["1"].user_id == "5" and json.loads(rows["1"].teams_json) == [{"id": "t"}]
    assert rows["2"].user_id is None and rows["2"].teams_json == "[]"


def test_pipeline_stage_flatten(spark):
    d = docs(spark, [
        {"id": "p1", "label": "Sales", "stages": [
            {"id": "s1", "label": "New", "displayOrder": 0, "metadata": {"probability": "0.1"}},
            {"id": "s2", "label": "Won", "displayOrder": 1, "archived": True}]},
        {"id": "p2", "stages": []},
        {"id": "p3"},
        {"id": "p4", "stages": None},
        {"stages": [{"id": "s9"}]},
    ])
    rows = pipelines_to_stage_rows(d, C["deal_pipeline_stages"], **STAMP).orderBy("stage_id").collect()
    assert [(r.pipeline_stage_key, r.display_order, r.stage_archived) for r in rows] == [
        ("p1|s1", 0, False), ("p1|s2", 1, True), (None, None, False)]
    assert json.loads(rows[0].metadata_json) == {"probability": "0.1"} and rows[1].metadata_json == "{}"
    raw = json.loads(rows[0].raw_json)
    assert raw["pipeline"]["id"] == "p1" and raw["stage"]["id"] == "s1"


def test_association_flatten(spark):
    d = docs(spark, [
        {"from": {"id": 1}, "to": [
            {"toObjectId": 10, "associationTypes": [{"category": "A", "typeId": 1, "label": "x"},
                                                    {"category": "B", "typeId": 2, "label": None}]},
            {"toObjectId": 11, "associationTypes": []},
            {"toObjectId": 12},
            {"toObjectId": 0, "id": "13"},
            {"toObjectId": 0},
            {"toObjectId": "", "id": "0"},
        ]},
        {"from": {}, "to": [{"toObjectId": 5}]},
        {"from": {"id": "4"}, "to": [{"toObjectId": "0"}, {"toObjectId": False, "id": 5.5},
                                     {"toObjectId": 0.0, "id": "false"}, {"toObjectId": [], "id": 0}]},
        {"from": {"id": 2}},
        {"from": {"id": 3}, "to": None},
    ])
    c = C["contact_company_associations"]
    rows = associations_to_rows(d, c, **STAMP).collect()
    got = sorted((r.contact_id, r.company_id, r.association_category, r.association_type_id) for r in rows)
    assert got == [("1", "0", None, None), ("1", "10", "A", 1), ("1", "10", "B", 2),
                   ("1", "11", None, None), ("1", "12", None, None), ("1", "13", None, None),
                   ("4", "0", None, None), ("4", "5.5", None, None), ("4", "false", None, None)]
    raws = {r.raw_json for r in rows if r.company_id == "10"}
    assert len(raws) == 1 and json.loads(raws.pop())["to"]["toObjectId"] == 10


def test_envelope_and_cursor(spark, scratch):
    pages = [{"results": [{"id": 1}, {"id": 2}], "paging": {"next": {"after": "2"}}},
             {"results": [{"id": 3}]}, {"results": [], "paging": {}}]
    path = f"{scratch}/landing"
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.jsonl", "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")
    objs = read_objects(spark, path)
    assert sorted(json.loads(r.doc)["id"] for r in objs.collect()) == [1, 2, 3]
    pg = spark.read.text(path)
    assert sorted(str(r.after) for r in next_cursor(pg).collect()) == ["2", "None", "None"]
    assert envelope_results(pg).count() == 3


def test_scope_and_sample(spark):
    edges = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "from_id string, to string")
    ids = spark.createDataFrame([("1",), ("3",), ("3",)], "id string")
    assert sorted(r.from_id for r in scope_to_ids(edges, ids).collect()) == ["1", "3"]
    assert scope_to_ids(edges, ids.limit(0)).count() == 0
    s = sample_first(spark.createDataFrame([(str(i),) for i in range(30)], "k string"), 5, ["k"])
    assert [r.k for r in s.collect()] == ["0", "1", "10", "11", "12"]
