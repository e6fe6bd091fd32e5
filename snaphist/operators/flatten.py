"""Flatten landed JSON documents into contract-shaped rows.

Every mapper is a narrow transformation (``select`` / ``explode``), so it runs
inside the scan's stage with no shuffle. Run stamps are literals: one
timestamp and one run id for the whole run (columns only when replaying
stored snapshots that already carry their run's stamp).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import (
    INGESTED_AT, IS_CURRENT, RUN_ID, SOURCE_SYSTEM, STAGE_KEY_SEPARATOR, VALID_FROM, VALID_TO,
    TableContract, conform, ts_literal,
)
from ..functions.json import json_wrap, parse_fields
from ..functions.predicates import first_truthy, key_concat, truthy_flag

DOC = "doc"


def run_stamps(run_id: str, ingested_at: datetime | str, source_system: str) -> dict[str, Column]:
    """The three technical columns shared by every table of a run."""
    return {
        INGESTED_AT: ts_literal(ingested_at),
        RUN_ID: F.lit(run_id),
        SOURCE_SYSTEM: F.lit(source_system),
    }


def _id_cols(contract: TableContract) -> tuple[str, str, str]:
    key = contract.business_keys[0]
    prefix = key[: -len("_id")]
    return key, f"{prefix}_created_at", f"{prefix}_updated_at"


def objects_to_rows(docs: DataFrame, contract: TableContract, *, run_id: str | Column,
                    ingested_at: datetime | str | Column, source_system: str, doc_col: str = DOC,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Entity object -> SCD2 seed row (``_valid_from`` = run time, open).

    ``run_id``/``ingested_at`` are normally literals of the run; replaying
    stored snapshots passes the columns that carry each row's own run stamp.
    ``keep`` columns of ``docs`` are passed through after the contract."""
    d = F.col(doc_col)
    key, created, updated = _id_cols(contract)
    ts = ts_literal(ingested_at)
    o = parse_fields(d, {f: "string" for f in ("id", "properties", "createdAt", "updatedAt", "archived")})
    out = docs.select(
        o["id"].alias(key),
        F.lit(contract.object_type).alias("object_type"),
        F.coalesce(o["properties"], F.lit("{}")).alias("properties_json"),
        d.alias("raw_json"),
        o["createdAt"].alias(created),
        o["updatedAt"].alias(updated),
        truthy_flag(o["archived"]).alias("archived"),
        *[c.alias(n) for n, c in run_stamps(run_id, ingested_at, source_system).items()],
        ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
        *keep,
    )
    if not keep:
        return conform(out, contract)
    return out.select(*[F.col(c).cast(contract.type_of(c)).alias(c) for c in contract.columns], *keep)


def owners_to_rows(docs: DataFrame, contract: TableContract, *, run_id: str,
                   ingested_at: datetime | str, source_system: str, doc_col: str = DOC) -> DataFrame:
    """Owner object -> owners row; ``teams`` defaults to ``[]``."""
    d = F.col(doc_col)
    created = contract.columns[7]
    updated = contract.columns[8]
    o = parse_fields(d, {f: "string" for f in ("id", "userId", "email", "firstName", "lastName", "teams",
                                               "createdAt", "updatedAt", "archived")})
    out = docs.select(
        o["id"].alias("owner_id"),
        o["userId"].alias("user_id"),
        o["email"].alias("email"),
        o["firstName"].alias("first_name"),
        o["lastName"].alias("last_name"),
        F.coalesce(o["teams"], F.lit("[]")).alias("teams_json"),
        d.alias("raw_json"),
        o["createdAt"].alias(created),
        o["updatedAt"].alias(updated),
        truthy_flag(o["archived"]).alias("archived"),
        *[c.alias(n) for n, c in run_stamps(run_id, ingested_at, source_system).items()],
    )
    return conform(out, contract)


def pipelines_to_stage_rows(docs: DataFrame, contract: TableContract, *, run_id: str,
                            ingested_at: datetime | str, source_system: str, doc_col: str = DOC) -> DataFrame:
    """Pipeline object -> one row per stage (inner explode: no stages, no rows).
    Parent attributes repeat on every stage row."""
    d = F.col(doc_col)
    pf = ("id", "label", "createdAt", "updatedAt", "archived")
    pipe = parse_fields(d, {**{f: "string" for f in pf}, "stages": "array<string>"})
    staged = docs.select(d.alias("p"), *[pipe[f].alias(f"p_{f}") for f in pf],
                         F.explode(pipe["stages"]).alias("s"))
    p, s = F.col("p"), F.col("s")
    st = parse_fields(s, {f: "string" for f in ("id", "label", "displayOrder", "metadata", "createdAt",
                                                 "updatedAt", "archived")})
    pid, sid = F.col("p_id"), st["id"]
    out = staged.select(
        key_concat(pid, sid, sep=STAGE_KEY_SEPARATOR).alias("pipeline_stage_key"),
        pid.alias("pipeline_id"),
        F.col("p_label").alias("pipeline_label"),
        sid.alias("stage_id"),
        st["label"].alias("stage_label"),
        st["displayOrder"].cast("int").alias("display_order"),
        F.coalesce(st["metadata"], F.lit("{}")).alias("metadata_json"),
        F.col("p_createdAt").alias("pipeline_created_at"),
        F.col("p_updatedAt").alias("pipeline_updated_at"),
        truthy_flag(F.col("p_archived")).alias("pipeline_archived"),
        st["createdAt"].alias("stage_created_at"),
        st["updatedAt"].alias("stage_updated_at"),
        truthy_flag(st["archived"]).alias("stage_archived"),
        json_wrap(pipeline=p, stage=s).alias("raw_json"),
        *[c.alias(n) for n, c in run_stamps(run_id, ingested_at, source_system).items()],
    )
    return conform(out, contract)


_TYPE_STRUCT = "struct<category:string,typeId:string,label:string>"


def as_variant(results: DataFrame, doc_col: str = DOC) -> DataFrame:
    """``doc_col`` parsed to VARIANT, unless it is one. Text that is not JSON
    fails the job; so does an object with a repeated member."""
    return results if results.schema[doc_col].dataType == T.VariantType() else results.withColumn(doc_col, F.parse_json(doc_col))


def from_id(doc: Column) -> Column:
    """The from-id of a parsed association batch result (``''`` without one)."""
    return F.coalesce(F.try_variant_get(doc, "$.from.id", "string"), F.lit(""))


def associations_to_rows(results: DataFrame, contract: TableContract, *, run_id: str,
                         ingested_at: datetime | str, source_system: str, doc_col: str = DOC) -> DataFrame:
    """Association batch result ``{"from": {"id"}, "to": [...]}`` -> typed edges.

    One row per association type; an edge without types yields one row with
    NULL category/type/label; edges missing either id are dropped; every row
    of an edge carries the same raw ``{"from", "to"}`` text (as VARIANT writes
    it: members sorted by name). The to-id is ``toObjectId`` when truthy, else
    ``id``. A document is parsed once, to VARIANT, which keeps the token types
    that truthiness depends on (number 0 is falsy, string "0" is not).
    """
    parsed = as_variant(results.select(doc_col), doc_col)
    d = F.col(doc_col)
    part = lambda path, kind: F.try_variant_get(F.col("item"), path, kind)
    items = parsed.select(from_id(d).alias("from_id"), F.try_variant_get(d, "$.from", "string").alias("from_json"),
                          F.explode(F.try_variant_get(d, "$.to", "array<variant>")).alias("item"))
    ids = ("toObjectId", "id")
    texts = items.select("*", *[part(f"$.{k}", "string").alias(f"{k}_text") for k in ids])
    # once per edge, not per type; only objects have ids, and their cast is their JSON text
    edges = texts.select(
        "from_id", first_truthy(*[(F.col(f"{k}_text"), part(f"$.{k}", "variant")) for k in ids]).alias("to_id"),
        part("$.associationTypes", f"array<{_TYPE_STRUCT}>").alias("types"),
        json_wrap(**{"from": F.col("from_json"), "to": F.col("item").try_cast("string")}).alias("raw"),
    )
    # Dropping id-less edges and giving type-less edges one NULL-type row are
    # both folded into the generator: no Filter exists that the optimizer
    # could push back through (and re-evaluate) the JSON parsing.
    types = F.col("types")
    type_rows = F.when(F.coalesce(F.size(types), F.lit(0)) > 0, types).otherwise(
        F.array(F.lit(None).cast(_TYPE_STRUCT)))
    keep = (F.col("from_id") != "") & (F.col("to_id") != "")
    typed = edges.select(
        "from_id", "to_id", "raw",
        F.explode(F.when(keep, type_rows).otherwise(F.array().cast(f"array<{_TYPE_STRUCT}>"))).alias("t"),
    )
    out = typed.select(
        F.col("from_id").alias(contract.from_id),
        F.col("to_id").alias(contract.to_id),
        F.col("t.category").alias("association_category"),
        F.col("t.typeId").cast("bigint").alias("association_type_id"),
        F.col("t.label").alias("association_label"),
        F.col("raw").alias("raw_json"),
        *[c.alias(n) for n, c in run_stamps(run_id, ingested_at, source_system).items()],
    )
    return conform(out, contract)
