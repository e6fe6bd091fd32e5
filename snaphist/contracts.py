"""Table contracts: one ``StructType`` per table is the only schema source.

A contract carries the ordered schema, the business keys, the keys that must
be present before load (default: the business keys), the load pattern and,
for versioned entities, the attributes that open a new version.

The source-specific column prefix (``<prefix>_id``, ``<prefix>_created_at``,
``<prefix>_updated_at``) and the source tag are parameters, so the same
contracts serve any upstream CRM.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCD2 = "scd2"
APPEND = "append"
STAGING = "staging"

# Technical column names, SCD2 column names, stage-key separator.
INGESTED_AT = "_ingested_at"
RUN_ID = "_ingestion_run_id"
SOURCE_SYSTEM = "_source_system"
VALID_FROM = "_valid_from"
VALID_TO = "_valid_to"
IS_CURRENT = "_is_current"
TECH_FIELDS = (INGESTED_AT, RUN_ID, SOURCE_SYSTEM)
SCD2_FIELDS = (VALID_FROM, VALID_TO, IS_CURRENT)
STAGE_KEY_SEPARATOR = "|"

_TYPES = {
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "TIMESTAMP": T.TimestampType(),
}


def _schema(cols: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in cols])


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: T.StructType
    business_keys: tuple[str, ...]
    pattern: str
    required_keys: tuple[str, ...] | None = None
    change_attrs: tuple[str, ...] = ()
    object_type: str | None = None
    properties: tuple[str, ...] = ()
    from_id: str | None = None
    to_id: str | None = None
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def must_have(self) -> tuple[str, ...]:
        return self.required_keys if self.required_keys is not None else self.business_keys

    def history_keys(self) -> tuple[str, ...]:
        """Append grain: business keys + run id."""
        return self.business_keys + (RUN_ID,)

    def version_keys(self) -> tuple[str, ...]:
        """SCD2 grain: business keys + ``_valid_from``."""
        return self.business_keys + (VALID_FROM,)

    def stored_required(self) -> tuple[str, ...]:
        """Columns the post-load audits require non-null/non-blank."""
        if self.pattern == SCD2:
            return (self.business_keys[0], "raw_json", VALID_FROM, IS_CURRENT) + TECH_FIELDS
        return tuple(self.must_have) + ("raw_json",) + TECH_FIELDS

    def type_of(self, name: str) -> T.DataType:
        return self.schema[name].dataType

    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in self.schema.fields)


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Project ``df`` to the contract: contract order, missing column -> typed
    NULL, extra columns dropped, present columns cast to the contract type.
    Built as one ``selectExpr`` (a single analyzer call)."""
    present = set(df.columns)
    exprs = []
    for f in contract.schema.fields:
        src = f"`{f.name}`" if f.name in present else "NULL"
        exprs.append(f"CAST({src} AS {f.dataType.simpleString()}) AS `{f.name}`")
    return df.selectExpr(*exprs)


def schema_mismatches(schema: T.StructType, contract: TableContract) -> list[str]:
    """Differences of names, order and types between ``schema`` and the contract."""
    out: list[str] = []
    got = [(f.name, f.dataType) for f in schema.fields]
    want = [(f.name, f.dataType) for f in contract.schema.fields]
    if [n for n, _ in got] != [n for n, _ in want]:
        out.append(f"{contract.name}: columns {[n for n, _ in got]} != contract {[n for n, _ in want]}")
    for (gn, gt), (wn, wt) in zip(got, want):
        if gn == wn and gt != wt:
            out.append(f"{contract.name}.{gn}: type {gt.simpleString()} != contract {wt.simpleString()}")
    return out


def staging_name(table: str) -> str:
    return f"_stg_{table}"


def crm_contracts(prefix: str = "source") -> dict[str, TableContract]:
    """The eleven bronze contracts, in bootstrap order."""
    sid, created, updated = f"{prefix}_id", f"{prefix}_created_at", f"{prefix}_updated_at"
    tech = [(INGESTED_AT, "TIMESTAMP"), (RUN_ID, "STRING"), (SOURCE_SYSTEM, "STRING")]

    # Entity column order and the attributes that open a new version.
    entity_cols = [
        (sid, "STRING"),
        ("object_type", "STRING"),
        ("properties_json", "STRING"),
        ("raw_json", "STRING"),
        (created, "STRING"),
        (updated, "STRING"),
        ("archived", "BOOLEAN"),
        *tech,
        (VALID_FROM, "TIMESTAMP"),
        (VALID_TO, "TIMESTAMP"),
        (IS_CURRENT, "BOOLEAN"),
    ]
    change_attrs = ("properties_json", "archived", updated, created)

    # Requested properties per entity.
    entities = {
        "contacts": ("email", "firstname", "lastname"),
        "companies": ("name", "domain"),
        "deals": ("dealname", "amount", "dealstage", "closedate", "pipeline", f"{prefix}_owner_id"),
    }

    out: dict[str, TableContract] = {}
    for name, props in entities.items():
        out[name] = TableContract(
            name, _schema(entity_cols), (sid,), SCD2,
            change_attrs=change_attrs, object_type=name, properties=props,
        )
    for name, props in entities.items():
        out[staging_name(name)] = TableContract(
            staging_name(name), _schema(entity_cols), (sid,), STAGING,
            change_attrs=change_attrs, object_type=name, properties=props,
        )

    # Owner and pipeline-stage column order.
    out["owners"] = TableContract(
        "owners",
        _schema([
            ("owner_id", "STRING"), ("user_id", "STRING"), ("email", "STRING"),
            ("first_name", "STRING"), ("last_name", "STRING"), ("teams_json", "STRING"),
            ("raw_json", "STRING"), (created, "STRING"), (updated, "STRING"),
            ("archived", "BOOLEAN"), *tech,
        ]),
        ("owner_id",), APPEND,
    )
    out["deal_pipeline_stages"] = TableContract(
        "deal_pipeline_stages",
        _schema([
            ("pipeline_stage_key", "STRING"), ("pipeline_id", "STRING"), ("pipeline_label", "STRING"),
            ("stage_id", "STRING"), ("stage_label", "STRING"), ("display_order", "INT"),
            ("metadata_json", "STRING"), ("pipeline_created_at", "STRING"),
            ("pipeline_updated_at", "STRING"), ("pipeline_archived", "BOOLEAN"),
            ("stage_created_at", "STRING"), ("stage_updated_at", "STRING"),
            ("stage_archived", "BOOLEAN"), ("raw_json", "STRING"), *tech,
        ]),
        ("pipeline_stage_key",), APPEND,
        required_keys=("pipeline_stage_key", "pipeline_id", "stage_id"),
    )

    # Association tables as (table, from object, to object, from column, to column).
    edges = [
        ("contact_company_associations", "contacts", "companies", "contact_id", "company_id"),
        ("deal_company_associations", "deals", "companies", "deal_id", "company_id"),
        ("deal_contact_associations", "deals", "contacts", "deal_id", "contact_id"),
    ]
    for name, from_obj, to_obj, from_col, to_col in edges:
        out[name] = TableContract(
            name,
            _schema([
                (from_col, "STRING"), (to_col, "STRING"), ("association_category", "STRING"),
                ("association_type_id", "BIGINT"), ("association_label", "STRING"),
                ("raw_json", "STRING"), *tech,
            ]),
            (from_col, to_col, "association_category", "association_type_id"), APPEND,
            required_keys=(from_col, to_col),
            from_id=from_col, to_id=to_col,
            extra={"from_object": from_obj, "to_object": to_obj},
        )
    return out


def entity_contract(name: str, prefix: str = "source", object_type: str | None = None) -> TableContract:
    """An SCD2 entity contract of the standard 13-column shape under any name."""
    base = crm_contracts(prefix)["contacts"]
    return TableContract(
        name, base.schema, base.business_keys, SCD2,
        change_attrs=base.change_attrs, object_type=object_type or name,
    )


def utc(value: datetime | str) -> datetime:
    """A run's clock as an aware UTC time. Text and datetimes without a zone
    are UTC, whatever the zone of the host or the session."""
    at = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def ts_literal(value) -> Column:
    """A run timestamp as a TIMESTAMP (one value per run, never per row); a
    column, as in a replay, is cast as it is."""
    if isinstance(value, Column):
        return value.cast(T.TimestampType())
    return F.lit(utc(value).isoformat()).cast(T.TimestampType())
