"""Pre-load quality gate on a mapped batch (before anything is written).

All rules are evaluated in one pass as a violations DataFrame
``(label, rule, field, key, detail, occurrences)``; duplicates come from one
key aggregation (partial aggregation on the map side, so a hot key is
collapsed before the shuffle). ``validate`` raises with the total and at most
ten examples, pulling only those ten rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import INGESTED_AT, IS_CURRENT, RUN_ID, SOURCE_SYSTEM, VALID_FROM, TableContract
from ..functions.predicates import blank_preload

VIOLATION_COLUMNS = ["label", "rule", "field", "key", "detail", "occurrences"]


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys])


def _row_rules(rows: DataFrame, contract: TableContract, must_have: Sequence[str],
               source_system: str, scd2: bool) -> list[Column]:
    rules: list[Column] = []

    def rule(cond: Column, name: str, field: str, detail: str) -> None:
        rules.append(F.when(cond, F.struct(F.lit(name).alias("rule"), F.lit(field).alias("field"),
                                           F.lit(detail).alias("detail"))))

    dtypes = {f.name: f.dataType for f in rows.schema.fields}
    for k in must_have:
        rule(blank_preload(F.col(k), dtypes.get(k)), "required_key", k, f"{k} is NULL or blank")
    rule(blank_preload(F.col("raw_json"), dtypes.get("raw_json")), "raw_json", "raw_json", "no source document kept")
    for f in (INGESTED_AT, RUN_ID, SOURCE_SYSTEM):
        rule(F.col(f).isNull(), "tech_field", f, f"run stamp {f} is NULL")
    rule(F.col(SOURCE_SYSTEM).isNotNull() & (F.col(SOURCE_SYSTEM) != F.lit(source_system)),
         "source_system", SOURCE_SYSTEM, f"tagged with a source other than {source_system}")
    rule(F.col(RUN_ID).isNotNull() & blank_preload(F.col(RUN_ID)), "tech_field", RUN_ID,
         "run id is blank")
    if scd2:
        rule(F.col(VALID_FROM).isNull(), "scd2_seed", VALID_FROM, "version start is NULL")
        rule(F.col(IS_CURRENT).isNull(), "scd2_seed", IS_CURRENT, "open flag is NULL")
        rule(F.col(IS_CURRENT).isNotNull() & ~F.col(IS_CURRENT), "scd2_seed", IS_CURRENT,
             "a staged version must be open")
    return rules


def violations(rows: DataFrame, contract: TableContract, *, label: str | None = None,
               source_system: str, required_keys: Sequence[str] | None = None,
               scd2: bool = False) -> DataFrame:
    """Every rule breach of the batch, one row per breach (duplicates: one row
    per repeated key, ``occurrences`` = repeats after the first)."""
    label = label or contract.name
    keys = list(contract.business_keys)
    must_have = list(required_keys) if required_keys is not None else list(contract.must_have)
    rules = _row_rules(rows, contract, must_have, source_system, scd2)
    row_level = (
        rows.select(_key_text(keys).alias("key"),
                    F.explode(F.filter(F.array(*rules), lambda v: v.isNotNull())).alias("v"))
        .select(F.lit(label).alias("label"), "v.rule", "v.field", "key", "v.detail",
                F.lit(1).cast("long").alias("occurrences"))
    )
    dupes = (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(F.lit(label).alias("label"), F.lit("duplicate_key").alias("rule"),
                F.lit(",".join(keys)).alias("field"), _key_text(keys).alias("key"),
                F.lit("key repeats within the batch").alias("detail"),
                (F.col("n") - 1).alias("occurrences"))
    )
    return row_level.unionByName(dupes)


def row_breaches(rows: DataFrame, contract: TableContract, *, source_system: str,
                 required_keys: Sequence[str] | None = None, scd2: bool = False) -> Column:
    """How many row rules all rows breach together: an aggregate to observe
    while the batch is written, instead of a pass of its own."""
    must_have = list(required_keys) if required_keys is not None else list(contract.must_have)
    rules = _row_rules(rows, contract, must_have, source_system, scd2)
    return F.sum(sum((r.isNotNull().cast("long") for r in rules), F.lit(0).cast("long")))


def violation_summary(v: DataFrame) -> DataFrame:
    """Issue count per (label, rule, field)."""
    return v.groupBy("label", "rule", "field").agg(F.sum("occurrences").alias("issues"))


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate occurrences in a batch: ``(n_rows, n_keys, duplicates)``;
    NULL keys group as equal."""
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def hashed_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A 64-bit hash of each row's keys (column ``key``; a single key as it
    is). Distinct hashes prove the keys unique and shuffle a fraction of their
    bytes; equal ones prove nothing (NULLs are skipped, hashes collide), so ask
    the keys then."""
    return rows.select((F.xxhash64(*keys) if len(keys) > 1 else F.col(keys[0])).alias("key"))


def gate_report(v: DataFrame, *, examples: int = 10) -> DataFrame:
    """V7 as one row per label: ``issues`` in all, and the first few breaches
    as text (by rule, field and key). Only the examples are sorted."""
    total = v.groupBy("label").agg(F.sum("occurrences").alias("issues"))
    first = v.orderBy("rule", "field", "key").limit(examples)
    text = F.concat_ws("/", "rule", "field", "key")
    shown = first.groupBy("label").agg(F.sort_array(F.collect_list(text)).alias("examples"))
    return total.join(shown, "label", "left")


def validate(rows: DataFrame, contract: TableContract, *, label: str | None = None,
             source_system: str, required_keys: Sequence[str] | None = None,
             scd2: bool = False) -> None:
    """Raise ``ValueError`` with the number of breaches and up to ten of them;
    an empty or clean batch passes. Only the ten-row sample reaches the
    driver."""
    label = label or contract.name
    v = violations(rows, contract, label=label, source_system=source_system,
                   required_keys=required_keys, scd2=scd2)
    sample = v.orderBy("rule", "field", "key").limit(10).collect()
    if not sample:
        return
    total = v.agg(F.sum("occurrences")).first()[0]
    shown = "".join(f"\n  {r['rule']}({r['field']}) {r['detail']} [{r['key']}]" for r in sample)
    raise ValueError(f"[gate/{label}] {total} breaches, {len(sample)} shown:{shown}")
