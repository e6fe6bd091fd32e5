"""Post-load audits on stored (or about-to-be-published) tables.

Each audit is a metric DataFrame of one row; the ``assert_*`` wrappers pull
that single row and raise. Blank checks over many columns are one scan with
one aggregate per column. Key uniqueness is one aggregation giving both the
row total and the distinct-key count (NULLs in keys group as equal, unlike
``COUNT(DISTINCT a, b)`` which skips rows with a NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import IS_CURRENT, RUN_ID, TableContract
from ..functions.predicates import blank_stored
from .gates import hashed_keys


def _scope(table: DataFrame, *, current_only: bool = False, run_id: str | None = None) -> DataFrame:
    if current_only:
        table = table.where(F.col(IS_CURRENT))
    if run_id is not None:
        table = table.where(F.col(RUN_ID) == F.lit(run_id))
    return table


def multi_current(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one current row, and how many."""
    return (history.where(F.col(IS_CURRENT)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("current_rows")).where(F.col("current_rows") > 1))


def one_current_report(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    return multi_current(history, keys).agg(F.count(F.lit(1)).alias("bad_keys"))


def blank_counts(table: DataFrame, columns: Sequence[str], *, current_only: bool = False,
                 run_id: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` in scope and, per column, the NULL-or-blank count; one row,
    or one row per ``by`` group (e.g. per run) from the same single scan."""
    t = _scope(table, current_only=current_only, run_id=run_id)
    return t.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.sum(F.when(blank_stored(F.col(c)), 1).otherwise(0)), F.lit(0)).cast("long").alias(c)
          for c in columns],
    )


def key_uniqueness(table: DataFrame, keys: Sequence[str], *, run_id: str | None = None,
                   by: Sequence[str] = ()) -> DataFrame:
    """``total`` rows and ``distinct_keys`` (NULL-equal); one row, or one
    row per ``by`` group."""
    if not keys:
        raise ValueError("[audit/no-keys] uniqueness needs at least one column")
    per_key = _scope(table, run_id=run_id).groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
                       F.count(F.lit(1)).alias("distinct_keys"))


def assert_one_current(history: DataFrame, key: str, *, label: str) -> None:
    bad = one_current_report(history, [key]).first()["bad_keys"]
    if bad:
        raise ValueError(f"[audit/one-open] {label}: {bad} keys ({key}) are open more than once")


def assert_required(table: DataFrame, columns: Sequence[str], *, label: str,
                    current_only: bool = False, run_id: str | None = None) -> None:
    row = blank_counts(table, columns, current_only=current_only, run_id=run_id).first()
    for c in columns:
        if row[c]:
            raise ValueError(f"[audit/required] {label}.{c}: NULL or blank in {row[c]} of {row['rows']} rows")


def assert_unique(table: DataFrame, keys: Sequence[str], *, label: str, run_id: str | None = None) -> None:
    if not keys:
        raise ValueError(f"[audit/no-keys] {label}: uniqueness needs at least one column")
    row = key_uniqueness(table, keys, run_id=run_id).first()
    if row["total"] != row["distinct_keys"]:
        raise ValueError(f"[audit/unique] {label}({', '.join(keys)}): {row['total']} rows but {row['distinct_keys']} keys")


def audit_report(table: DataFrame, contract: TableContract, *, run_id: str | None = None) -> DataFrame:
    """Every post-load check of a table from one scan and one key-level
    aggregation (map-side combine, so a hot key is one row per task).

    SCD2: ``current_rows``, ``bad_keys`` (keys with >1 current row) and, per
    required column, NULL/blank counts; closed rows are pruned at the scan.
    Append: ``rows``, ``distinct_keys`` over the history keys and, per
    required column, NULL/blank counts; optionally scoped to ``run_id``."""
    req = list(contract.stored_required())
    t = _scope(table, run_id=run_id, current_only=contract.pattern == "scd2")
    if contract.pattern == "scd2":
        per_key = t.groupBy(contract.business_keys[0]).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.when(blank_stored(F.col(c)), 1).otherwise(0)).alias(f"b{i}") for i, c in enumerate(req)])
        extra = [F.count(F.when(F.col("n") > 1, 1)).alias("bad_keys")]
    else:
        per_key = t.groupBy(*contract.history_keys()).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.when(blank_stored(F.col(c)), 1).otherwise(0)).alias(f"b{i}") for i, c in enumerate(req)])
        extra = [F.count(F.lit(1)).alias("distinct_keys")]
    total = "current_rows" if contract.pattern == "scd2" else "rows"
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(total), *extra,
        *[F.coalesce(F.sum(f"b{i}"), F.lit(0)).cast("long").alias(c) for i, c in enumerate(req)])


def run_report(table: DataFrame, keys: Sequence[str], columns: Sequence[str], *, by: Sequence[str]) -> DataFrame:
    """Per ``by`` group: ``rows``, ``distinct_keys`` and the NULL-or-blank
    count of each column, from one aggregation by (group, key)."""
    per_key = table.groupBy(*by, *keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(F.when(blank_stored(F.col(c)), 1).otherwise(0)).alias(f"__b{i}") for i, c in enumerate(columns)])
    return per_key.groupBy(*by).agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                                    *[F.sum(f"__b{i}").alias(c) for i, c in enumerate(columns)])


def _raise_on(report, contract: TableContract, label: str) -> None:
    scd2 = contract.pattern == "scd2"
    total = report["current_rows" if scd2 else "rows"]
    for c in contract.stored_required():
        if report[c]:
            raise ValueError(f"[audit/required] {label}.{c}: NULL or blank in {report[c]} of {total} rows")
    if scd2 and report["bad_keys"]:
        raise ValueError(f"[audit/one-open] {label}: {report['bad_keys']} keys ({contract.business_keys[0]}) are open more than once")
    if not scd2 and total != report["distinct_keys"]:
        raise ValueError(f"[audit/unique] {label}({', '.join(contract.history_keys())}): {total} rows but {report['distinct_keys']} keys")


def blank_metrics(contract: TableContract) -> list[Column]:
    """Aggregates to observe while a table's rows are written: ``rows`` in
    scope of the audit (SCD2: current ones) and, per required column, the
    NULL-or-blank ones. What is written and what is counted is one job."""
    scope = F.coalesce(F.col(IS_CURRENT), F.lit(False)) if contract.pattern == "scd2" else F.lit(True)
    return [F.count_if(scope).alias("rows"), *[F.count_if(scope & blank_stored(F.col(c))).alias(f"blank_{c}") for c in contract.stored_required()]]


def check_written(written: DataFrame, contract: TableContract, counted: dict, *, label: str | None = None) -> int:
    """The post-load audit of a written partition whose ``blank_metrics`` were
    observed: what is left to read are its keys, as hashes unless some are
    equal. Returns the rows in scope."""
    keys = [contract.business_keys[0]] if contract.pattern == "scd2" else list(contract.history_keys())
    scoped = _scope(written, current_only=contract.pattern == "scd2")
    distinct = key_uniqueness(hashed_keys(scoped, keys), ["key"]).first()
    if distinct["total"] != distinct["distinct_keys"]:
        distinct = key_uniqueness(scoped, keys).first()
    if contract.pattern == "scd2":
        bad = distinct["total"] - distinct["distinct_keys"] and one_current_report(written, keys).first()["bad_keys"]
        report = {"current_rows": counted["rows"], "bad_keys": bad}
    else:
        report = {"rows": distinct["total"], "distinct_keys": distinct["distinct_keys"]}
    _raise_on({**report, **{c: counted[f"blank_{c}"] for c in contract.stored_required()}}, contract, label or contract.name)
    return counted["rows"]


def check_scd2(history: DataFrame, contract: TableContract, *, label: str | None = None):
    """Required columns on current rows, then at most one current row per
    key; one pass. Returns the report row (counts for the run summary)."""
    report = audit_report(history, contract).first()
    _raise_on(report, contract, label or contract.name)
    return report


def check_append(table: DataFrame, contract: TableContract, *, label: str | None = None,
                 run_id: str | None = None):
    """Required ids + raw + tech columns, then unique history keys; whole
    table unless ``run_id`` scopes it; one pass. Returns the report row."""
    report = audit_report(table, contract, run_id=run_id).first()
    _raise_on(report, contract, label or contract.name)
    return report


def dq_metrics(table: DataFrame, contract: TableContract, *, run_id: str | None = None) -> DataFrame:
    """Completeness and uniqueness percentages (targets: 100 %), from one
    scan: per-key partial counts first (map-side combine), then one global
    aggregate gives row total, distinct keys and blank cells together."""
    scd2 = contract.pattern == "scd2"
    req = list(contract.stored_required())
    keys = [contract.business_keys[0]] if scd2 else list(contract.history_keys())
    scoped = _scope(table, current_only=scd2, run_id=run_id)
    blank = lambda c: F.sum(F.when(blank_stored(F.col(c)), 1).otherwise(0))
    per_key = scoped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                        *[blank(c).alias(f"b{i}") for i, c in enumerate(req)])
    tot = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(sum((F.sum(f"b{i}") for i in range(len(req))), F.lit(0)), F.lit(0)).alias("bad"),
    )
    cells = F.col("rows") * F.lit(len(req))
    pct = lambda num, den: F.when(den == 0, F.lit(100.0)).otherwise(F.round(F.lit(100.0) * num / den, 4))
    return tot.select(
        F.lit(contract.name).alias("table_name"),
        F.col("rows").cast("long").alias("rows"),
        pct(cells - F.col("bad"), cells).alias("completeness_pct"),
        pct(F.col("distinct_keys"), F.col("rows")).alias("uniqueness_pct"),
    )
