"""Consumer reads of the stored tables: current state, version history,
as-of, per-run snapshot, latest run, freshness, retention, counts.

Scalars such as "latest run" are uncorrelated scalar subqueries inside the
plan (no join, no driver round trip)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import INGESTED_AT, IS_CURRENT, RUN_ID, VALID_FROM, VALID_TO, ts_literal


def current_state(history: DataFrame) -> DataFrame:
    """``WHERE _is_current = true`` (NULL is not current)."""
    return history.where(F.col(IS_CURRENT))


def version_history(history: DataFrame, keys: Sequence[str], *, limit: int | None = None) -> DataFrame:
    """Versions newest first per key; ties broken by run id for a total order."""
    ordered = history.orderBy(*[F.col(k).asc() for k in keys], F.col(VALID_FROM).desc(),
                              F.col(RUN_ID).desc())
    return ordered.limit(limit) if limit is not None else ordered


def as_of(history: DataFrame, at: datetime | str) -> DataFrame:
    """Versions valid at ``at``: half-open ``[_valid_from, _valid_to)``. A
    closed version with NULL ``_valid_to`` (closed by an empty extract) is not
    valid; an open version is valid from its start on."""
    t = ts_literal(at)
    return history.where(
        (F.col(VALID_FROM) <= t)
        & ((F.col(VALID_TO) > t) | (F.col(VALID_TO).isNull() & F.coalesce(F.col(IS_CURRENT), F.lit(False))))
    )


def run_snapshot(appended: DataFrame, run_id: str) -> DataFrame:
    """Rows of one run (partition-pruned when stored by run id)."""
    return appended.where(F.col(RUN_ID) == F.lit(run_id))


def latest_run_id(appended: DataFrame):
    """Scalar subquery: the run id with the greatest ingest time."""
    return appended.agg(F.max_by(F.col(RUN_ID), F.col(INGESTED_AT))).scalar()


def latest_run(appended: DataFrame) -> DataFrame:
    """Rows of the latest run of an append table."""
    return appended.where(F.col(RUN_ID) == latest_run_id(appended))


def freshness(table: DataFrame, now: datetime | str, *, target_hours: float = 24.0) -> DataFrame:
    """One row: last ingest time, age in hours at ``now``, and whether the
    freshness target is met."""
    last = F.max(INGESTED_AT)
    age = (F.unix_micros(ts_literal(now)) - F.unix_micros(last)) / F.lit(3_600_000_000.0)
    return table.agg(
        last.alias("last_ingested_at"),
        age.alias("age_hours"),
        (age <= F.lit(target_hours)).alias("fresh"),
    )


def retention_window(table: DataFrame, now: datetime | str, *, days: int = 90,
                     keep_open: bool = True) -> DataFrame:
    """Rows kept by a ``days``-day retention on ingest time; open SCD2
    versions are always kept."""
    cutoff = ts_literal(now) - F.make_interval(days=F.lit(days))
    keep = F.col(INGESTED_AT) >= cutoff
    if keep_open and IS_CURRENT in table.columns:
        keep = keep | F.coalesce(F.col(IS_CURRENT), F.lit(False))
    return table.where(keep)


def retention_report(table: DataFrame, now: datetime | str, *, by: str, days: int = 90) -> DataFrame:
    """Per ``by`` group, the rows that a purge keeps and drops (the rule of
    ``retention_window``); one map-side combined aggregation."""
    cutoff = ts_literal(now) - F.make_interval(days=F.lit(days))
    is_open = F.coalesce(F.col(IS_CURRENT), F.lit(False)) if IS_CURRENT in table.columns else F.lit(False)
    keep = F.coalesce(F.col(INGESTED_AT) >= cutoff, F.lit(False)) | is_open
    return table.groupBy(by).agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))


def count_current(history: DataFrame) -> DataFrame:
    return current_state(history).agg(F.count(F.lit(1)).alias("n"))


def count_rows(table: DataFrame, run_id: str | None = None) -> DataFrame:
    t = table if run_id is None else run_snapshot(table, run_id)
    return t.agg(F.count(F.lit(1)).alias("n"))
