"""The full ingest run against a ``Store`` (R1).

Fail-fast, in the order entities -> owners -> stages -> associations: refuse
extracts that are not whole, map the landed documents into staging tables and
gate them, compute the new state, write the run's partition, audit what was
written; when every table has passed, commit them together. Row rules, blank
cells and change counts are observed by the writes themselves. A failing gate
or audit leaves the whole run uncommitted (invisible to readers). Associations are scoped to the entity ids extracted in the same
run. A sampled run keeps the first ``sample_limit`` objects by key and never
closes versions as missing.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..contracts import IS_CURRENT, RUN_ID, SCD2, STAGING
from ..operators import audits, gates
from ..operators.scd2 import scd2_merge_open
from ..sources.landing import assert_whole_extracts
from ..sources.store import Run, RunConflict, Store
from .pipeline import RunInputs, map_run


class TableChange(NamedTuple):
    """What a run did to one table."""
    staged: int
    opened: int
    closed: int


class RunResult(NamedTuple):
    run_id: str
    counts: dict[str, int]            # entities: current rows; other tables: rows of all runs
    changes: dict[str, TableChange]


def ingest_run(store: Store, inputs: RunInputs, *, run_id: str, ingested_at: datetime | str,
               source_system: str, sample_limit: int | None = None, project: bool = False,
               skip_committed: bool = False, audit_scope: str = "run") -> RunResult:
    """A run id is ingested once: a second time raises ``RunConflict``, or
    returns empty results with ``skip_committed`` (a replayed stream batch).

    ``audit_scope`` of append tables: ``"run"`` audits the rows of this run.
    Their key contains the run id and every committed run was audited, so the
    verdict is that of the whole table; ``"table"`` audits all of it again.
    ``project`` keeps the contract's requested properties only (S5).
    A run whose ``inputs.pages`` are not whole extracts is refused before
    anything is read from them."""
    store.assert_tables_exist()
    contracts = store.contracts
    close_missing = sample_limit is None
    known = store.tables()
    if any(r.run_id == run_id for log in known.values() for r in log.runs):
        if skip_committed:
            return RunResult(run_id, {}, {})
        raise RunConflict(f"run {run_id} is committed already")
    assert_whole_extracts(inputs.pages)
    run = Run(run_id, store.last_seq() + 1, ingested_at, 0, sample_limit)
    stamp = dict(run_id=run_id, ingested_at=ingested_at, source_system=source_system,
                 sample_limit=sample_limit, project=project)

    def stage(batch: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Written to staging tables (K3), gated and read back: the landed
        JSON is parsed by this one job."""
        return {n: _staged(store, n, rows, run_id, source_system) for n, rows in batch.items()}

    # entities first: the associations are scoped to the ids in their staging tables
    staged = stage(map_run(RunInputs(entities=inputs.entities), contracts, **stamp))
    ids = {n: df.select(F.col(contracts[n].business_keys[0]).alias("id")) for n, (df, _) in staged.items()}
    rest = RunInputs(owners=inputs.owners, pipelines=inputs.pipelines, associations=inputs.associations)
    staged |= stage(map_run(rest, contracts, entity_ids=ids, **stamp))
    counts: dict[str, int] = {}
    changes: dict[str, TableChange] = {}
    done: list[tuple[str, Run]] = []
    for name, (rows, n) in staged.items():
        c = contracts[name]
        scd2 = c.pattern == SCD2
        if scd2:
            rows = scd2_merge_open(store.read_open(name), rows, c, close_missing=close_missing)
        is_open = F.col(IS_CURRENT) if scd2 else F.lit(True)
        seen = Observation(f"written {name}")
        store.write_run(name, rows.observe(seen, *audits.blank_metrics(c), F.count(F.lit(1)).alias("all"),
                                           F.count_if(is_open & (F.col(RUN_ID) == run_id)).alias("opened")), run_id)
        got = seen.get
        if audit_scope == "table" and not scd2:
            audits.check_append(store.read(name, pending=run_id), c, label=name)
        in_scope = audits.check_written(store.written(name, run_id), c, got, label=name)
        counts[name] = in_scope if scd2 else known[name].total + in_scope
        changes[name] = TableChange(n, got["opened"], got["all"] - in_scope)
        done.append((name, run._replace(rows=got["all"])))
    if done:
        store.commit(done)
    store.clear_staging(run_id)
    return RunResult(run_id, counts, changes)


def _staged(store: Store, name: str, rows: DataFrame, run_id: str, source_system: str) -> tuple[DataFrame, int]:
    """(staged rows, their number) of a batch that passed the gate. The row
    rules are counted while it is written; only its keys are read once more
    for duplicates (as hashes: the rules tell equal hashes from equal keys),
    and breaches once more to show some."""
    c = store.contracts[name]
    scd2 = c.pattern == SCD2
    seen = Observation(f"staged {name}")
    breaches = gates.row_breaches(rows, c, source_system=source_system, scd2=scd2).alias("breaches")
    staged = store.load_staging(name, rows.observe(seen, breaches, F.count(F.lit(1)).alias("rows")), run_id)
    if seen.get["breaches"] or gates.duplicate_keys(gates.hashed_keys(staged, c.business_keys), ["key"]).first()["duplicates"]:
        gates.validate(staged, c, label=name, source_system=source_system, scd2=scd2)
    return staged, seen.get["rows"]


def audit_run(store: Store, run_id: str, *, sample_limit: int,
              capped: tuple[str, ...] = ("owners",)) -> dict[str, int]:
    """Sampled-run audit (V14) over every table of the contract: the run must
    have committed all of them. SCD2 tables are audited whole, append tables
    within the run; every entity has current rows; capped tables hold 1..limit
    rows in the run. Returns per-table counts."""
    known = store.tables()
    names = [n for n, c in store.contracts.items() if c.pattern != STAGING]
    absent = [n for n in names if not any(r.run_id == run_id for r in known[n].runs)]
    if absent:
        raise ValueError(f"[audit/run-incomplete] run {run_id} committed no rows for {', '.join(absent)}")
    out: dict[str, int] = {}
    for name in names:
        c = store.contracts[name]
        if c.pattern == SCD2:
            out[name] = audits.check_scd2(store.read(name), c, label=name)["current_rows"]
            if not out[name]:
                raise ValueError(f"[audit/no-current-rows] {name}")
        else:
            out[name] = audits.check_append(store.read_run(name, run_id), c, label=name)["rows"]
            if name in capped and not 0 < out[name] <= sample_limit:
                raise ValueError(f"[audit/sample-size] {name}: {out[name]} rows, wanted 1 to {sample_limit}")
    return out
