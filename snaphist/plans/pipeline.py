"""One ingest run as DataFrame plans: map -> (sample) -> gate -> load -> audit.

``map_run`` turns a run's landed documents into contract rows (associations
scoped to the entity ids extracted in the same run); ``apply_run`` merges or
appends them onto a table state; ``run_summary`` is the per-table count
report (entities: current rows, other tables: whole-table total). The stored
variant with publishing lives in ``snaphist.plans.ingest``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import APPEND, SCD2, TableContract
from ..operators.flatten import (
    associations_to_rows, objects_to_rows, owners_to_rows, pipelines_to_stage_rows,
)
from ..operators.history import append_history
from ..operators.scd2 import SPLIT, scd2_merge
from ..sources.landing import project_objects, sample_first, scope_results_to_ids
from . import carriers as C


@dataclass
class RunInputs:
    """Landed documents of one run, one JSON object text per row (``doc``)."""
    entities: dict[str, DataFrame] = field(default_factory=dict)      # table -> objects
    owners: DataFrame | None = None
    pipelines: DataFrame | None = None
    associations: dict[str, DataFrame] = field(default_factory=dict)  # table -> batch results
    pages: dict[str, DataFrame] = field(default_factory=dict)         # landed extracts, to be checked for lost pages


def map_run(inputs: RunInputs, contracts: dict[str, TableContract], *, run_id: str,
            ingested_at: datetime | str, source_system: str,
            sample_limit: int | None = None, project: bool = False,
            entity_ids: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Associations keep only results for ids extracted in this run; if their
    from-entity is not part of it, that is none. ``project`` keeps only the
    properties that an entity's contract requests (S5). ``entity_ids``: per entity table, the ids this run extracted (column
    ``id``), e.g. read from its written staging table; by default they are
    taken from the entity rows mapped here."""
    stamp = dict(run_id=run_id, ingested_at=ingested_at, source_system=source_system)
    entity_ids = entity_ids or {}
    out: dict[str, DataFrame] = {}
    for name, docs in inputs.entities.items():
        if project:
            docs = project_objects(docs, contracts[name].properties)
        rows = objects_to_rows(docs, contracts[name], **stamp)
        if sample_limit is not None:
            rows = sample_first(rows, sample_limit, list(contracts[name].business_keys))
        out[name] = rows
    if inputs.owners is not None:
        rows = owners_to_rows(inputs.owners, contracts["owners"], **stamp)
        if sample_limit is not None:
            rows = sample_first(rows, sample_limit, ["owner_id"])
        out["owners"] = rows
    if inputs.pipelines is not None:  # pipelines are never sampled
        out["deal_pipeline_stages"] = pipelines_to_stage_rows(
            inputs.pipelines, contracts["deal_pipeline_stages"], **stamp)
    for name, results in inputs.associations.items():
        c = contracts[name]
        source = c.extra["from_object"]
        ids = entity_ids.get(source)
        if ids is None and source in out:
            ids = out[source].select(F.col(contracts[source].business_keys[0]).alias("id"))
        results = scope_results_to_ids(results, ids) if ids is not None else results.limit(0)
        out[name] = associations_to_rows(results, c, **stamp)
    return out


def apply_run(state: dict[str, DataFrame], mapped: dict[str, DataFrame],
              contracts: dict[str, TableContract], *, close_missing: bool = True,
              form: str = SPLIT) -> dict[str, DataFrame]:
    """New table states: SCD2 merge for entities, append for the rest. A
    table without a state starts with the run's rows."""
    new = dict(state)
    for name, rows in mapped.items():
        c = contracts[name]
        if name not in state:
            new[name] = rows
            continue
        if c.pattern == SCD2:
            new[name] = scd2_merge(state[name], rows, c, close_missing=close_missing, form=form)
        elif c.pattern == APPEND:
            new[name] = append_history(state[name], rows, c)
    return new


def run_summary(state: dict[str, DataFrame], contracts: dict[str, TableContract]) -> DataFrame:
    """``(table_name, metric, n)``: current rows for entities, total otherwise."""
    parts = []
    for name, df in state.items():
        scd2 = contracts[name].pattern == SCD2
        t = df.where(F.col("_is_current")) if scd2 else df
        parts.append(t.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("current" if scd2 else "total").alias("metric"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def carrier_inputs(spark: SparkSession, sf_dir: str, run: str) -> RunInputs:
    """A run's landed documents derived from the driver tables."""
    return RunInputs(
        entities={"deals": C.order_docs(spark, sf_dir, run)},
        owners=C.supplier_docs(spark, sf_dir, run),
        pipelines=C.part_pipeline_docs(spark, sf_dir),
        associations={"deal_company_associations": C.lineitem_assoc_docs(spark, sf_dir, dealt=True)},
    )


def run_summary_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after two runs landed from the driver tables (no gates: the
    line-item edges repeat keys on purpose, which the gate would reject)."""
    contracts = C.CONTRACTS
    names = ["deals", "owners", "deal_pipeline_stages", "deal_company_associations"]
    state: dict[str, DataFrame] = {}
    for run in ("r1", "r2"):
        mapped = map_run(carrier_inputs(spark, sf_dir, run), contracts, run_id=run,
                         ingested_at=C.RUNS[run], source_system=C.SOURCE)
        state = apply_run(state, mapped, contracts)
    state = {n: state[n] for n in names}
    return run_summary(state, contracts)
