"""Registered queries: one per operator of the inventory, each over whole
driver tables, each paired (where SQL can say it) with an independent DuckDB
oracle written as closed-form SQL over the raw tables.

JSON texts that both engines build identically (objects of strings, numbers
and booleans without NULL members) are compared as text; of raw payloads,
whose NULL members the engines write differently, fields are compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import (
    INGESTED_AT, IS_CURRENT, RUN_ID, SOURCE_SYSTEM, VALID_FROM, VALID_TO, conform, ts_literal,
)
from ..functions.predicates import blank_preload, blank_stored
from ..operators import audits, gates, reads
from ..operators.flatten import (
    associations_to_rows, objects_to_rows, owners_to_rows, pipelines_to_stage_rows,
)
from ..operators.history import append_history, rows_per_run
from ..operators.scd2 import GENERAL, RUN_COLUMNS, SPLIT, UNION, change_summary, run_ends, scd2_merge, scd2_replay, scd2_splice
from ..session import ensure_checkpoint_dir
from ..sources.footers import file_schema_faults, schema_report
from ..sources.landing import chain_faults, envelope_results, page_faults, project_properties, sample_first, scope_results_to_ids
from ..sources.store import Store
from . import carriers as C
from .ingest import RunResult, audit_run, ingest_run
from .pipeline import RunInputs, run_summary_frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DEALS = C.CONTRACTS["deals"]
COMPANIES = C.CONTRACTS["companies"]
OWNERS = C.CONTRACTS["owners"]
STAGES = C.CONTRACTS["deal_pipeline_stages"]
EDGES = C.CONTRACTS["deal_company_associations"]
KEY = DEALS.business_keys[0]                         # source_id
CREATED, UPDATED = f"{C.PREFIX}_created_at", f"{C.PREFIX}_updated_at"

SCD2_OUT = [KEY, "properties_json", CREATED, UPDATED, "archived", RUN_ID, VALID_FROM, VALID_TO, IS_CURRENT]
OWNER_OUT = [c for c in OWNERS.columns if c != "raw_json"]
STAGE_OUT = [c for c in STAGES.columns if c != "raw_json"]
EDGE_OUT = [c for c in EDGES.columns if c != "raw_json"]


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ============================================================ Spark scenarios
def deal_rows(spark: SparkSession, sf: str, run: str) -> DataFrame:
    """Staged deals of a run; "all" is run 1 with every order, "empty" a run 2
    without any."""
    run_id = {"empty": "r2", "all": "r1"}.get(run, run)
    return objects_to_rows(C.order_docs(spark, sf, run), DEALS, run_id=run_id,
                           ingested_at=C.RUNS[run_id], source_system=C.SOURCE)


def deal_history(spark: SparkSession, sf: str, runs: list[str], *, form: str = GENERAL,
                 close_missing: bool = True) -> DataFrame:
    """Runs merged one after the other; the first run's rows are the first state."""
    h = deal_rows(spark, sf, runs[0])
    for r in runs[1:]:
        h = scd2_merge(h, deal_rows(spark, sf, r), DEALS, close_missing=close_missing, form=form)
    return h


def deal_state(spark: SparkSession, sf: str, names: tuple[str, ...] = ("r1", "r2", "r3")) -> DataFrame:
    """The history of several full runs in one pass: a replay reads each run
    once, where chained merges would read the first ones again and again."""
    runs = spark.createDataFrame([(i, r) for i, r in enumerate(names, 1)], "run_seq long, run_id string")
    rows = [deal_rows(spark, sf, r).withColumn("run_seq", F.lit(i).cast("long")) for i, r in enumerate(names, 1)]
    # a full extract of orders has rows, so each run ends where the next begins
    ends = F.array(*[ts_literal(C.RUNS[r]) for r in names[1:]], F.lit(None).cast("timestamp"))
    staged = reduce(DataFrame.unionByName, rows).withColumn("run_end", F.element_at(ends, F.col("run_seq").cast("int")))
    return scd2_replay(staged, runs, DEALS)


def owner_rows(spark: SparkSession, sf: str, run: str) -> DataFrame:
    return owners_to_rows(C.supplier_docs(spark, sf, run), OWNERS, run_id=run,
                          ingested_at=C.RUNS[run], source_system=C.SOURCE)


def owner_history(spark: SparkSession, sf: str) -> DataFrame:
    h = owner_rows(spark, sf, "r1")
    for r in ("r2", "r3"):
        h = append_history(h, owner_rows(spark, sf, r), OWNERS)
    return h


def edge_rows(spark: SparkSession, sf: str, run: str = "r1", *, dealt: bool = False) -> DataFrame:
    return associations_to_rows(C.lineitem_assoc_docs(spark, sf, dealt=dealt), EDGES, run_id=run,
                                ingested_at=C.RUNS[run], source_system=C.SOURCE)


def company_rows(spark: SparkSession, sf: str) -> DataFrame:
    return objects_to_rows(C.customer_docs(spark, sf), COMPANIES, run_id="r1",
                           ingested_at=C.RUNS["r1"], source_system=C.SOURCE)


def _raw(path: str, name: str):
    """A field of the kept source document."""
    return F.get_json_object("raw_json", path).alias(name)


# ============================================================ oracle building blocks
ISO_SQL = "'%Y-%m-%dT%H:%M:%SZ'"
MONEY = "CAST(CAST({} AS DECIMAL(12,2)) AS VARCHAR)"


def _ts(run: str) -> str:
    return f"TIMESTAMP '{C.RUNS[run]}'"


ORDERS_BASE = f"""
o AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, o_custkey, o_orderdate,
         strftime(o_orderdate, {ISO_SQL}) AS created,
         (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS flipped,
         (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') AS deleted
  FROM orders)"""


def _order_run_sql(run: str, *, name: str | None = None, where: str | None = None,
                   created: str = "created", ts_run: str | None = None) -> str:
    name = name or run
    ts_run = ts_run or run
    if run == "r1":
        status, updated, cond = "o_orderstatus", "created", f"o_orderdate < TIMESTAMP '{C.FIRST_CUTOFF}'"
    else:
        status = "CASE WHEN flipped THEN 'F' ELSE o_orderstatus END"
        updated = f"CASE WHEN flipped THEN '{C.R2_UPDATED}' ELSE created END"
        cond = "NOT deleted" if run == "r2" else "TRUE"
    if where:
        cond = where
    props = (f"json_object('status', {status}, 'priority', o_orderpriority, 'amount', "
             f"{MONEY.format('o_totalprice')}, 'customer', CAST(o_custkey AS VARCHAR))::VARCHAR")
    return f"""
{name} AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS {KEY}, {props} AS properties_json,
         {created} AS {CREATED}, {updated} AS {UPDATED}, false AS archived,
         '{ts_run}' AS {RUN_ID}, {_ts(ts_run)} AS {VALID_FROM}
  FROM o WHERE {cond})"""


def _diff(a: str, b: str) -> str:
    return " OR ".join(
        f"COALESCE(CAST({a}.{c} AS VARCHAR), '') <> COALESCE(CAST({b}.{c} AS VARCHAR), '')"
        for c in ("properties_json", "archived", UPDATED, CREATED))


_PAYLOAD = [KEY, "properties_json", CREATED, UPDATED, "archived", RUN_ID, VALID_FROM]


def _seed_sql(name: str, s: str) -> str:
    return f"{name} AS (SELECT {', '.join(_PAYLOAD)}, NULL::TIMESTAMP AS {VALID_TO}, true AS {IS_CURRENT} FROM {s})"


def _merge_sql(name: str, t: str, s: str, *, close_missing: bool = True) -> str:
    """Closed form of one merge of staging ``s`` (unique keys) into ``t``."""
    cm = "true" if close_missing else "false"
    pay = ", ".join(f"t.{c}" for c in _PAYLOAD)
    return f"""
{name}_c AS (
  SELECT {pay},
    CASE WHEN t.{IS_CURRENT} AND s.{KEY} IS NOT NULL AND ({_diff('t', 's')}) THEN s.{VALID_FROM}
         WHEN t.{IS_CURRENT} AND s.{KEY} IS NULL AND {cm} THEN (SELECT max({VALID_FROM}) FROM {s})
         ELSE t.{VALID_TO} END AS {VALID_TO},
    CASE WHEN t.{IS_CURRENT} AND ((s.{KEY} IS NOT NULL AND ({_diff('t', 's')})) OR (s.{KEY} IS NULL AND {cm}))
         THEN false ELSE t.{IS_CURRENT} END AS {IS_CURRENT}
  FROM {t} t LEFT JOIN {s} s ON t.{KEY} = s.{KEY}),
{name} AS (
  SELECT * FROM {name}_c
  UNION ALL
  SELECT {', '.join('s.' + c for c in _PAYLOAD)}, NULL::TIMESTAMP, true FROM {s} s
  WHERE NOT EXISTS (SELECT 1 FROM {name}_c m WHERE m.{KEY} = s.{KEY} AND m.{IS_CURRENT}))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


SCD2_SEL = ", ".join(SCD2_OUT)
H2 = [ORDERS_BASE, _order_run_sql("r1"), _order_run_sql("r2"), _seed_sql("h1", "r1"), _merge_sql("h2", "h1", "r2")]
H3 = H2 + [_order_run_sql("r3"), _merge_sql("h3", "h2", "r3")]


# ============================================================ 1. contracts
@register("conform_orders", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS {KEY}, 'deals' AS object_type, NULL::VARCHAR AS properties_json,
       NULL::VARCHAR AS raw_json, strftime(o_orderdate, {ISO_SQL}) AS {CREATED}, NULL::VARCHAR AS {UPDATED},
       (o_orderstatus = 'F') AS archived, NULL::TIMESTAMP AS {INGESTED_AT}, NULL::VARCHAR AS {RUN_ID},
       NULL::VARCHAR AS {SOURCE_SYSTEM}, NULL::TIMESTAMP AS {VALID_FROM}, NULL::TIMESTAMP AS {VALID_TO},
       NULL::BOOLEAN AS {IS_CURRENT}
FROM orders""")
def q_conform_orders(spark, sf):
    o = C.table(spark, sf, "orders")
    mapped = o.select(
        F.col("o_totalprice").alias("not_in_contract"),
        (F.col("o_orderstatus") == "F").alias("archived"),
        C.iso(F.col("o_orderdate")).alias(CREATED),
        F.col("o_orderkey").alias(KEY),
        F.lit("deals").alias("object_type"),
    )
    return conform(mapped, DEALS)


# ============================================================ 2-3. SCD2 merge
@register("scd2_merge_orders", _with(*H2) + f"SELECT {SCD2_SEL} FROM h2")
def q_scd2_merge_orders(spark, sf):
    return deal_history(spark, sf, ["r1", "r2"], form=GENERAL).select(*SCD2_OUT)


@register("scd2_merge_orders_split", ORACLE["scd2_merge_orders"])
def q_scd2_merge_orders_split(spark, sf):
    return deal_history(spark, sf, ["r1", "r2"], form=SPLIT).select(*SCD2_OUT)


@register("scd2_merge_orders_union", ORACLE["scd2_merge_orders"])
def q_scd2_merge_orders_union(spark, sf):
    return deal_history(spark, sf, ["r1", "r2"], form=UNION).select(*SCD2_OUT)


@register("scd2_partial_orders", _with(
    ORDERS_BASE, _order_run_sql("r1"), _order_run_sql("r2"), _seed_sql("h1", "r1"),
    _merge_sql("h2", "h1", "r2", close_missing=False)) + f"SELECT {SCD2_SEL} FROM h2")
def q_scd2_partial_orders(spark, sf):
    return deal_history(spark, sf, ["r1", "r2"], close_missing=False).select(*SCD2_OUT)


@register("scd2_empty_extract", _with(
    ORDERS_BASE, _order_run_sql("r1", where="TRUE"),
    _order_run_sql("r1", name="e", where=f"o_orderdate > TIMESTAMP '{C.EMPTY_HORIZON}'", ts_run="r2"),
    _seed_sql("h1", "r1"), _merge_sql("h2", "h1", "e")) + f"SELECT {SCD2_SEL} FROM h2")
def q_scd2_empty_extract(spark, sf):
    h1 = deal_rows(spark, sf, "all")
    return scd2_merge(h1, deal_rows(spark, sf, "empty"), DEALS, form=SPLIT).select(*SCD2_OUT)


@register("scd2_reopen", _with(*H3) + f"SELECT {SCD2_SEL} FROM h3")
def q_scd2_reopen(spark, sf):
    return deal_history(spark, sf, ["r1", "r2", "r3"], form=SPLIT).select(*SCD2_OUT)


# Q1: run 1 sends '' as createdAt for medium-priority orders, run 2 sends no
# createdAt at all (NULL) -- equal for change detection; high-priority pending
# orders get a new updatedAt in run 2 -- a real change.
_NB_CREATED_1 = "CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE created END"
_NB_CREATED_2 = "CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE created END"


def _null_blank_rows(spark, sf, run: str) -> DataFrame:
    o = C.table(spark, sf, "orders")
    medium = F.col("o_orderpriority") == "3-MEDIUM"
    created = C.iso(F.col("o_orderdate"))
    if run == "r1":
        created_v = F.when(medium, F.lit("")).otherwise(created)
        updated_v = created
    else:
        created_v = F.when(~medium, created)
        bump = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")
        updated_v = F.when(bump, F.lit(C.R2_UPDATED)).otherwise(created)
    docs = o.select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        C.order_properties(F.col("o_orderstatus")).alias("properties"),
        created_v.alias("createdAt"), updated_v.alias("updatedAt"), F.lit(False).alias("archived"),
    )).alias("doc"))
    return objects_to_rows(docs, DEALS, run_id=run, ingested_at=C.RUNS[run], source_system=C.SOURCE)


def _null_blank_sql(run: str) -> str:
    created = _NB_CREATED_1 if run == "r1" else _NB_CREATED_2
    props = (f"json_object('status', o_orderstatus, 'priority', o_orderpriority, 'amount', "
             f"{MONEY.format('o_totalprice')}, 'customer', CAST(o_custkey AS VARCHAR))::VARCHAR")
    updated = ("created" if run == "r1" else
               f"CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN '{C.R2_UPDATED}' ELSE created END")
    return f"""
n{run} AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS {KEY}, {props} AS properties_json, {created} AS {CREATED},
         {updated} AS {UPDATED}, false AS archived, '{run}' AS {RUN_ID}, {_ts(run)} AS {VALID_FROM}
  FROM o)"""


NB = [ORDERS_BASE, _null_blank_sql("r1"), _null_blank_sql("r2"), _seed_sql("nb1", "nr1"), _merge_sql("nb2", "nb1", "nr2")]


def null_blank_history(spark, sf) -> DataFrame:
    return scd2_merge(_null_blank_rows(spark, sf, "r1"), _null_blank_rows(spark, sf, "r2"), DEALS, form=SPLIT)


@register("scd2_null_blank", _with(*NB) + f"SELECT {SCD2_SEL} FROM nb2")
def q_scd2_null_blank(spark, sf):
    return null_blank_history(spark, sf).select(*SCD2_OUT)


@register("scd2_change_summary", _with(ORDERS_BASE, _order_run_sql("r1"), _order_run_sql("r2")) + f"""
SELECT count(s.{KEY}) AS staged,
       count(*) FILTER (WHERE s.{KEY} IS NOT NULL AND (t.{KEY} IS NULL OR ({_diff('t', 's')}))) AS opened,
       count(*) FILTER (WHERE s.{KEY} IS NOT NULL AND t.{KEY} IS NULL) AS inserted_new,
       count(*) FILTER (WHERE s.{KEY} IS NOT NULL AND t.{KEY} IS NOT NULL AND ({_diff('t', 's')})) AS closed_changed,
       count(*) FILTER (WHERE s.{KEY} IS NULL) AS closed_missing,
       count(*) FILTER (WHERE s.{KEY} IS NOT NULL AND t.{KEY} IS NOT NULL AND NOT ({_diff('t', 's')})) AS unchanged
FROM r1 t FULL OUTER JOIN r2 s ON t.{KEY} = s.{KEY}""")
def q_scd2_change_summary(spark, sf):
    h1 = deal_history(spark, sf, ["r1"])
    return change_summary(h1, deal_rows(spark, sf, "r2"), DEALS)


# ============================================================ 4. replay (D7)
def event_staging(spark, sf, *, runs: DataFrame | None = None, snaps: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Daily user snapshots as staged entity rows, each stamped with its own
    run (id = the day, time = the next midnight), plus the run list."""
    snaps = C.event_day_snapshots(spark, sf) if snaps is None else snaps
    runs = C.event_runs(spark, sf) if runs is None else runs
    docs = snaps.join(run_ends(runs, snaps, on="day"), "day").select(
        *RUN_COLUMNS, F.col(VALID_FROM).alias("__vf"), F.col("day").cast("string").alias("__run"),
        F.to_json(F.struct(F.col("user_id").cast("string").alias("id"),
                           F.struct(F.col("segment")).alias("properties"),
                           F.lit(False).alias("archived"))).alias("doc"))
    staged = objects_to_rows(docs, DEALS, run_id=F.col("__run"), ingested_at=F.col("__vf"),
                             source_system=C.SOURCE, keep=RUN_COLUMNS)
    return staged, runs


REPLAY_SQL = f"""
WITH ranked AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
snap AS (SELECT user_id, day, event_type AS segment FROM ranked WHERE rn = 1),
days AS (
  SELECT CAST(unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events),
                                     (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS day),
runs AS (
  SELECT day, CAST(datediff('day', (SELECT min(day) FROM days), day) + 1 AS INTEGER) AS run_seq,
         CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS vf
  FROM days),
st AS (
  SELECT CAST(s.user_id AS VARCHAR) AS {KEY}, json_object('segment', s.segment)::VARCHAR AS props,
         r.run_seq, r.vf, CAST(r.day AS VARCHAR) AS run_id
  FROM snap s JOIN runs r ON s.day = r.day),
fl AS (
  SELECT *, CASE WHEN lag(run_seq) OVER w IS NULL OR lag(run_seq) OVER w <> run_seq - 1
                      OR lag(props) OVER w <> props THEN 1 ELSE 0 END AS nw
  FROM st WINDOW w AS (PARTITION BY {KEY} ORDER BY run_seq)),
isl AS (SELECT *, sum(nw) OVER (PARTITION BY {KEY} ORDER BY run_seq ROWS UNBOUNDED PRECEDING) AS v FROM fl),
agg AS (SELECT {KEY}, v, min(run_seq) AS first_seq, max(run_seq) AS last_seq FROM isl GROUP BY {KEY}, v),
nonempty AS (SELECT DISTINCT run_seq FROM st)
SELECT a.{KEY}, f.props AS properties_json, f.run_id AS {RUN_ID}, f.vf AS {VALID_FROM},
       CASE WHEN a.last_seq = (SELECT max(run_seq) FROM runs) THEN NULL
            WHEN ne.run_seq IS NOT NULL THEN nr.vf ELSE NULL END AS {VALID_TO},
       a.last_seq = (SELECT max(run_seq) FROM runs) AS {IS_CURRENT}
FROM agg a JOIN isl f ON f.{KEY} = a.{KEY} AND f.run_seq = a.first_seq
LEFT JOIN runs nr ON nr.run_seq = a.last_seq + 1
LEFT JOIN nonempty ne ON ne.run_seq = a.last_seq + 1"""


@register("scd2_replay_events", REPLAY_SQL)
def q_scd2_replay_events(spark, sf):
    staged, runs = event_staging(spark, sf)
    hist = scd2_replay(staged, runs, DEALS)
    return hist.select(KEY, "properties_json", RUN_ID, VALID_FROM, VALID_TO, IS_CURRENT)


SAMPLE = 25  # objects that a sampled run keeps, by key

MIXED_SQL = REPLAY_SQL[:REPLAY_SQL.index("fl AS (")] + f"""
taken AS (
  SELECT *, row_number() OVER (PARTITION BY run_seq ORDER BY {KEY}) AS k FROM st),
mst AS (SELECT * EXCLUDE (k) FROM taken WHERE run_seq % 3 <> 0 OR k <= {SAMPLE}),
full_runs AS (SELECT run_seq, vf FROM runs WHERE run_seq % 3 <> 0),
fl AS (
  SELECT *, lag(run_seq) OVER w AS before_seq, lag(props) OVER w AS before_props,
         lead(run_seq) OVER w AS after_seq, lead(vf) OVER w AS after_vf
  FROM mst WINDOW w AS (PARTITION BY {KEY} ORDER BY run_seq)),
mk AS (
  SELECT *, CASE WHEN before_seq IS NULL OR before_props <> props
                      OR EXISTS (SELECT 1 FROM full_runs f WHERE f.run_seq > fl.before_seq AND f.run_seq < fl.run_seq) THEN 1 ELSE 0 END AS nw
  FROM fl),
isl AS (SELECT *, sum(nw) OVER (PARTITION BY {KEY} ORDER BY run_seq ROWS UNBOUNDED PRECEDING) AS v FROM mk),
agg AS (SELECT {KEY}, v, min(run_seq) AS first_seq, max(run_seq) AS last_seq FROM isl GROUP BY {KEY}, v),
ends AS (
  SELECT a.*, l.after_seq, l.after_vf, (SELECT min(f.run_seq) FROM full_runs f WHERE f.run_seq > a.last_seq) AS absent
  FROM agg a JOIN isl l ON l.{KEY} = a.{KEY} AND l.run_seq = a.last_seq)
SELECT e.{KEY}, f.props AS properties_json, f.run_id AS {RUN_ID}, f.vf AS {VALID_FROM},
       CASE WHEN e.absent IS NOT NULL AND (e.after_seq IS NULL OR e.absent < e.after_seq)
            THEN (SELECT max(s.vf) FROM mst s WHERE s.run_seq = e.absent)
            ELSE e.after_vf END AS {VALID_TO},
       e.after_seq IS NULL AND e.absent IS NULL AS {IS_CURRENT}
FROM ends e JOIN isl f ON f.{KEY} = e.{KEY} AND f.run_seq = e.first_seq"""


def sampled_event_runs(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Every third day kept a sample only: its first ``SAMPLE`` users by key."""
    runs = C.event_runs(spark, sf).withColumn("sampled", F.col("run_seq") % 3 == 0)
    snaps = C.event_day_snapshots(spark, sf).join(runs.select("day", "sampled"), "day")
    first = F.row_number().over(Window.partitionBy("day").orderBy(F.col("user_id").cast("string")))
    some = snaps.where("sampled").withColumn("k", first).where(F.col("k") <= SAMPLE).drop("k")
    return runs, snaps.where("NOT sampled").unionByName(some)


@register("scd2_replay_sampled", MIXED_SQL)
def q_scd2_replay_sampled(spark, sf):
    """D7 over full and sampled runs: only full ones see a key as absent."""
    runs, snaps = sampled_event_runs(spark, sf)
    staged, runs = event_staging(spark, sf, runs=runs, snaps=snaps)
    return scd2_replay(staged, runs, DEALS).select(KEY, "properties_json", RUN_ID, VALID_FROM, VALID_TO, IS_CURRENT)


def late_event_run(spark, sf, seq: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """The history of all days but one (by default the middle one), that day's
    rows, the next day's, and the clocks that a splice needs."""
    snaps, days = C.event_day_snapshots(spark, sf), C.event_runs(spark, sf)
    listed = days.join(snaps.select("day").distinct().withColumn("seen", F.lit(True)), "day", "left").orderBy("run_seq").collect()  # the run list
    late = listed[len(listed) // 2 if seq is None else seq - 1]
    others = days.where(F.col("run_seq") != late.run_seq)
    staged, runs = event_staging(spark, sf, runs=others, snaps=snaps.where(F.col("day") != late.day))
    history = scd2_replay(staged, runs, DEALS)
    day = lambda n: event_staging(spark, sf, runs=days.where(F.col("run_seq") == n), snaps=snaps)[0].select(*DEALS.columns)
    empty = [ts_literal(r[VALID_FROM]) for r in listed if not r.seen and r.run_seq != late.run_seq]
    clocks = {"at": ts_literal(late[VALID_FROM]), "next_at": ts_literal(listed[late.run_seq][VALID_FROM]), "empty_runs": F.array(*empty).cast("array<timestamp>")}
    return history, day(late.run_seq), day(late.run_seq + 1), clocks


@register("scd2_late_run", REPLAY_SQL)
def q_scd2_late_run(spark, sf):
    """D7: a day that arrived late, spliced into the history of the others."""
    history, late, following, clocks = late_event_run(spark, sf)
    return scd2_splice(history, late, following, DEALS, **clocks).select(KEY, "properties_json", RUN_ID, VALID_FROM, VALID_TO, IS_CURRENT)


# ============================================================ 5. reads
@register("current_state", _with(*H3) + f"SELECT {SCD2_SEL} FROM h3 WHERE {IS_CURRENT}")
def q_current_state(spark, sf):
    return reads.current_state(deal_state(spark, sf)).select(*SCD2_OUT)


@register("version_history_top20", _with(*H3) + f"""
SELECT {SCD2_SEL} FROM h3 ORDER BY {KEY} ASC, {VALID_FROM} DESC, {RUN_ID} DESC LIMIT 20""")
def q_version_history_top20(spark, sf):
    h = deal_state(spark, sf)
    return reads.version_history(h.select(*SCD2_OUT), [KEY], limit=20)


AS_OF = "2024-01-02 12:00:00"


@register("as_of", _with(*H3) + f"""
SELECT {SCD2_SEL} FROM h3
WHERE {VALID_FROM} <= TIMESTAMP '{AS_OF}'
  AND ({VALID_TO} > TIMESTAMP '{AS_OF}' OR ({VALID_TO} IS NULL AND COALESCE({IS_CURRENT}, false)))""")
def q_as_of(spark, sf):
    return reads.as_of(deal_state(spark, sf), AS_OF).select(*SCD2_OUT)


OWNERS_SQL = f"""
WITH own AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS owner_id,
         CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey + 1000 AS VARCHAR) END AS user_id,
         lower(replace(s_name, '#', '.')) || CASE WHEN r.run = 'r3' THEN '@example.org' ELSE '@example.com' END AS email,
         'Supplier' AS first_name, CAST(s_suppkey AS VARCHAR) AS last_name,
         CASE WHEN s_acctbal < 0 THEN '[]' ELSE '[{{"id":"n' || CAST(s_nationkey AS VARCHAR) || '"}}]' END AS teams_json,
         '2020-01-01T00:00:00Z' AS {CREATED}, NULL::VARCHAR AS {UPDATED}, false AS archived,
         r.ts AS {INGESTED_AT}, r.run AS {RUN_ID}, '{C.SOURCE}' AS {SOURCE_SYSTEM}
  FROM supplier
  CROSS JOIN (VALUES ('r1', {_ts('r1')}), ('r2', {_ts('r2')}), ('r3', {_ts('r3')})) r(run, ts)
  WHERE NOT (r.run = 'r2' AND s_nationkey = 0))
"""
OWNER_SEL = ", ".join(OWNER_OUT)


@register("latest_run", OWNERS_SQL + f"SELECT {OWNER_SEL} FROM own WHERE {RUN_ID} = 'r3'")
def q_latest_run(spark, sf):
    return reads.latest_run(owner_history(spark, sf)).select(*OWNER_OUT)


@register("run_snapshot", OWNERS_SQL + f"SELECT {OWNER_SEL} FROM own WHERE {RUN_ID} = 'r2'")
def q_run_snapshot(spark, sf):
    return reads.run_snapshot(owner_history(spark, sf), "r2").select(*OWNER_OUT)


NOW = "2024-01-03 06:00:00"


@register("freshness", OWNERS_SQL + f"""
SELECT max({INGESTED_AT}) AS last_ingested_at,
       (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max({INGESTED_AT}))) / 3600000000.0 AS age_hours,
       (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max({INGESTED_AT}))) / 3600000000.0 <= 24.0 AS fresh
FROM own""")
def q_freshness(spark, sf):
    return reads.freshness(owner_history(spark, sf), NOW)


RETENTION_NOW = "2024-04-01 12:00:00"


@register("retention", _with(*H3) + f"""
SELECT {SCD2_SEL} FROM h3
WHERE {VALID_FROM} >= TIMESTAMP '{RETENTION_NOW}' - INTERVAL 90 DAY OR COALESCE({IS_CURRENT}, false)""")
def q_retention(spark, sf):
    h = deal_state(spark, sf)
    return reads.retention_window(h, RETENTION_NOW, days=90).select(*SCD2_OUT)


@register("retention_purge", _with(*H3) + f"""
SELECT {RUN_ID}, count(*) FILTER (WHERE k) AS kept, count(*) FILTER (WHERE NOT k) AS dropped
FROM (SELECT {RUN_ID}, {VALID_FROM} >= TIMESTAMP '{RETENTION_NOW}' - INTERVAL 90 DAY OR COALESCE({IS_CURRENT}, false) AS k FROM h3)
GROUP BY {RUN_ID}""")
def q_retention_purge(spark, sf):
    """G6: what a purge keeps and drops of each run's versions."""
    return reads.retention_report(deal_state(spark, sf), RETENTION_NOW, by=RUN_ID)


@register("schema_report", f"""
WITH n AS (SELECT DISTINCT CAST(o_orderkey % 4 AS VARCHAR) AS part FROM orders)
SELECT part, 'extra_column' AS fault, 'note' AS field, 'string' AS found, NULL AS wanted FROM n WHERE part = '2'
UNION ALL SELECT part, 'missing_column', 'raw_json', NULL, 'string' FROM n WHERE part = '1'
UNION ALL SELECT part, 'other_type', 'archived', 'string', 'boolean' FROM n WHERE part = '3'""")
def q_schema_report(spark, sf):
    """V15 on stored files: a quarter of the deals each is written as the
    contract says, without a column, with one more, and with another type."""
    rows = deal_rows(spark, sf, "all")
    path = f"{ensure_checkpoint_dir(spark)}/schema-report-{uuid.uuid4().hex}"
    drifted = {0: rows, 1: rows.drop("raw_json"), 2: rows.withColumn("note", F.lit("x")), 3: rows.withColumn("archived", F.col("archived").cast("string"))}
    for k, part in drifted.items():
        part.where(F.col(KEY).cast("long") % 4 == k).write.parquet(f"{path}/{k}")
    faults = file_schema_faults(spark, [f"{path}/{k}" for k in drifted], DEALS.schema)
    return schema_report(faults.withColumn("part", F.regexp_extract("file", "/([^/]+)/[^/]+$", 1)), "part").drop("files")


@register("current_counts", _with(*H3) + f"""
SELECT 'deals' AS table_name, count(*) AS n FROM h3 WHERE {IS_CURRENT}
UNION ALL SELECT 'companies', count(*) FROM customer""")
def q_current_counts(spark, sf):
    deals = reads.count_current(deal_state(spark, sf))
    comps = reads.count_current(company_rows(spark, sf))
    return (deals.select(F.lit("deals").alias("table_name"), "n")
            .unionByName(comps.select(F.lit("companies").alias("table_name"), "n")))


# ============================================================ 6. flatten
COMPANY_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS {KEY}, 'companies' AS object_type,
       json_object('name', c_name, 'domain', lower(replace(c_name, '#', '-')) || '.example',
                   'segment', c_mktsegment, 'balance', {MONEY.format('c_acctbal')},
                   'nation', CAST(c_nationkey AS VARCHAR))::VARCHAR AS properties_json,
       '2020-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS {CREATED},
       '2023-12-31T00:00:00Z' AS {UPDATED}, c_acctbal < 0 AS archived, 'r1' AS {RUN_ID},
       {_ts('r1')} AS {VALID_FROM}, NULL::TIMESTAMP AS {VALID_TO}, true AS {IS_CURRENT},
       CAST(c_custkey AS VARCHAR) AS raw_id, c_name AS raw_name
FROM customer"""


@register("flatten_object", COMPANY_SQL)
def q_flatten_object(spark, sf):
    return company_rows(spark, sf).select(KEY, "object_type", *SCD2_OUT[1:], _raw("$.id", "raw_id"), _raw("$.properties.name", "raw_name"))


@register("flatten_owner", OWNERS_SQL + f"SELECT {OWNER_SEL}, email AS raw_email FROM own WHERE {RUN_ID} = 'r1'")
def q_flatten_owner(spark, sf):
    return owner_rows(spark, sf, "r1").select(*OWNER_OUT, _raw("$.email", "raw_email"))


@register("flatten_stages", f"""
SELECT p_brand || '/' || CAST(floor(p_partkey / 100) AS BIGINT) || '|' || CAST(p_partkey AS VARCHAR) AS pipeline_stage_key,
       p_brand || '/' || CAST(floor(p_partkey / 100) AS BIGINT) AS pipeline_id, p_brand AS pipeline_label,
       CAST(p_partkey AS VARCHAR) AS stage_id, p_name AS stage_label, p_size AS display_order,
       json_object('type', p_type, 'price', {MONEY.format('p_retailprice')})::VARCHAR AS metadata_json,
       '2020-01-01T00:00:00Z' AS pipeline_created_at, NULL::VARCHAR AS pipeline_updated_at,
       false AS pipeline_archived, NULL::VARCHAR AS stage_created_at, NULL::VARCHAR AS stage_updated_at,
       CAST(p_partkey AS VARCHAR) AS raw_stage, p_brand AS raw_pipeline, p_size > 45 AS stage_archived, {_ts('r1')} AS {INGESTED_AT}, 'r1' AS {RUN_ID}, '{C.SOURCE}' AS {SOURCE_SYSTEM}
FROM part""")
def q_flatten_stages(spark, sf):
    return pipelines_to_stage_rows(C.part_pipeline_docs(spark, sf), STAGES, run_id="r1",
                                   ingested_at=C.RUNS["r1"], source_system=C.SOURCE).select(
        *STAGE_OUT, _raw("$.stage.id", "raw_stage"), _raw("$.pipeline.label", "raw_pipeline"))


EDGES_SQL = f"""
WITH e AS (
  -- a part key of 0 is a falsy toObjectId with no id to fall back on: no edge
  SELECT CAST(l_orderkey AS VARCHAR) AS deal_id, CAST(l_partkey AS VARCHAR) AS company_id,
         NULL::VARCHAR AS association_category, NULL::BIGINT AS association_type_id, NULL::VARCHAR AS association_label
  FROM lineitem WHERE l_returnflag = 'N' AND l_partkey <> 0
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), 'ORDER_LINE', CAST(l_linenumber AS BIGINT), l_returnflag
  FROM lineitem WHERE l_returnflag <> 'N' AND l_partkey <> 0
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), 'LINE_STATUS',
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END, l_linestatus
  FROM lineitem WHERE l_returnflag <> 'N' AND l_partkey <> 0
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), 'SUPPLIER', 7, 'supplies' FROM lineitem),
edges AS (
  SELECT *, {_ts('r1')} AS {INGESTED_AT}, 'r1' AS {RUN_ID}, '{C.SOURCE}' AS {SOURCE_SYSTEM} FROM e)
"""
EDGE_SEL = ", ".join(EDGE_OUT)


@register("flatten_associations", EDGES_SQL + f"SELECT {EDGE_SEL}, deal_id AS raw_from FROM edges")
def q_flatten_associations(spark, sf):
    return edge_rows(spark, sf, dealt=True).select(*EDGE_OUT, _raw("$.from.id", "raw_from"))


@register("page_envelope", _with(ORDERS_BASE, _order_run_sql("r1", where="TRUE")) + f"""
SELECT {KEY}, properties_json, {CREATED}, {UPDATED}, archived, {RUN_ID}, {VALID_FROM},
       NULL::TIMESTAMP AS {VALID_TO}, true AS {IS_CURRENT} FROM r1""")
def q_page_envelope(spark, sf):
    docs = envelope_results(C.order_pages(spark, sf, "all"))
    return objects_to_rows(docs, DEALS, run_id="r1", ingested_at=C.RUNS["r1"],
                           source_system=C.SOURCE).select(*SCD2_OUT)


# ============================================================ 7. gates
def faulty_company_rows(spark, sf) -> DataFrame:
    """Company batch with faults injected by rules over the customer columns."""
    c = C.table(spark, sf, "customer")
    rows = company_rows(spark, sf).join(
        c.select(F.col("c_custkey").cast("string").alias(KEY), "c_nationkey", "c_mktsegment", "c_acctbal"), KEY)
    seg, nat = F.col("c_mktsegment"), F.col("c_nationkey")
    return rows.select(
        F.when((seg == "AUTOMOBILE") & (F.col("c_acctbal") < 0), F.lit(" \t "))
         .when(nat.between(5, 7), F.concat(F.lit("dup-"), nat.cast("string")))
         .otherwise(F.col(KEY)).alias(KEY),
        *[c_ for c_ in COMPANIES.columns if c_ not in (KEY, "raw_json", INGESTED_AT, RUN_ID, SOURCE_SYSTEM, VALID_FROM, IS_CURRENT)],
        F.when(nat == 8, F.lit(None).cast("timestamp")).otherwise(F.col(INGESTED_AT)).alias(INGESTED_AT),
        F.when((nat == 0) & (seg == "BUILDING"), F.lit("")).otherwise(F.col("raw_json")).alias("raw_json"),
        F.when((nat == 1) & (seg == "FURNITURE"), F.lit("")).otherwise(F.col(RUN_ID)).alias(RUN_ID),
        F.when((nat == 2) & (seg == "HOUSEHOLD"), F.lit("other")).otherwise(F.col(SOURCE_SYSTEM)).alias(SOURCE_SYSTEM),
        F.when(nat == 4, F.lit(None).cast("timestamp")).otherwise(F.col(VALID_FROM)).alias(VALID_FROM),
        F.when((nat == 3) & (seg == "MACHINERY"), F.lit(False)).when(nat == 9, F.lit(None).cast("boolean"))
         .otherwise(F.col(IS_CURRENT)).alias(IS_CURRENT),
    )


@register("gate_violations", f"""
WITH b AS (
  SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0 THEN 'blank'
              WHEN c_nationkey BETWEEN 5 AND 7 THEN 'dup-' || CAST(c_nationkey AS VARCHAR)
              ELSE CAST(c_custkey AS VARCHAR) END AS id, *
  FROM customer),
r AS (
  SELECT 'required_key' AS rule, '{KEY}' AS field, count(*) FILTER (WHERE id = 'blank') AS issues FROM b
  UNION ALL SELECT 'raw_json', 'raw_json', count(*) FILTER (WHERE c_nationkey = 0 AND c_mktsegment = 'BUILDING') FROM b
  UNION ALL SELECT 'tech_field', '{RUN_ID}', count(*) FILTER (WHERE c_nationkey = 1 AND c_mktsegment = 'FURNITURE') FROM b
  UNION ALL SELECT 'tech_field', '{INGESTED_AT}', count(*) FILTER (WHERE c_nationkey = 8) FROM b
  UNION ALL SELECT 'source_system', '{SOURCE_SYSTEM}', count(*) FILTER (WHERE c_nationkey = 2 AND c_mktsegment = 'HOUSEHOLD') FROM b
  UNION ALL SELECT 'scd2_seed', '{IS_CURRENT}', count(*) FILTER (WHERE c_nationkey = 9 OR (c_nationkey = 3 AND c_mktsegment = 'MACHINERY')) FROM b
  UNION ALL SELECT 'scd2_seed', '{VALID_FROM}', count(*) FILTER (WHERE c_nationkey = 4) FROM b
  UNION ALL SELECT 'duplicate_key', '{KEY}', (SELECT sum(n - 1) FROM (SELECT id, count(*) AS n FROM b GROUP BY id HAVING count(*) > 1)))
SELECT 'companies' AS label, rule, field, CAST(issues AS BIGINT) AS issues FROM r WHERE issues > 0""")
def q_gate_violations(spark, sf):
    v = gates.violations(faulty_company_rows(spark, sf), COMPANIES, source_system=C.SOURCE, scd2=True)
    return gates.violation_summary(v)


@register("gate_report", f"""
SELECT label, CAST(sum(issues) AS BIGINT) AS issues, CAST(least(10, sum(issues)) AS INTEGER) AS shown
FROM ({ORACLE["gate_violations"]}) GROUP BY label""")
def q_gate_report(spark, sf):
    """V7: the total, and the first ten breaches."""
    v = gates.violations(faulty_company_rows(spark, sf), COMPANIES, source_system=C.SOURCE, scd2=True)
    return gates.gate_report(v).select("label", "issues", F.size("examples").alias("shown"))


@register("page_faults", """
WITH p AS (SELECT DISTINCT CAST(floor(o_orderkey / 100) AS BIGINT) AS page FROM orders)
SELECT CASE WHEN page % 7 = 3 THEN 'not_json' ELSE 'no_results' END AS fault, count(*) AS pages
FROM p WHERE page % 7 = 3 OR page % 11 = 5 GROUP BY 1""")
def q_page_faults(spark, sf):
    """S1: damaged pages are found, not read as empty ones."""
    return page_faults(C.broken_order_pages(spark, sf)).groupBy("fault").agg(F.count(F.lit(1)).alias("pages"))


@register("page_chain", """
WITH p AS (SELECT DISTINCT CAST(floor(o_orderkey / 100) AS BIGINT) AS page FROM orders),
m AS (SELECT max(page) AS last, CAST(floor(max(page) / 2) AS BIGINT) AS half FROM p),
f AS (
  SELECT 'no_first' AS extract, 'first_page' AS fault, NULL AS cursor, 0 AS pages
  UNION ALL SELECT 'no_first', 'unreached_page', '100', 1
  UNION ALL SELECT 'no_middle', 'lost_page', CAST(page * 100 AS VARCHAR), 1 FROM p WHERE page % 7 = 3
  UNION ALL SELECT 'no_middle', 'unreached_page', CAST(page * 100 AS VARCHAR), 1 FROM p WHERE page % 7 = 4
  UNION ALL SELECT 'no_middle', 'last_page', NULL, 0 FROM m WHERE last % 7 = 3
  UNION ALL SELECT 'no_last', 'lost_page', CAST(last * 100 AS VARCHAR), 1 FROM m
  UNION ALL SELECT 'no_last', 'last_page', NULL, 0
  UNION ALL SELECT 'doubled', 'doubled_page', CAST(page * 100 AS VARCHAR), 2 FROM p WHERE page % 11 = 5
  UNION ALL SELECT 'doubled', 'last_page', NULL, 2 FROM m WHERE last % 11 = 5
  UNION ALL SELECT 'cycle', 'endless_page', CAST(page * 100 AS VARCHAR), 1 FROM p, m WHERE page >= half)
SELECT extract, fault, cursor, CAST(pages AS BIGINT) AS pages FROM f""")
def q_page_chain(spark, sf):
    """S1: pages lost at any place, landed twice, or off the chain are found."""
    return chain_faults(C.order_page_chains(spark, sf), "extract")


@register("gate_duplicates", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def q_gate_duplicates(spark, sf):
    return gates.duplicate_keys(C.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("gate_required_subset", EDGES_SQL + f"""
SELECT 'deal_company_associations' AS label, 'duplicate_key' AS rule,
       '{','.join(EDGES.business_keys)}' AS field, CAST(sum(n - 1) AS BIGINT) AS issues
FROM (SELECT count(*) AS n FROM edges GROUP BY {', '.join(EDGES.business_keys)} HAVING count(*) > 1)
HAVING sum(n - 1) > 0""")
def q_gate_required_subset(spark, sf):
    v = gates.violations(edge_rows(spark, sf, dealt=True), EDGES, source_system=C.SOURCE,
                         required_keys=(EDGES.from_id, EDGES.to_id))
    return gates.violation_summary(v)


def _blank_probe(c):
    seg = F.col("c_mktsegment")
    return (F.when(seg == "AUTOMOBILE", F.lit("\t")).when(seg == "BUILDING", F.lit("   "))
            .when(seg == "FURNITURE", F.lit("")).when(seg == "HOUSEHOLD", F.lit(None).cast("string"))
            .when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.col("c_name")))


@register("blank_preload_vs_stored", """
WITH v AS (
  SELECT c_mktsegment AS segment,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') THEN true
              WHEN c_acctbal < 0 THEN true ELSE false END AS pre,
         CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD') THEN true ELSE false END AS post
  FROM customer)
SELECT segment, count(*) AS n_rows, count(*) FILTER (WHERE pre) AS preload_blank,
       count(*) FILTER (WHERE post) AS stored_blank
FROM v GROUP BY segment""")
def q_blank_preload_vs_stored(spark, sf):
    c = C.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"),
                                              _blank_probe(None).alias("value"))
    return c.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(blank_preload(F.col("value")), 1).otherwise(0)).cast("long").alias("preload_blank"),
        F.sum(F.when(blank_stored(F.col("value")), 1).otherwise(0)).cast("long").alias("stored_blank"),
    )


# ============================================================ 8. audits
@register("audit_one_current", _with(*H3) + f"""
, corrupt AS (
  SELECT {KEY} FROM h3 WHERE {IS_CURRENT}
  UNION ALL
  SELECT {KEY} FROM h3 WHERE {IS_CURRENT}
    AND json_extract_string(properties_json, '$.priority') = '1-URGENT'
    AND json_extract_string(properties_json, '$.status') = 'P')
SELECT {KEY}, count(*) AS current_rows FROM corrupt GROUP BY {KEY} HAVING count(*) > 1""")
def q_audit_one_current(spark, sf):
    h = deal_state(spark, sf)
    p = F.col("properties_json")
    dup = h.where(F.col(IS_CURRENT) & (F.get_json_object(p, "$.priority") == "1-URGENT")
                  & (F.get_json_object(p, "$.status") == "P")).withColumn(RUN_ID, F.lit("dup"))
    return audits.multi_current(h.unionByName(dup), [KEY])


REQ_CURRENT = [KEY, CREATED, UPDATED, VALID_FROM, IS_CURRENT, RUN_ID]


@register("audit_required_current", _with(*NB) + f"""
SELECT count(*) AS rows, """ + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS {c}" for c in REQ_CURRENT)
    + f" FROM nb2 WHERE {IS_CURRENT}")
def q_audit_required_current(spark, sf):
    return audits.blank_counts(null_blank_history(spark, sf), REQ_CURRENT, current_only=True)


@register("audit_unique_keys_nulls", EDGES_SQL + f"""
SELECT (SELECT count(*) FROM edges) AS total,
       (SELECT count(*) FROM (SELECT DISTINCT {', '.join(EDGES.business_keys)} FROM edges)) AS distinct_keys""")
def q_audit_unique_keys_nulls(spark, sf):
    return audits.key_uniqueness(edge_rows(spark, sf, dealt=True), list(EDGES.business_keys))


@register("audit_run_scoped", OWNERS_SQL + f"""
SELECT {RUN_ID}, count(*) AS rows,
       count(*) FILTER (WHERE user_id IS NULL OR trim(user_id) = '') AS user_id,
       count(*) FILTER (WHERE email IS NULL OR trim(email) = '') AS email,
       count(DISTINCT owner_id) AS distinct_keys
FROM own GROUP BY {RUN_ID}""")
def q_audit_run_scoped(spark, sf):
    h = owner_history(spark, sf)
    return audits.run_report(h, ["owner_id"], ["user_id", "email"], by=[RUN_ID])


@register("dq_metrics", _with(*H3) + f""",
{OWNERS_SQL.strip()[5:]}
SELECT 'deals' AS table_name, count(*) AS rows,
       round(100.0 * (7 * count(*) - sum({' + '.join(f"CAST({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' AS INTEGER)"
             for c in (KEY, 'properties_json', VALID_FROM, IS_CURRENT, VALID_FROM, RUN_ID))})) / (7 * count(*)), 4) AS completeness_pct,
       round(100.0 * count(DISTINCT {KEY}) / count(*), 4) AS uniqueness_pct
FROM h3 WHERE {IS_CURRENT}
UNION ALL
SELECT 'owners', count(*),
       round(100.0 * (7 * count(*) - count(*) FILTER (WHERE owner_id IS NULL OR trim(owner_id) = '')) / (7 * count(*)), 4),
       round(100.0 * (SELECT count(*) FROM (SELECT DISTINCT owner_id, {RUN_ID} FROM own)) / count(*), 4)
FROM own""")
def q_dq_metrics(spark, sf):
    deals = audits.dq_metrics(deal_state(spark, sf), DEALS)
    owners = audits.dq_metrics(owner_history(spark, sf), OWNERS)
    return deals.unionByName(owners)


# ============================================================ 9. append + scoping
@register("append_history", OWNERS_SQL + f"SELECT {OWNER_SEL} FROM own")
def q_append_history(spark, sf):
    return owner_history(spark, sf).select(*OWNER_OUT)


@register("assoc_scope_semi", EDGES_SQL + f""", {ORDERS_BASE.strip()}
SELECT {EDGE_SEL} FROM edges
WHERE deal_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM o WHERE NOT deleted)""")
def q_assoc_scope_semi(spark, sf):
    ids = deal_rows(spark, sf, "r2").select(F.col(KEY).alias("id"))
    results = scope_results_to_ids(C.lineitem_assoc_docs(spark, sf, dealt=True), ids)
    return associations_to_rows(results, EDGES, run_id="r1", ingested_at=C.RUNS["r1"],
                                source_system=C.SOURCE).select(*EDGE_OUT)


@register("sample_first_n", _with(ORDERS_BASE, _order_run_sql("r3")) + f"""
SELECT {KEY}, properties_json, {CREATED}, {UPDATED}, archived, {RUN_ID}, {VALID_FROM}
FROM r3 ORDER BY {KEY} LIMIT 25""")
def q_sample_first_n(spark, sf):
    rows = deal_rows(spark, sf, "r3").select(*SCD2_OUT[:7])
    return sample_first(rows, 25, [KEY])


# ============================================================ 9b. more operators
@register("property_projection", _with(ORDERS_BASE, _order_run_sql("r1", where="TRUE")) + f"""
SELECT {KEY}, json_object('status', json_extract_string(properties_json, '$.status'),
                          'amount', json_extract_string(properties_json, '$.amount'))::VARCHAR AS properties_projected
FROM r1""")
def q_property_projection(spark, sf):
    """S5: keep only the requested property keys (source key order kept)."""
    docs = project_properties(C.order_docs(spark, sf, "all"), ["amount", "status"])
    return docs.select(F.get_json_object("doc", "$.id").alias(KEY), "properties_projected")


@register("scd2_version_keys_unique", _with(*H3) + f"""
SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT {KEY}, {VALID_FROM} FROM h3)) AS distinct_keys
FROM h3""")
def q_scd2_version_keys_unique(spark, sf):
    """V10 over the SCD2 version grain (key + _valid_from)."""
    h = deal_state(spark, sf)
    return audits.key_uniqueness(h, list(DEALS.version_keys()))


@register("audit_required_append", OWNERS_SQL + """
SELECT count(*) AS rows, """ + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS {c}"
    for c in ("owner_id", "user_id", "email", INGESTED_AT, RUN_ID, SOURCE_SYSTEM)) + " FROM own")
def q_audit_required_append(spark, sf):
    """V11 whole table, one scan for all columns."""
    return audits.blank_counts(owner_history(spark, sf),
                               ["owner_id", "user_id", "email", INGESTED_AT, RUN_ID, SOURCE_SYSTEM])


@register("count_by_run", OWNERS_SQL + f"SELECT {RUN_ID}, count(*) AS n FROM own GROUP BY {RUN_ID}")
def q_count_by_run(spark, sf):
    """A2 per run scope."""
    return rows_per_run(owner_history(spark, sf))


def _raw_only_rows(spark, sf) -> DataFrame:
    """Run 2 = run 1's objects; not-specified-priority orders carry one more
    top-level field (raw text changes, change attributes do not)."""
    o = C._order_run_columns(C.table(spark, sf, "orders"), "all")
    note = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("re-synced"))
    docs = o.select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        C.order_properties(F.col("status")).alias("properties"),
        C.iso(F.col("o_orderdate")).alias("createdAt"), F.col("updated").alias("updatedAt"),
        F.lit(False).alias("archived"), note.alias("note"))).alias("doc"))
    return objects_to_rows(docs, DEALS, run_id="r2", ingested_at=C.RUNS["r2"], source_system=C.SOURCE)


@register("scd2_raw_only_change", _with(ORDERS_BASE, _order_run_sql("r1", where="TRUE"), _seed_sql("h1", "r1"))
          + f"SELECT {SCD2_SEL}, raw_changed FROM h1 JOIN (SELECT {KEY}, o_orderpriority = '4-NOT SPECIFIED' AS raw_changed "
          + f"FROM r1 JOIN o ON r1.{KEY} = CAST(o.o_orderkey AS VARCHAR)) USING ({KEY})")
def q_scd2_raw_only_change(spark, sf):
    """Q3: a raw-only change opens no version; the open row keeps run 1."""
    h1 = deal_rows(spark, sf, "all")
    s2 = _raw_only_rows(spark, sf)
    h2 = scd2_merge(h1, s2, DEALS, form=SPLIT)
    changed = s2.select(KEY, F.get_json_object("raw_json", "$.note").isNotNull().alias("raw_changed"))
    return h2.select(*SCD2_OUT).join(changed, KEY)


@register("scd2_sampled_run", _with(
    ORDERS_BASE, _order_run_sql("r1"), _order_run_sql("r2", name="r2all"),
    f"r2 AS (SELECT * FROM r2all ORDER BY {KEY} LIMIT 25)", _seed_sql("h1", "r1"),
    _merge_sql("h2", "h1", "r2", close_missing=False)) + f"SELECT {SCD2_SEL} FROM h2")
def q_scd2_sampled_run(spark, sf):
    """Q16: a sampled run (first 25 by key) merges without closing missing."""
    h1 = deal_history(spark, sf, ["r1"])
    sample = sample_first(deal_rows(spark, sf, "r2"), 25, [KEY])
    return scd2_merge(h1, sample, DEALS, close_missing=False, form=SPLIT).select(*SCD2_OUT)


def _blank_sql(column: str) -> str:
    return f"({column} IS NULL OR trim(CAST({column} AS VARCHAR)) = '')"


SCD2_REQUIRED = {KEY: KEY, "raw_json": "properties_json", VALID_FROM: VALID_FROM, IS_CURRENT: IS_CURRENT,
                 INGESTED_AT: VALID_FROM, RUN_ID: RUN_ID, SOURCE_SYSTEM: f"'{C.SOURCE}'"}


@register("audit_scd2_bundle", _with(*H3) + f"""
, k AS (
  SELECT {KEY}, count(*) AS n,
""" + ",\n".join(f"  count(*) FILTER (WHERE {_blank_sql(x)}) AS b_{c}" for c, x in SCD2_REQUIRED.items()) + f"""
  FROM h3 WHERE {IS_CURRENT} GROUP BY {KEY})
SELECT CAST(sum(n) AS BIGINT) AS current_rows, count(*) FILTER (WHERE n > 1) AS bad_keys, """ + ", ".join(
    f"CAST(sum(b_{c}) AS BIGINT) AS {c}" for c in SCD2_REQUIRED) + " FROM k")
def q_audit_scd2_bundle(spark, sf):
    """V13 in one pass: required columns on current rows + one current per key."""
    return audits.audit_report(deal_state(spark, sf), DEALS)


OWNER_REQUIRED = {"owner_id": "owner_id", "raw_json": "owner_id", INGESTED_AT: INGESTED_AT, RUN_ID: RUN_ID, SOURCE_SYSTEM: SOURCE_SYSTEM}


@register("audit_append_bundle", OWNERS_SQL + f"""
, k AS (
  SELECT owner_id, {RUN_ID} AS run, count(*) AS n,
""" + ",\n".join(f"  count(*) FILTER (WHERE {_blank_sql(x)}) AS b_{c}" for c, x in OWNER_REQUIRED.items()) + f"""
  FROM own GROUP BY owner_id, {RUN_ID})
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, """ + ", ".join(
    f"CAST(sum(b_{c}) AS BIGINT) AS {c}" for c in OWNER_REQUIRED) + " FROM k")
def q_audit_append_bundle(spark, sf):
    """V12 in one pass: required ids + unique (key, run) over the whole table."""
    return audits.audit_report(owner_history(spark, sf), OWNERS)


# ============================================================ 10. pipeline summary
@register("run_summary", _with(*H2) + f""",
{OWNERS_SQL.strip()[5:]}
, {EDGES_SQL.strip()[5:]}
SELECT 'deals' AS table_name, 'current' AS metric, count(*) AS n FROM h2 WHERE {IS_CURRENT}
UNION ALL SELECT 'owners', 'total', count(*) FROM own WHERE {RUN_ID} IN ('r1', 'r2')
UNION ALL SELECT 'deal_pipeline_stages', 'total', 2 * count(*) FROM part
UNION ALL SELECT 'deal_company_associations', 'total',
  (SELECT count(*) FROM edges WHERE deal_id IN (SELECT {KEY} FROM r1))
  + (SELECT count(*) FROM edges WHERE deal_id IN (SELECT {KEY} FROM r2))""")
def q_run_summary(spark, sf):
    return run_summary_frame(spark, sf)


# ============================================================ 11. audits of faulty tables
def faulty_deal_history(spark, sf) -> DataFrame:
    """Three runs, damaged by rule: blank run ids, raw texts and stamps, absent
    sources, and keys that are open twice."""
    h = deal_state(spark, sf)
    priority, status = (F.get_json_object("properties_json", f"$.{x}") for x in ("priority", "status"))
    twice = h.where(F.col(IS_CURRENT) & (priority == "3-MEDIUM") & (status == "P")).withColumn(RUN_ID, F.lit("again"))
    return h.unionByName(twice).withColumns({
        RUN_ID: F.when(priority == "1-URGENT", F.lit("  ")).otherwise(F.col(RUN_ID)),
        SOURCE_SYSTEM: F.when(priority != "2-HIGH", F.col(SOURCE_SYSTEM)),
        "raw_json": F.when(priority == "5-LOW", F.lit("")).otherwise(F.col("raw_json")),
        INGESTED_AT: F.when((priority != "4-NOT SPECIFIED") | (status != "P"), F.col(INGESTED_AT))})


FAULTY_DEALS = f"""
p3 AS (
  SELECT *, json_extract_string(properties_json, '$.priority') AS priority, json_extract_string(properties_json, '$.status') AS status FROM h3),
f3 AS (
  SELECT {KEY}, {VALID_FROM}, {IS_CURRENT},
         CASE WHEN priority = '1-URGENT' THEN '  ' ELSE {RUN_ID} END AS {RUN_ID},
         CASE WHEN priority <> '2-HIGH' THEN '{C.SOURCE}' END AS {SOURCE_SYSTEM},
         CASE WHEN priority = '5-LOW' THEN '' ELSE properties_json END AS raw_json,
         CASE WHEN priority <> '4-NOT SPECIFIED' OR status <> 'P' THEN {VALID_FROM} END AS {INGESTED_AT}
  FROM (SELECT * FROM p3 UNION ALL SELECT * FROM p3 WHERE {IS_CURRENT} AND priority = '3-MEDIUM' AND status = 'P')
  WHERE {IS_CURRENT})"""


def faulty_owner_history(spark, sf) -> DataFrame:
    """Three runs, damaged by rule: blank owner ids (so one key a run), absent
    sources, empty raw texts, and rows that are there twice."""
    h = owner_history(spark, sf)
    h = h.unionByName(h.where((F.col(RUN_ID) == "r1") & (F.col("teams_json") == '[{"id":"n1"}]')))
    none = F.col("user_id").isNull()
    of = lambda run: none & (F.col(RUN_ID) == run)
    return h.withColumns({
        "owner_id": F.when(of("r3"), F.lit("  ")).otherwise(F.col("owner_id")),
        SOURCE_SYSTEM: F.when(~of("r2"), F.col(SOURCE_SYSTEM)),
        "raw_json": F.when(of("r1"), F.lit("")).otherwise(F.col("raw_json"))})


FAULTY_OWNERS = f"""
fo AS (
  SELECT CASE WHEN user_id IS NULL AND {RUN_ID} = 'r3' THEN '  ' ELSE owner_id END AS owner_id, {INGESTED_AT}, {RUN_ID},
         CASE WHEN user_id IS NOT NULL OR {RUN_ID} <> 'r2' THEN {SOURCE_SYSTEM} END AS {SOURCE_SYSTEM},
         CASE WHEN user_id IS NULL AND {RUN_ID} = 'r1' THEN '' ELSE email END AS raw_json
  FROM (SELECT * FROM own UNION ALL SELECT * FROM own WHERE {RUN_ID} = 'r1' AND teams_json = '[{{"id":"n1"}}]'))"""


def _blanks_sql(columns) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {_blank_sql(c)}) AS {c}" for c in columns)


@register("audit_scd2_faults", _with(*H3, FAULTY_DEALS) + f"""
SELECT count(*) AS current_rows, (SELECT count(*) FROM (SELECT {KEY} FROM f3 GROUP BY {KEY} HAVING count(*) > 1)) AS bad_keys,
       {_blanks_sql(SCD2_REQUIRED)} FROM f3""")
def q_audit_scd2_faults(spark, sf):
    """V13 where there is something to find."""
    return audits.audit_report(faulty_deal_history(spark, sf), DEALS)


@register("audit_append_faults", OWNERS_SQL + f""", {FAULTY_OWNERS.strip()}
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT owner_id, {RUN_ID} FROM fo)) AS distinct_keys,
       {_blanks_sql(OWNER_REQUIRED)} FROM fo""")
def q_audit_append_faults(spark, sf):
    """V12 where there is something to find."""
    return audits.audit_report(faulty_owner_history(spark, sf), OWNERS)


def _dq_sql(name: str, table: str, required, keys: str) -> str:
    bad = " + ".join(f"count(*) FILTER (WHERE {_blank_sql(c)})" for c in required)
    cells = f"({len(required)} * count(*))"
    return f"""
SELECT '{name}' AS table_name, count(*) AS rows, round(100.0::DOUBLE * ({cells} - ({bad})) / {cells}, 4) AS completeness_pct,
       round(100.0::DOUBLE * (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table})) / count(*), 4) AS uniqueness_pct FROM {table}"""


@register("dq_metrics_faults", _with(*H3, FAULTY_DEALS, OWNERS_SQL.strip()[5:], FAULTY_OWNERS)
          + _dq_sql("deals", "f3", SCD2_REQUIRED, KEY) + " UNION ALL " + _dq_sql("owners", "fo", OWNER_REQUIRED, f"owner_id, {RUN_ID}"))
def q_dq_metrics_faults(spark, sf):
    """G8 under 100 %."""
    return audits.dq_metrics(faulty_deal_history(spark, sf), DEALS).unionByName(audits.dq_metrics(faulty_owner_history(spark, sf), OWNERS))


# ============================================================ 12. the stored run
STORED = ("deals", "owners", "deal_pipeline_stages", "deal_company_associations")


def stored_runs(spark, sf, *, sample_limit: int | None = None) -> tuple[Store, list[RunResult]]:
    """Runs "r1" and "r2" staged, gated, merged, written, audited and committed
    into a store of their own in the shared folder; the second one sampled if
    there is a limit."""
    store = Store(spark, f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}", {n: C.CONTRACTS[n] for n in STORED})
    store.bootstrap()
    done = []
    for run, limit in (("r1", None), ("r2", sample_limit)):
        inputs = RunInputs(entities={"deals": C.order_docs(spark, sf, run)}, owners=C.supplier_docs(spark, sf, run),
                           pipelines=C.part_pipeline_docs(spark, sf), associations={"deal_company_associations": C.unique_assoc_docs(spark, sf)})
        done.append(ingest_run(store, inputs, run_id=run, ingested_at=C.RUNS[run], source_system=C.SOURCE, sample_limit=limit))
    return store, done


def _lines_sql(where: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) IN (SELECT {KEY} FROM {where})))"


@register("stored_history", _with(*H2) + f"SELECT {SCD2_SEL} FROM h2")
def q_stored_history(spark, sf):
    """R1, K3, K4: the history of two stored runs, read back."""
    return stored_runs(spark, sf)[0].read("deals").select(*SCD2_OUT)


@register("stored_run_changes", _with(*H2, OWNERS_SQL.strip()[5:]) + f""", n AS (
  SELECT 'deals' AS table_name, 'r1' AS run, (SELECT count(*) FROM r1) AS staged, (SELECT count(*) FROM r1) AS opened, 0 AS closed, (SELECT count(*) FROM r1) AS counted
  UNION ALL SELECT 'deals', 'r2', (SELECT count(*) FROM r2), (SELECT count(*) FROM h2 WHERE {IS_CURRENT} AND {RUN_ID} = 'r2'),
    (SELECT count(*) FROM h2 WHERE NOT {IS_CURRENT}), (SELECT count(*) FROM h2 WHERE {IS_CURRENT})
  UNION ALL SELECT 'owners', {RUN_ID}, count(*), count(*), 0, (SELECT count(*) FROM own x WHERE x.{RUN_ID} <= own.{RUN_ID}) FROM own WHERE {RUN_ID} <> 'r3' GROUP BY {RUN_ID}
  UNION ALL SELECT 'deal_pipeline_stages', run, count(*), count(*), 0, CASE run WHEN 'r1' THEN 1 ELSE 2 END * count(*) FROM part, (VALUES ('r1'), ('r2')) v(run) GROUP BY run
  UNION ALL SELECT 'deal_company_associations', 'r1', {_lines_sql('r1')}, {_lines_sql('r1')}, 0, {_lines_sql('r1')}
  UNION ALL SELECT 'deal_company_associations', 'r2', {_lines_sql('r2')}, {_lines_sql('r2')}, 0, {_lines_sql('r1')} + {_lines_sql('r2')})
SELECT table_name, run AS run_id, staged::BIGINT AS staged, opened::BIGINT AS opened, closed::BIGINT AS closed, counted::BIGINT AS counted FROM n""")
def q_stored_run_changes(spark, sf):
    """R1, A6, D5: what the writes of two stored runs observed."""
    rows = [(n, r.run_id, *r.changes[n], r.counts[n]) for r in stored_runs(spark, sf)[1] for n in r.changes]
    return spark.createDataFrame(rows, "table_name string, run_id string, staged long, opened long, closed long, counted long")


@register("sampled_run_audit", _with(
    ORDERS_BASE, _order_run_sql("r1"), _order_run_sql("r2", name="r2all"), f"r2 AS (SELECT * FROM r2all ORDER BY {KEY} LIMIT 25)",
    _seed_sql("h1", "r1"), _merge_sql("h2", "h1", "r2", close_missing=False), OWNERS_SQL.strip()[5:]) + f"""
SELECT 'deals' AS table_name, count(*) AS counted FROM h2 WHERE {IS_CURRENT}
UNION ALL SELECT 'owners', least(25, count(*)) FROM own WHERE {RUN_ID} = 'r2'
UNION ALL SELECT 'deal_pipeline_stages', count(*) FROM part
UNION ALL SELECT 'deal_company_associations', {_lines_sql('r2')}""")
def q_sampled_run_audit(spark, sf):
    """V14: a full run, a sampled run, and the audit of the latter."""
    store, _ = stored_runs(spark, sf, sample_limit=25)
    counts = audit_run(store, "r2", sample_limit=25)
    return spark.createDataFrame(list(counts.items()), "table_name string, counted long")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
