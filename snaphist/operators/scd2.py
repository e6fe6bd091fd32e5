"""SCD Type 2 merge, change summary and replay as DataFrame plans.

Semantics of one merge of a staging snapshot ``s`` into a target ``t``:

1. close changed: an open ``t`` row with a staging row of the same key whose
   change signature differs gets ``_valid_to`` = max staging ``_valid_from``
   of that key and ``_is_current`` = false;
2. close missing (full extracts only): an open ``t`` row with no staging row
   gets ``_valid_to`` = max ``_valid_from`` over all staging (NULL when the
   extract is empty) and ``_is_current`` = false;
3. insert every staging row whose key has no open row left.

Two plans compute it:

* ``general``: exact for any input, including duplicated staging keys and
  targets with several open rows per key. Staging is pre-aggregated per key
  (partial aggregation before the shuffle), then left-joined to the target.
* ``split``: needs unique staging keys and at most one open row per key (the
  gates and audits enforce both). Closed history bypasses the join; only open
  rows meet staging in one full outer join (one shuffle per side), and each
  joined pair emits its one or two output rows.
* ``union``: exact for any input, like ``general``. Open rows and staging are
  tagged, united and partitioned by key once; two windows over the same
  partitioning say which open rows close and which keys keep one. A doubled
  key is a partition that streams (and spills), never a product of its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import IS_CURRENT, VALID_FROM, VALID_TO, TableContract
from ..functions.predicates import change_signature

GENERAL = "general"
SPLIT = "split"
UNION = "union"


def _sig(contract: TableContract, prefix: str = "") -> Column:
    return change_signature([F.col(f"{prefix}{a}") for a in contract.change_attrs])


def _staging_max_from(staging: DataFrame) -> Column:
    """``(SELECT MAX(_valid_from) FROM staging)`` as an uncorrelated scalar
    subquery: computed once, no join."""
    return staging.agg(F.max(VALID_FROM)).scalar()


def merge_general(target: DataFrame, staging: DataFrame, contract: TableContract,
                  *, close_missing: bool = True) -> DataFrame:
    keys = list(contract.business_keys)
    cols = contract.columns
    is_open = F.coalesce(F.col(IS_CURRENT), F.lit(False))
    history = target.where(~is_open).select(*cols)          # never shuffled
    # partial aggregation first: a hot (duplicated) staging key is collapsed
    # map-side before the shuffle
    per_key = staging.groupBy(*keys).agg(
        F.max(VALID_FROM).alias("__mx"),
        F.min(_sig(contract)).alias("__lo"),
        F.max(_sig(contract)).alias("__hi"),
    )
    j = target.where(is_open).join(per_key, keys, "left")
    sig = _sig(contract)
    matched = F.col("__lo").isNotNull()
    changed = matched & ((sig != F.col("__lo")) | (sig != F.col("__hi")))
    missing = ~matched & F.lit(close_missing)
    closed = j.select(*[
        (F.when(changed, F.col("__mx")).when(missing, _staging_max_from(staging)).otherwise(F.col(VALID_TO))
         if c == VALID_TO else
         (~(changed | missing)) if c == IS_CURRENT else F.col(c)).alias(c)
        for c in cols])
    # keys whose open row survives: derived from the same key-partitioned join
    # output, so no further exchange; inserts are staging rows of other keys
    # (wrapped in coalesce so the optimizer keeps it a residual condition:
    # lifted into join keys as sig = __lo it would repartition on the
    # signature and lose the reuse of the exchanges above)
    blocked = j.where(F.coalesce(matched & ~changed, F.lit(False))).select(*keys).distinct()
    inserts = staging.join(blocked, keys, "left_anti").select(*cols)
    return history.unionByName(closed).unionByName(inserts)


def _merge_split_open(open_t: DataFrame, staging: DataFrame, contract: TableContract,
                      *, close_missing: bool) -> DataFrame:
    """Rows produced from the open target rows and staging (new open set plus
    the rows closed by this merge)."""
    keys = list(contract.business_keys)
    cols = contract.columns
    t = open_t.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                      F.struct(*cols).alias("t"))
    s = staging.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                       F.struct(*cols).alias("s"))
    on = [f"__k{i}" for i in range(len(keys))]
    j = t.join(s, on, "full_outer")
    t_present, s_present = F.col("t").isNotNull(), F.col("s").isNotNull()
    differs = _sig(contract, "t.") != _sig(contract, "s.")
    close = t_present & ((s_present & differs) | (~s_present & F.lit(close_missing)))
    closed_t = F.col("t").withField(
        VALID_TO, F.when(s_present, F.col(f"s.{VALID_FROM}")).otherwise(_staging_max_from(staging))
    ).withField(IS_CURRENT, F.lit(False))
    emitted = F.array(
        F.when(close, closed_t).when(t_present, F.col("t")),
        F.when(s_present & (~t_present | differs), F.col("s")),
    )
    return (j.select(F.explode(emitted).alias("r")).where(F.col("r").isNotNull())
            .select(*[F.col(f"r.{c}").alias(c) for c in cols]))


def merge_split(target: DataFrame, staging: DataFrame, contract: TableContract,
                *, close_missing: bool = True) -> DataFrame:
    is_open = F.coalesce(F.col(IS_CURRENT), F.lit(False))
    history = target.where(~is_open).select(*contract.columns)
    touched = _merge_split_open(target.where(is_open), staging, contract, close_missing=close_missing)
    return history.unionByName(touched)


def merge_union(target: DataFrame, staging: DataFrame, contract: TableContract,
                *, close_missing: bool = True) -> DataFrame:
    cols = contract.columns
    is_open = F.coalesce(F.col(IS_CURRENT), F.lit(False))
    history = target.where(~is_open).select(*cols)          # never shuffled
    new, sig = F.col("__new"), F.col("__sig")
    both = target.where(is_open).select(*cols, F.lit(False).alias("__new")) \
        .unionByName(staging.select(*cols, F.lit(True).alias("__new"))).withColumn("__sig", _sig(contract))
    key = Window.partitionBy(*contract.business_keys)
    whole_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in contract.business_keys])  # a NULL key matches nothing
    staged = lambda c: F.when(new & whole_key, c)
    both = both.select("*", F.max(staged(F.col(VALID_FROM))).over(key).alias("__mx"), F.min(staged(sig)).over(key).alias("__lo"),
                       F.max(staged(sig)).over(key).alias("__hi"))
    matched = whole_key & F.col("__lo").isNotNull()
    changed = ~new & matched & ((sig != F.col("__lo")) | (sig != F.col("__hi")))
    missing = ~new & ~matched & F.lit(close_missing)
    both = both.select("*", changed.alias("__changed"), missing.alias("__missing"),
                       F.max(~new & matched & ~changed).over(key).alias("__kept"))
    touched = both.where(~new | ~F.col("__kept")).select(*[
        (F.when(F.col("__changed"), F.col("__mx")).when(F.col("__missing"), _staging_max_from(staging)).otherwise(F.col(VALID_TO))
         if c == VALID_TO else
         F.col(IS_CURRENT) & ~F.col("__changed") & ~F.col("__missing") if c == IS_CURRENT else F.col(c)).alias(c)
        for c in cols])
    return history.unionByName(touched)


def scd2_merge(target: DataFrame, staging: DataFrame, contract: TableContract,
               *, close_missing: bool = True, form: str = GENERAL) -> DataFrame:
    """New complete state of the SCD2 table after merging ``staging``."""
    if form == GENERAL:
        return merge_general(target, staging, contract, close_missing=close_missing)
    if form == SPLIT:
        return merge_split(target, staging, contract, close_missing=close_missing)
    if form == UNION:
        return merge_union(target, staging, contract, close_missing=close_missing)
    raise ValueError(f"unknown merge form {form!r}")


def scd2_merge_open(open_target: DataFrame, staging: DataFrame, contract: TableContract,
                    *, close_missing: bool = True) -> DataFrame:
    """Split form over the open rows only: returns the new open rows plus the
    rows this merge closed. Closed history is never read (used by the store,
    which keeps closed history append-only)."""
    return _merge_split_open(open_target, staging, contract, close_missing=close_missing)


def change_summary(target: DataFrame, staging: DataFrame, contract: TableContract,
                   *, close_missing: bool = True) -> DataFrame:
    """What a merge will do, one row: ``staged, opened, inserted_new,
    closed_changed, closed_missing, unchanged`` (unique keys assumed, as for
    the split form)."""
    keys = list(contract.business_keys)
    t = target.where(F.col(IS_CURRENT)).select(*keys, _sig(contract).alias("ts"))
    s = staging.select(*keys, _sig(contract).alias("ss"))
    j = t.join(s, keys, "full_outer")
    tp, sp = F.col("ts").isNotNull(), F.col("ss").isNotNull()
    diff = tp & sp & (F.col("ts") != F.col("ss"))

    def cnt(c: Column) -> Column:
        return F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")

    return j.agg(
        cnt(sp).alias("staged"),
        cnt(sp & (~tp | diff)).alias("opened"),
        cnt(sp & ~tp).alias("inserted_new"),
        cnt(diff).alias("closed_changed"),
        cnt(tp & ~sp & F.lit(close_missing)).alias("closed_missing"),
        cnt(tp & sp & ~diff).alias("unchanged"),
    )


def run_ends(runs: DataFrame, nonempty: DataFrame, *, on: str = "run_seq") -> DataFrame:
    """``runs`` (``run_seq``, ``_valid_from``, one row per run; ``sampled`` if
    some kept a sample only) with what a replay needs to know of its
    neighbours: ``prev_full`` and ``next_full``, the nearest full runs (only
    those can see a key as absent), and ``run_end``, the clock of the next full
    run, or NULL if its extract was empty (as the merge of an empty extract
    leaves it). ``nonempty``: the ``on`` values of the runs that have rows.
    Ranks the run list only."""
    seen = nonempty.select(on).distinct().withColumn("__seen", F.lit(True))
    full = ~F.coalesce(F.col("sampled"), F.lit(False)) if "sampled" in runs.columns else F.lit(True)
    clock = F.when(full, F.struct(F.col("run_seq").alias("seq"), F.when(F.col("__seen"), F.col(VALID_FROM)).alias("at")))
    order = Window.orderBy("run_seq")
    before = F.max(F.when(full, F.col("run_seq"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(clock, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    return runs.join(seen, on, "left").withColumns({"prev_full": before, "__after": after}) \
        .withColumns({"next_full": F.col("__after.seq"), "run_end": F.col("__after.at")}).drop("__seen", "__after")


RUN_COLUMNS = ("run_seq", "prev_full", "next_full", "run_end")  # of a replayed row's run


def scd2_replay(snapshots: DataFrame, runs: DataFrame, contract: TableContract) -> DataFrame:
    """Rebuild SCD2 history from stored snapshots in one pass.

    ``snapshots``: staging-shaped rows of every run plus its ``RUN_COLUMNS``
    (see ``run_ends``); without ``prev_full`` and ``next_full`` every run is a
    full one. ``runs``: one row per run with its ``run_seq`` (1..N), including
    runs whose extract was empty.

    Gaps-and-islands per key ordered by run: a version starts when a full run
    since the key's last row did not have it, or its change signature differs;
    a sampled run that lacks a key says nothing. A version keeps its first
    row's payload. It ends with the first full run after its last row that
    lacks the key (``run_end``), or else with the key's next row, or stays
    open. Rows per key are bounded by the run count, so each window partition
    is small; a key that a run holds twice fails the job, as the gate would
    have failed the run.
    """
    keys = list(contract.business_keys)
    cols = contract.columns
    if "prev_full" not in snapshots.columns:
        last = runs.agg(F.max("run_seq")).scalar()
        after = F.col("run_seq") + 1
        snapshots = snapshots.withColumns({"prev_full": F.col("run_seq") - 1, "next_full": F.when(after <= last, after)})
    w = Window.partitionBy(*keys).orderBy("run_seq")
    before = F.lag("run_seq").over(w)
    twice = F.raise_error(F.lit("a run holds the same key twice")).cast("int")
    flagged = snapshots.withColumn("__sig", _sig(contract)).withColumns({
        "__new": F.when(before == F.col("run_seq"), twice)
                  .when(before.isNull() | (before < F.col("prev_full")) | (F.lag("__sig").over(w) != F.col("__sig")), 1).otherwise(0),
        "__follows": F.lead(F.struct("run_seq", VALID_FROM)).over(w),
    }).withColumn("__version", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    islands = flagged.groupBy(*keys, "__version").agg(
        F.min_by(F.struct(*[c for c in cols if c not in keys]), F.col("run_seq")).alias("first"),
        F.max(F.struct("run_seq", "next_full", "run_end", "__follows")).alias("last"),
    )
    follows, absent = F.col("last.__follows"), F.col("last.next_full")
    lost = absent.isNotNull() & (follows.isNull() | (absent < follows["run_seq"]))
    return islands.select(
        *[F.col(k) for k in keys],
        *[F.col(f"first.{c}").alias(c) for c in cols if c not in keys and c not in (VALID_TO, IS_CURRENT)],
        F.when(lost, F.col("last.run_end")).when(follows.isNotNull(), follows[VALID_FROM]).alias(VALID_TO),
        (~lost & follows.isNull()).alias(IS_CURRENT),
    ).select(*cols)


def scd2_splice(history: DataFrame, late: DataFrame, following: DataFrame, contract: TableContract, *, at: Column, next_at: Column,
                empty_runs: Column | None = None) -> DataFrame:
    """The history as if a run that arrived late had been merged in its place.

    ``late``: its staged rows (a full extract, unique keys; may be empty).
    ``at``: its clock. ``next_at``: the clock of the next run in order, a full
    one, and ``following`` that run's staged rows. ``empty_runs``: ascending
    array of the clocks of the merged runs whose extract was empty (such a
    merge leaves NULL as the end of what it closes, so it has to be looked up).

    Only versions that the late run can touch are shuffled: those that live
    between ``at`` and ``next_at``, and those that begin with the next run.
    What ended before or began after passes through. A key's versions, its late
    row and its next row meet in one aggregation by key; of each there is at
    most one."""
    keys, cols = list(contract.business_keys), contract.columns
    is_open = F.coalesce(F.col(IS_CURRENT), F.lit(False))
    empty_runs = F.array().cast("array<timestamp>") if empty_runs is None else empty_runs
    end = F.when(~is_open, F.coalesce(F.col(VALID_TO), F.get(F.filter(empty_runs, lambda t: t > F.col(VALID_FROM)), 0)))
    spans = (F.col(VALID_FROM) < at) & (end.isNull() | (end >= next_at))
    begins = F.col(VALID_FROM) == next_at
    near = F.coalesce(spans | begins, F.lit(False))

    def tagged(rows: DataFrame, tag: Column) -> DataFrame:
        return rows.select(*keys, tag.alias("tag"), F.struct(*cols, _sig(contract).alias("__sig"), end.alias("__end")).alias("r"))

    rows = tagged(history.where(near), F.when(begins, "begins").otherwise("spans")) \
        .unionByName(tagged(late, F.lit("late"))).unionByName(tagged(following, F.lit("next")))
    one = rows.groupBy(*keys).agg(*[F.max(F.when(F.col("tag") == t, F.col("r"))).alias(t) for t in ("spans", "begins", "late", "next")])
    old, begun, new, nxt = (F.col(t) for t in ("spans", "begins", "late", "next"))
    alike = lambda x, y: x.isNotNull() & y.isNotNull() & (x["__sig"] == y["__sig"])
    kept = alike(old, new)                                      # the late run changes nothing
    cut_off = old.isNotNull() & ~kept
    goes_on = old["__end"].isNull() | (old["__end"] > next_at)  # the next run had the old version as well
    joined = new.isNotNull() & ~kept & alike(new, nxt)          # the version that begins with the next run begins now
    ended = lambda v, to: v.withField(VALID_TO, to).withField(IS_CURRENT, F.lit(False))
    like = lambda v, other: v.withField(VALID_TO, other[VALID_TO]).withField(IS_CURRENT, other[IS_CURRENT])
    versions = F.array(
        F.when(kept, old).when(cut_off, ended(old, _staging_max_from(late))),
        F.when(joined, like(new, begun)).when(new.isNotNull() & ~kept, ended(new, _staging_max_from(following))),
        F.when(cut_off & goes_on, like(nxt, old)),
        F.when(~joined, begun),
    )
    touched = one.select(F.explode(versions).alias("v")).where(F.col("v").isNotNull())
    return history.where(~near).select(*cols).unionByName(touched.select(*[F.col(f"v.{c}").alias(c) for c in cols]))
