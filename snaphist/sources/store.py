"""Tables as plain Parquet, one partition per run.

Layout under ``root``::

    <table>/_published_run=<run>/_is_current=<bool>/part-*.parquet   SCD2 tables
    <table>/_published_run=<run>/part-*.parquet                      append tables
    _stg_<table>/<run>/part-*.parquet                                staged rows of a run
    _runs/part-*.parquet                                             the run log

A run writes each of its partitions with one overwrite, so a retry replaces
what a failed attempt left. When all tables are written and audited, one
append to the run log publishes them together; readers take the partitions of
logged runs only. Runs of one store are ingested one after the other (the
scheduler's concern); a run that finds a newer one in the log is refused.

SCD2 tables keep closed versions append-only: a merge reads only the open rows
of the last run (partition-pruned) and writes the new open set plus the
versions it closed, so its work follows the open rows and the extract, not the
history. ``rewrite_closed`` gathers the closed versions of all runs in one
partition that is sorted for lookups by key.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import INGESTED_AT, IS_CURRENT, SCD2, STAGING, VALID_FROM, TableContract, schema_mismatches, staging_name, ts_literal, utc
from .footers import file_schema_faults

PUBLISHED_RUN = "_published_run"
RUN_LOG = "_runs"
LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("run_id", T.StringType()),       # value of _published_run
    T.StructField("seq", T.LongType()),            # position of the run; rewrite: the last run it holds
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("rows", T.LongType()),           # written, or (negative) purged
    T.StructField("kind", T.StringType()),
    T.StructField("sample_limit", T.LongType()),   # the run kept that many objects and closed nothing as missing
])
RUN, REWRITE, PURGE = "run", "rewrite", "purge"
RUN_NAME = re.compile(r"[A-Za-z0-9._-]+")  # run ids name folders


class Run(NamedTuple):
    run_id: str
    seq: int
    ingested_at: datetime
    rows: int
    sample_limit: int | None = None


class TableLog(NamedTuple):
    """What the run log says of one table, oldest first."""
    runs: list[Run]
    rewrites: list[Run]
    total: int


class RunConflict(RuntimeError):
    """A run id that is committed, or a run that started from an older state."""


@dataclass
class Store:
    """``database`` + ``buckets`` (optional, needs a catalog that outlives the
    session on a cluster): SCD2 tables become catalog tables partitioned like
    the path layout and bucketed by the business key, so the next run's merge
    reads the open set as a bucketed scan and only the extract is shuffled."""
    spark: SparkSession
    root: str
    contracts: dict[str, TableContract]
    database: str | None = None
    buckets: int | None = None
    verified: set[tuple[str, str]] = field(default_factory=set, repr=False)

    def _bucketed(self, name: str) -> bool:
        return bool(self.database and self.buckets) and self.contracts[name].pattern == SCD2

    def table_name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def path(self, name: str, *inner: str) -> str:
        return "/".join([self.root.rstrip("/"), name, *inner])

    def part_path(self, name: str, run_id: str) -> str:
        return self.path(name, f"{PUBLISHED_RUN}={run_id}")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    # ------------------------------------------------------------ run log
    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(self.path(RUN_LOG))
        except AnalysisException:  # no run yet
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def tables(self) -> dict[str, TableLog]:
        """The log by table: a row per table and run, read once per run."""
        out = {n: ([], [], []) for n in self.contracts}
        for r in self.log().orderBy("seq").collect():
            runs, rewrites, rows = out.setdefault(r["table_name"], ([], [], []))
            one = Run(r["run_id"], r["seq"], r["ingested_at"], r["rows"], r["sample_limit"])
            if r["kind"] != PURGE:
                (runs if r["kind"] == RUN else rewrites).append(one)
            if r["kind"] != REWRITE:
                rows.append(r["rows"])
        return {n: TableLog(runs, rewrites, sum(rows)) for n, (runs, rewrites, rows) in out.items()}

    def runs(self, name: str) -> list[Run]:
        return self.tables()[name].runs

    def committed(self, name: str) -> list[tuple[str, int]]:
        """``(run_id, seq)`` of the committed runs of a table, oldest first."""
        return [(r.run_id, r.seq) for r in self.runs(name)]

    def last_seq(self) -> int:
        return self.log().agg(F.max("seq")).first()[0] or 0

    def _append_log(self, rows: list[tuple], kind: str) -> None:
        data = [(n, r.run_id, r.seq, r.ingested_at, r.rows, kind, r.sample_limit) for n, r in rows]
        self.spark.createDataFrame(data, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path(RUN_LOG))

    def commit(self, rows: Iterable[tuple[str, Run]]) -> None:
        """Publish a run's partitions of all tables together."""
        rows = [(n, r._replace(ingested_at=utc(r.ingested_at))) for n, r in rows]
        if self.last_seq() != rows[0][1].seq - 1:
            raise RunConflict(f"run {rows[0][1].run_id} started from an older state: another run was committed meanwhile")
        self._append_log(rows, RUN)

    # ------------------------------------------------------------ bootstrap / existence
    def bootstrap(self, database: str | None = None) -> list[str]:
        """Create the table directories (and, with ``database``, external
        catalog tables over them) in contract order; existing ones are kept.
        In bucketed mode the SCD2 tables are created bucketed by key."""
        database = database or self.database
        if database is not None:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.path('_catalog')}'")
        created = []
        for name, c in self.contracts.items():
            if c.pattern == STAGING:
                continue
            path = self.path(name)
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.stored_schema(c).fields)
            parts = ", ".join(self.partition_columns(c))
            if self._bucketed(name):
                if not self.spark.catalog.tableExists(self.table_name(name)):
                    key = c.business_keys[0]
                    self.spark.sql(
                        f"CREATE TABLE {self.table_name(name)} ({cols}) USING parquet PARTITIONED BY ({parts}) "
                        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {self.buckets} BUCKETS "
                        f"LOCATION '{path}'")
                    created.append(name)
                continue
            if not self._exists(path):
                self.spark.createDataFrame([], self.stored_schema(c)).write.mode("overwrite") \
                    .partitionBy(*self.partition_columns(c)).parquet(path)
                created.append(name)
            if database is not None:
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name}_store ({cols}) USING parquet "
                               f"PARTITIONED BY ({parts}) LOCATION '{path}'")
        return created

    def missing_tables(self) -> list[str]:
        return [n for n, c in self.contracts.items() if c.pattern != STAGING and not (
            self.spark.catalog.tableExists(self.table_name(n)) if self._bucketed(n) else self._exists(self.path(n)))]

    def assert_tables_exist(self) -> None:
        missing = self.missing_tables()
        if missing:
            raise RuntimeError(f"[store/not-bootstrapped] {len(missing)} of the contract's tables do not exist: {', '.join(missing)}")

    # ------------------------------------------------------------ schemas
    @staticmethod
    def partition_columns(c: TableContract) -> list[str]:
        return [PUBLISHED_RUN, IS_CURRENT] if c.pattern == SCD2 else [PUBLISHED_RUN]

    @staticmethod
    def file_schema(c: TableContract) -> T.StructType:
        """What a data file holds: the contract without its partition column."""
        return T.StructType([f for f in c.schema.fields if c.pattern != SCD2 or f.name != IS_CURRENT])

    @classmethod
    def stored_schema(cls, c: TableContract) -> T.StructType:
        flag = [T.StructField(IS_CURRENT, T.BooleanType())] if c.pattern == SCD2 else []
        return T.StructType([*cls.file_schema(c).fields, T.StructField(PUBLISHED_RUN, T.StringType()), *flag])

    def schema_faults(self, name: str, run_ids: Iterable[str]) -> DataFrame:
        """Files of the named partitions whose own schema is not the contract's."""
        paths = [p for p in (self.part_path(name, r) for r in run_ids) if self._exists(p)]
        c = self.contracts[name]
        if not paths:
            return self.spark.createDataFrame([], "file string, fault string, field string, found string, wanted string")
        return file_schema_faults(self.spark, paths, self.file_schema(c))

    def _verify(self, name: str, run_ids: Iterable[str]) -> None:
        """Refuses drifted files; a partition is checked once by a store."""
        new = [r for r in run_ids if (name, r) not in self.verified]
        found = self.schema_faults(name, new).limit(10).collect() if new else []
        if found:
            shown = "".join(f"\n  {r['fault']} {r['field']}: {r['found']}, contract {r['wanted']} ({r['file']})" for r in found)
            raise ValueError(f"[store/schema-drift] {name}: stored files are not as the contract says:{shown}")
        self.verified |= {(name, r) for r in new}

    # ------------------------------------------------------------ reads
    def _of(self, name: str, run_ids: list[str], condition=None) -> DataFrame:
        """Rows of the named partitions; their files' schemas are checked first."""
        c = self.contracts[name]
        if not run_ids:  # known to be empty: a merge into nothing then needs no join
            return self.spark.createDataFrame([], c.schema).where(F.lit(False))
        self._verify(name, run_ids)
        raw = self.spark.table(self.table_name(name)) if self._bucketed(name) else self.spark.read.schema(self.stored_schema(c)).parquet(self.path(name))
        rows = raw.where(F.col(PUBLISHED_RUN).isin(run_ids))
        return (rows if condition is None else rows.where(condition)).select(*c.columns)

    def _closed_parts(self, name: str, log: TableLog) -> list[str]:
        """The partitions of the closed history: the last rewrite, and the
        runs since."""
        upto = log.rewrites[-1].seq if log.rewrites else 0
        return [r.run_id for r in log.rewrites[-1:]] + [r.run_id for r in log.runs if r.seq > upto]

    def read(self, name: str, *, pending: str | None = None) -> DataFrame:
        """The table in contract column order, committed runs only (plus the
        written-but-uncommitted run ``pending`` when auditing it)."""
        log = self.tables()[name]
        extra = [pending] if pending else []
        if self.contracts[name].pattern != SCD2:
            return self._of(name, [r.run_id for r in log.runs] + extra)
        latest = [pending] if pending else [r.run_id for r in log.runs[-1:]]
        closed = self._of(name, self._closed_parts(name, log) + extra, ~F.col(IS_CURRENT))
        return closed.unionByName(self._of(name, latest, F.col(IS_CURRENT)))

    def read_run(self, name: str, run_id: str) -> DataFrame:
        """What one committed run wrote; only its partition is read."""
        return self._of(name, [r.run_id for r in self.runs(name) if r.run_id == run_id])

    def latest_run(self, name: str) -> DataFrame:
        """Rows of the table's last committed run: the log names it, so the
        history is not searched for it."""
        return self._of(name, [r.run_id for r in self.runs(name)[-1:]])

    def read_open(self, name: str) -> DataFrame:
        """Open SCD2 rows of the last committed run (two partition filters)."""
        return self._of(name, [r.run_id for r in self.runs(name)[-1:]], F.col(IS_CURRENT))

    def written(self, name: str, run_id: str) -> DataFrame:
        """Rows of one partition (for audits before commit)."""
        return self._of(name, [run_id])

    def register_views(self, names: list[str] | None = None, *, global_views: bool = False) -> list[str]:
        """(Re)point one SQL view per table at its committed runs, so
        consumers run plain SQL such as ``SELECT * FROM deals WHERE
        _is_current = true``. Call again after a commit to repoint."""
        names = names or [n for n, c in self.contracts.items() if c.pattern != STAGING]
        for n in names:
            df = self.read(n)
            (df.createOrReplaceGlobalTempView(n) if global_views else df.createOrReplaceTempView(n))
        return names

    # ------------------------------------------------------------ writes
    def load_staging(self, name: str, rows: DataFrame, run_id: str) -> DataFrame:
        """Load a run's staging rows (K3) and return them read back: gates,
        merge and write then scan Parquet instead of parsing the landed JSON
        again, and the lineage is cut at the write."""
        c = self.contracts[name]
        path = self.path(staging_name(name), run_id)
        rows.select(*c.columns).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(c.schema).parquet(path)

    def clear_staging(self, run_id: str) -> None:
        """Remove the run's staging folders."""
        for name in self.contracts:
            self._delete(self.path(staging_name(name), run_id))

    def write_run(self, name: str, rows: DataFrame, run_id: str) -> None:
        """Write a run's partition in place of what an earlier attempt left;
        not visible before the commit. Rows whose schema is not the
        contract's are refused."""
        c = self.contracts[name]
        problems = schema_mismatches(rows.schema, c)
        if problems:
            raise ValueError("[store/schema] " + "; ".join(problems))
        if not RUN_NAME.fullmatch(run_id):
            raise ValueError(f"[store/run-id] {run_id!r}: letters, digits, dots, dashes and underscores only")
        self.verified.discard((name, run_id))
        if self._bucketed(name):
            # by position into the bucketed table. The merge output is already
            # hash partitioned on the key with the bucket count, so each task
            # writes one bucket file per partition (no extra shuffle).
            self._drop(name, run_id)
            out = rows.withColumn(PUBLISHED_RUN, F.lit(run_id))
            out.select(*self.stored_schema(c).fieldNames()).write.insertInto(self.table_name(name), overwrite=False)
            return
        flag = [IS_CURRENT] if c.pattern == SCD2 else []
        self._lookups(rows, c).partitionBy(*flag).parquet(self.part_path(name, run_id))

    @staticmethod
    def _lookups(rows: DataFrame, c: TableContract):
        """An overwrite whose files are sorted by key and carry a Bloom filter
        of it, so that reads of one key skip most files and pages."""
        key = c.business_keys[0]
        return rows.sortWithinPartitions(key).write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .option(f"parquet.bloom.filter.enabled#{key}", "true")  # static: the run's whole partition, also flags it no longer has

    # ------------------------------------------------------------ maintenance
    def _delete(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [path] if fs.exists(p) and fs.delete(p, True) else []

    def _drop(self, name: str, run_id: str, current: bool | None = None) -> list[str]:
        if self._bucketed(name):
            spec = f"{PUBLISHED_RUN}='{run_id}'" + ("" if current is None else f", {IS_CURRENT}={str(current).lower()}")
            self.spark.sql(f"ALTER TABLE {self.table_name(name)} DROP IF EXISTS PARTITION ({spec})")
        flag = "" if current is None else f"/{IS_CURRENT}={str(current).lower()}"
        return self._delete(self.part_path(name, run_id) + flag)

    def rewrite_closed(self, name: str, *, partitions: int | None = None) -> str | None:
        """One ordinary job: the closed versions of all runs so far, in ranges
        of the key, sorted by key and start, as one partition that readers use
        from then on (``vacuum`` removes the old ones). A point read then
        opens the files whose range and Bloom filter allow the key, an as-of
        read those whose validity range overlaps. Returns its name, or None if
        nothing was committed since the last one."""
        c = self.contracts[name]
        log = self.tables()[name]
        if c.pattern != SCD2 or not log.runs or (log.rewrites and log.rewrites[-1].seq == log.runs[-1].seq):
            return None
        last = log.runs[-1]
        part = f"closed-{last.seq}"
        key = [*c.business_keys, VALID_FROM]
        closed = self._of(name, self._closed_parts(name, log), ~F.col(IS_CURRENT))
        if self._bucketed(name):
            self.write_run(name, closed, part)
        else:
            ranges = closed.repartitionByRange(partitions, *key) if partitions else closed.repartitionByRange(*key)
            self._lookups(ranges.sortWithinPartitions(*key), c).partitionBy(IS_CURRENT).parquet(self.part_path(name, part))
        self._append_log([(name, Run(part, last.seq, last.ingested_at, self.written(name, part).count()))], REWRITE)
        return part

    def vacuum(self, name: str, *, keep: int = 2) -> list[str]:
        """Delete what no reader uses: open rows of all but the last ``keep``
        runs, and closed partitions that a rewrite replaced. Storage then
        holds the history and ``keep`` open sets. Returns the deleted paths."""
        if keep < 1:
            raise ValueError("keep must be at least 1: the last run's open rows are the live ones")
        if self.contracts[name].pattern != SCD2:
            return []
        log = self.tables()[name]
        gone = [p for r in log.runs[:-keep] for p in self._drop(name, r.run_id, True)]
        live = self._closed_parts(name, log)
        return gone + [p for r in [*log.runs, *log.rewrites] if r.run_id not in live for p in self._drop(name, r.run_id, False)]

    def purge(self, name: str, now: datetime | str, *, days: int = 90) -> DataFrame:
        """Retention as a job: rows ingested more than ``days`` days before
        ``now`` go, open versions stay. Affected partitions are written anew
        without them (dynamic partition overwrite), emptied ones are dropped;
        the others are not touched. Returns ``part, kept, dropped``."""
        c = self.contracts[name]
        log = self.tables()[name]
        scd2 = c.pattern == SCD2
        parts = self._closed_parts(name, log) if scd2 else [r.run_id for r in log.runs]
        keep = F.col(INGESTED_AT) >= ts_literal(now) - F.make_interval(days=F.lit(days))
        self._verify(name, parts)
        raw = self.spark.table(self.table_name(name)) if self._bucketed(name) else self.spark.read.schema(self.stored_schema(c)).parquet(self.path(name))
        rows = raw.where(F.col(PUBLISHED_RUN).isin(parts)).where(~F.col(IS_CURRENT) if scd2 else F.lit(True))
        counted = rows.groupBy(F.col(PUBLISHED_RUN).alias("part")).agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped")).collect()  # a row per run
        touched = [r["part"] for r in counted if r["dropped"] and r["kept"]]
        if touched:
            left = rows.where(F.col(PUBLISHED_RUN).isin(touched)).where(keep).select(*self.stored_schema(c).fieldNames())
            if self._bucketed(name):
                left.write.insertInto(self.table_name(name), overwrite=True)
            else:
                left.sortWithinPartitions(*self.partition_columns(c), c.business_keys[0]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                    .option(f"parquet.bloom.filter.enabled#{c.business_keys[0]}", "true").partitionBy(*self.partition_columns(c)).parquet(self.path(name))
        for r in counted:
            if r["dropped"] and not r["kept"]:
                self._drop(name, r["part"], False if scd2 else None)
        known = {r.run_id: r for r in [*log.runs, *log.rewrites]}
        gone = [(name, known[r["part"]]._replace(rows=-r["dropped"])) for r in counted if r["dropped"]]
        if gone:
            self._append_log(gone, PURGE)
        return self.spark.createDataFrame([(r["part"], r["kept"], r["dropped"]) for r in counted], "part string, kept long, dropped long")
