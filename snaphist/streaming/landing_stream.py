"""Incremental ingest of landed runs with Structured Streaming.

Landing layout (one directory per run, page envelopes as JSON lines)::

    <landing>/<run_id>/entities/<table>/*.jsonl
    <landing>/<run_id>/owners/*.jsonl
    <landing>/<run_id>/pipelines/*.jsonl
    <landing>/<run_id>/associations/<table>/*.jsonl
    <landing>/_runs/<run_id>.json        {"run_id", "ingested_at"} written last

The stream watches ``_runs`` (a file source: new markers only, tracked in the
query checkpoint); every micro-batch ingests its runs in ingest-time order
through ``ingest_run``. With ``available_now`` the query drains what has
landed and stops, which is how a scheduled job runs it. A replayed batch
after a failure is idempotent: a run is committed as a whole, and one that is
committed is skipped.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.landing import envelope_results, read_landing
from ..sources.store import Store
from ..plans.ingest import ingest_run
from ..plans.pipeline import RunInputs

MARKERS = "_runs"
MARKER_SCHEMA = "run_id string, ingested_at timestamp"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _subdirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def landed_inputs(spark: SparkSession, landing: str, run_id: str) -> RunInputs:
    """The documents of one landed run (absent kinds are simply not set)."""
    base = f"{landing.rstrip('/')}/{run_id}"

    inputs = RunInputs()

    def objs(path: str) -> DataFrame:
        inputs.pages[path.removeprefix(f"{base}/")] = pages = read_landing(spark, path)
        return envelope_results(pages)

    for t in _subdirs(spark, f"{base}/entities"):
        inputs.entities[t] = objs(f"{base}/entities/{t}")
    if _exists(spark, f"{base}/owners"):
        inputs.owners = objs(f"{base}/owners")
    if _exists(spark, f"{base}/pipelines"):
        inputs.pipelines = objs(f"{base}/pipelines")
    for t in _subdirs(spark, f"{base}/associations"):
        inputs.associations[t] = objs(f"{base}/associations/{t}")
    return inputs


def land_run(spark: SparkSession, inputs: RunInputs, landing: str, *, run_id: str,
             ingested_at: datetime | str) -> None:
    """Write a run's documents to the landing layout (one envelope per line)
    and, last, its marker. Used by extract jobs and tests."""
    base = f"{landing.rstrip('/')}/{run_id}"

    def put(docs: DataFrame, path: str) -> None:
        env = F.concat(F.lit('{"results":['), F.col("doc"), F.lit("]}"))
        docs.select(env.alias("value")).write.mode("overwrite").text(path)

    for t, d in inputs.entities.items():
        put(d, f"{base}/entities/{t}")
    if inputs.owners is not None:
        put(inputs.owners, f"{base}/owners")
    if inputs.pipelines is not None:
        put(inputs.pipelines, f"{base}/pipelines")
    for t, d in inputs.associations.items():
        put(d, f"{base}/associations/{t}")
    marker = json.dumps({"run_id": run_id, "ingested_at": str(ingested_at)})
    spark.createDataFrame([(marker,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{landing.rstrip('/')}/{MARKERS}/{run_id}")


def start_ingest_stream(spark: SparkSession, store: Store, landing: str, *, source_system: str,
                        checkpoint_location: str, available_now: bool = True,
                        sample_limit: int | None = None) -> StreamingQuery:
    """Start the stream. ``checkpoint_location`` holds the query's progress: a
    folder that outlives the driver's machine."""
    markers = (spark.readStream.schema(MARKER_SCHEMA).option("recursiveFileLookup", "true")
               .json(f"{landing.rstrip('/')}/{MARKERS}"))

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # one row per landed run: run metadata, not data
        for r in batch.orderBy("ingested_at", "run_id").collect():
            ingest_run(store, landed_inputs(spark, landing, r["run_id"]), run_id=r["run_id"],
                       ingested_at=r["ingested_at"], source_system=source_system,
                       sample_limit=sample_limit, skip_committed=True)

    w = markers.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
