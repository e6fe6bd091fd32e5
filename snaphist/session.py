"""Session settings the library relies on, and the lineage-cut directory."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library assumes: UTC clocks, AQE with skew-join
# splitting and partition coalescing, dynamic partition overwrite (a run only
# ever replaces its own partitions), no UI server.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, *, shuffle_partitions: int | None = None,
                  app: str = "snaphist", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only a single-process
    session (``local[...]``) that sets none gets a folder of its own: on a
    cluster every machine would write to its own disk, so that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None)
    if not target:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        target = tempfile.mkdtemp(prefix="snaphist-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target
