"""Cutting lineage so that a lost executor never costs the whole job again."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.session import ensure_checkpoint_dir

BROADCAST_ROWS = 500_000  # of a few numbers each


def cut(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def cut_as_dealt(df: DataFrame) -> DataFrame:
    """``cut`` of a repartitioned ``df`` that still knows how its rows are dealt,
    which Spark forgets under adaptive execution; grouping it by the same
    columns doesn't shuffle it again."""
    conf = df.sparkSession.conf
    was = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(df)
    finally:
        conf.set("spark.sql.adaptive.enabled", was)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` (narrow rows, cheap to count), marked for broadcast if it is
    within ``BROADCAST_ROWS``; beyond that a join shuffles it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def release(spark: SparkSession) -> None:
    """Frees the shuffle files and broadcasts of rounds that no plan holds any
    more, and their plans in the driver's heap. Spark's cleaner follows the garbage collection of the driver, which a driver with
    little to do puts off while the executors' disks fill."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_step(df: DataFrame) -> DataFrame:
    """``cut``, then ``release``: for a job of many steps with many tasks each,
    whose plans and task reports would add up in the driver's heap."""
    out = cut(df)
    release(df.sparkSession)
    return out
