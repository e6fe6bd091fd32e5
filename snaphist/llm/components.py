"""Connected components of an edge table, by alternating stars.

Each round hangs larger neighbours (large star), then smaller ones (small
star), below the smallest neighbour of a node; the edges end as stars around
each component's smallest node. Rounds are a few aggregations and joins of the
edge table, written to the checkpoint folder; nothing but two numbers per
round reaches the driver. Edges of which there are at most ``ONE_TASK`` (they
are counted first) are joined by union-find in a single task instead: a handful
of edges is not worth dozens of shuffles.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.llm.lineage import cut

ONE_TASK = 100_000  # edges


def _lowest(sym: DataFrame) -> DataFrame:
    return sym.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    sym = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(sym).select("u", F.least("u", "m").alias("m"))
    return sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    hung = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def smallest_of(edges: list[tuple]) -> dict:
    """Smallest node of each node's component, by union-find."""
    up: dict = {}

    def top(x):
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for u, v in edges:
        a, b = top(u), top(v)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(up)}


def _in_one_task(edges: DataFrame) -> DataFrame:
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches):
        rows, like = [], None
        for b in batches:
            like = b.column("u").type
            rows += zip(*([tuple(x.values()) if isinstance(x, dict) else x for x in b.column(c).to_pylist()] for c in ("u", "v")))
        if rows:
            names = [like.field(i).name for i in range(like.num_fields)] if pa.types.is_struct(like) else None
            value = lambda x: dict(zip(names, x)) if names else x
            found = smallest_of(rows)
            yield pa.RecordBatch.from_arrays([pa.array([value(x) for x in side], like) for side in (found.keys(), found.values())], names=["node", "component"])

    return edges.coalesce(1).mapInArrow(run, f"node {kind}, component {kind}")


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component) of every node with an edge; edges (u, v), u <> v."""
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if edges.count() <= one_task:
        return cut(_in_one_task(edges))
    sign = None
    while True:
        edges = cut(_small_star(_large_star(edges)))
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if (row["n"], row["s"]) == sign:
            break
        sign = (row["n"], row["s"])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
