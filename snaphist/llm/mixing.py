"""Mixing sources to target weights: capped water-filling.

Every source has a weight and may be repeated at most ``max_epochs`` times.
The budget (all words) is shared by weight; sources whose share exceeds their
cap are clamped, and the excess is reshared by weight among the others until
none is above its cap. A document is then taken a whole number of times, and
some documents once more: those first in a seeded order of the source's
documents, up to its target. The one at the cut is taken in part, so each
source meets its target to the word.

Scale: only one row per (source, slice of the seeded order) is aggregated for
the cut; documents are ranked one by one in the single slice that the cut
falls into (a 4096th of the source), so no source is sorted in one task. The
loop's driver state is two numbers per round; sources stay a DataFrame.

Defined results: NULL or empty text has size 0 and is taken 0 words; a NULL
source is a source of its own, last in order; if all texts are empty all
targets are 0; repeated ids are separate documents (ordered by id, then
size); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaphist.llm.lineage import broadcast_if_small
from snaphist.llm.lineage import cut as cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SLICE_DIGITS = 3  # hex digits of the seeded order that name a slice


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weight 1, 2, .. ``cycle``, repeating, by code point order of the source
    (NULL last). One row per source is ranked."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sources.withColumn("weight", ((rank - 1) % cycle + 1).cast("long"))


def water_fill(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """``target`` for (source, source_size, weight). Each round aggregates the
    source table to the two numbers the next level needs."""
    capped = sources.withColumn("cap", F.col("source_size") * max_epochs)
    total = capped.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    free = None  # (words left, weight left) after clamping
    level = (total, capped.agg(F.sum("weight").alias("w")).first()["w"] or 1)
    while level != free:
        free = level
        over = F.col("weight") * F.lit(free[0]) >= F.col("cap") * F.lit(free[1])
        row = capped.agg(F.sum(F.when(over, F.col("cap")).otherwise(0)).alias("c"),
                         F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("w")).first()
        if not row["w"]:
            break
        level = (total - row["c"], row["w"])
    share = F.col("weight").cast("double") * F.lit(float(free[0])) / F.lit(float(free[1]))
    return capped.withColumn("target", F.least(F.col("cap").cast("double"), share)).drop("cap")


def mix_sources(docs: DataFrame, *, max_epochs: int = 3, seed: str = "mix-1", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, size, source, source_size, target, taken."""
    sized = docs.select(F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        word_count(F.col("text").cast("string")).alias("size"),
                        *[F.col(c) for c in keep if c not in ("doc_id", "source")])
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    sized = sized.withColumn("ord", order).withColumn("slice", F.substring("ord", 1, SLICE_DIGITS))
    slices = cut_lineage(sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")))
    sources = slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    targets = water_fill(cyclic_weights(sources), max_epochs)
    # words wanted beyond the whole repetitions; a target is reached by rounding to words
    want = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.select("source", "source_size", "target", whole.alias("whole"),
                             (want - whole * F.col("source_size")).alias("extra"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
    plan = slices.join(targets, slices.source.eqNullSafe(targets.source)) \
        .select(slices.source.alias("p_source"), F.col("slice").alias("p_slice"), "source_size", "target", "whole",
                (F.col("extra") - F.col("before")).alias("left"), "slice_size")
    plan = broadcast_if_small(plan)
    rows = sized.join(plan, sized.source.eqNullSafe(plan.p_source) & (F.col("slice") == F.col("p_slice")))
    cut = (F.col("left") > 0) & (F.col("left") < F.col("slice_size"))
    seen = Window.partitionBy("source").orderBy("ord", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    out = ["doc_id", *[c for c in keep if c not in ("doc_id", "source")], "source", "size", "source_size", "target"]
    at_cut = rows.where(cut).withColumn("seen", F.coalesce(F.sum("size").over(seen), F.lit(0))) \
        .withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("seen"))))
    rest = rows.where(~cut).withColumn("more", F.when(F.col("left") > 0, F.col("size")).otherwise(F.lit(0)))
    return rest.select(*out, "whole", "more").unionByName(at_cut.select(*out, "whole", "more")) \
        .withColumn("taken", (F.col("whole") * F.col("size") + F.col("more")).cast("long")).drop("whole", "more")


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 3 * source_size AS cap, (SELECT sum(source_size) FROM s)::BIGINT AS total,
         (sum(3 * source_size) OVER w)::BIGINT AS caps, (sum(weight) OVER w)::BIGINT AS below,
         (SELECT sum(weight) FROM s)::BIGINT AS all_w
  FROM s WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), f AS (  -- a clamped source is one whose cap is under the level left when all poorer ones are clamped
  SELECT *, (total - (caps - cap)) * weight >= cap * (all_w - (below - weight)) AS clamped FROM r
), l AS (
  SELECT (max(total) - coalesce(sum(cap) FILTER (clamped), 0))::DOUBLE AS words,
         coalesce(sum(weight) FILTER (NOT clamped), 0)::DOUBLE AS weights FROM f
), t AS (
  SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE weight::DOUBLE * words / weights END AS target FROM f, l
), x AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN round(t.target)::BIGINT // t.source_size ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || d.doc_id || ':' || d.size), d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, round(target)::BIGINT - whole * source_size - seen)))::BIGINT AS taken
FROM x
"""
