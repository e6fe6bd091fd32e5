"""JSON landing zone reader.

The extract lands as JSON text: one page envelope
``{"results": [...], "paging": {"next": {"after": ...}}}`` per line (or per
file with ``whole_file=True``), and ``"request": {"after": ...}``, the cursor
that the page was requested with (none on the first). Pages are independent, so
the read splits by file and by line across the cluster; cursors are not
followed one by one, the chain they form is checked as a graph.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import jpath, parse_fields
from ..operators.flatten import as_variant, from_id
from ..session import ensure_checkpoint_dir

DOC = "doc"


def read_landing(spark: SparkSession, path: str | Sequence[str], *, whole_file: bool = False) -> DataFrame:
    """Raw landed texts as a single ``value`` column. Text files split by size
    (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``); nothing is
    shuffled to spread them."""
    reader = spark.read.option("wholetext", "true") if whole_file else spark.read
    paths = [path] if isinstance(path, str) else list(path)
    return reader.text(paths)


def envelope_results(pages: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of ``results``, kept as JSON text in ``doc``, and
    the page's ``keep`` columns. Blank
    lines are no pages. A page that is not JSON, or has no ``results`` list
    (an error answer), fails the job: read as empty it would close every key
    it should have listed."""
    env = parse_fields(F.col(text_col), {"results": "array<string>"})
    results = F.coalesce(env["results"], F.raise_error(F.lit("landed page without a results list")).cast("array<string>"))
    return pages.where(F.trim(text_col) != "").select(*keep, F.explode(results).alias(DOC))


# Kinds of ``page_faults``.
NOT_JSON, NO_RESULTS = "not_json", "no_results"


def page_faults(pages: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per page that cannot be read: ``fault`` and the page's text."""
    shape = "struct<results:array<string>,_broken:string>"
    env = F.from_json(F.col(text_col), shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    read = pages.where(F.trim(text_col) != "").select(F.col(text_col).alias("page"), env.alias("env"))
    fault = F.when(F.col("env").isNull() | F.col("env._broken").isNotNull(), NOT_JSON).when(F.col("env.results").isNull(), NO_RESULTS)
    return read.select(fault.alias("fault"), "page").where(F.col("fault").isNotNull())


CURSORS = "struct<request:struct<after:string>,paging:struct<next:struct<after:string>>>"


def page_cursors(pages: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, the cursor that each page was requested with (NULL:
    the first page) and the one it leads to (NULL: the last page)."""
    env = F.from_json(F.col(text_col), CURSORS, {"mode": "PERMISSIVE"})
    cursor = lambda c: F.nullif(F.col(c), F.lit(""))
    return pages.where(F.trim(text_col) != "").select(*keep, env.alias("env")) \
        .select(*keep, cursor("env.request.after").alias("request"), cursor("env.paging.next.after").alias("next"))


def next_cursor(pages: DataFrame, text_col: str = "value") -> DataFrame:
    """The ``paging.next.after`` cursor of every page (NULL on the last page)."""
    return page_cursors(pages, text_col).select(F.col("next").alias("after"))


# Kinds of ``chain_faults``.
FIRST, LAST, LOST, UNREACHED, DOUBLED, FORKED, ENDLESS = "first_page", "last_page", "lost_page", "unreached_page", "doubled_page", "forked_page", "endless_page"


def chain_faults(pages: DataFrame, extract: str, text_col: str = "value") -> DataFrame:
    """What keeps the pages of each extract (column ``extract``) from being one
    chain from its first to its last page; no rows if all are whole.

    Columns ``extract, fault, cursor, pages``. A page that lost its request or
    next page, one landed twice, two pages that lead to the same next one, and
    other than one first or last page are faults; so is every page from which
    no last page can be reached (a cycle beside the chain breaks no other
    rule). An extract without any cursors is unpaged and whole.

    The cursors (two short texts a page) are stored once; next and request
    cursors meet in two anti joins. Cycles are found by pointer doubling: each
    round doubles the length of all jumps and drops the pages that reached an
    end, so rounds are the logarithm of the longest chain."""
    ensure_checkpoint_dir(pages.sparkSession)
    c = page_cursors(pages.withColumnRenamed(extract, "extract"), text_col, ("extract",)).checkpoint()
    ends = c.groupBy("extract").agg((F.count("request") + F.count("next")).alias("paged"), F.count_if(F.col("request").isNull()).alias("first"),
                                    F.count_if(F.col("next").isNull()).alias("last")).where("paged > 0")
    kind = lambda df, fault, cursor, n: df.select("extract", F.lit(fault).alias("fault"), cursor.alias("cursor"), F.col(n).alias("pages"))
    nothing = F.lit(None).cast("string")
    links = c.groupBy("extract", "request", "next").agg(F.count(F.lit(1)).alias("n"))
    asked = links.where("request IS NOT NULL").groupBy("extract", "request").agg(F.sum("n").alias("n"), F.max("next").alias("next"))
    led = links.where("next IS NOT NULL").groupBy("extract", "next").agg(F.count(F.lit(1)).alias("n"))
    request, nxt = asked.select("extract", F.col("request").alias("cursor"), "n"), led.select("extract", F.col("next").alias("cursor"), "n")
    at = F.col("cursor")
    faults = [
        kind(ends.where("first <> 1"), FIRST, nothing, "first"), kind(ends.where("last <> 1"), LAST, nothing, "last"),
        kind(nxt.join(request, ["extract", "cursor"], "left_anti"), LOST, at, "n"), kind(request.join(nxt, ["extract", "cursor"], "left_anti"), UNREACHED, at, "n"),
        kind(request.where("n > 1"), DOUBLED, at, "n"), kind(nxt.where("n > 1"), FORKED, at, "n"),
        kind(_endless(asked.where("next IS NOT NULL").select("extract", F.col("request").alias("page"), F.col("next").alias("jump"))).withColumn("n", F.lit(1).cast("long")),
             ENDLESS, F.col("page"), "n"),
    ]
    return reduce(DataFrame.unionByName, faults)


def _endless(live: DataFrame) -> DataFrame:
    """The pages (``extract, page, jump``; one jump each) from which no jumps
    lead to a page without one."""
    live = live.checkpoint()
    rounds = live.count().bit_length()  # 2 ** rounds exceeds the longest chain
    for _ in range(rounds):
        ahead = live.select("extract", F.col("page").alias("jump"), F.col("jump").alias("further"))
        live = live.join(ahead, ["extract", "jump"]).select("extract", "page", F.col("further").alias("jump")).checkpoint()
        if live.isEmpty():
            break
    return live


def assert_whole_extracts(pages: dict[str, DataFrame], text_col: str = "value") -> None:
    """Refuses paged extracts (by name) that are not whole: a lost page would
    be taken for deletions. All are checked together; at most ten faults reach
    the driver."""
    if not pages:
        return
    named = reduce(DataFrame.unionByName, [p.select(F.col(text_col).alias("value"), F.lit(name).alias("extract")) for name, p in pages.items()])
    found = chain_faults(named, "extract").limit(10).collect()
    if found:
        shown = "".join(f"\n  {r['extract']}: {r['fault']} {r['cursor'] or ''} ({r['pages']})" for r in found)
        raise ValueError(f"[landing/cursor-chain] extracts that are not whole:{shown}")


def read_objects(spark: SparkSession, path: str | Sequence[str], *, whole_file: bool = False) -> DataFrame:
    """Landing dir of page envelopes -> one JSON object text per row."""
    return envelope_results(read_landing(spark, path, whole_file=whole_file))


def _projected(properties: Sequence[str]):
    wanted = F.array(*[F.lit(p) for p in properties])
    parsed = F.from_json(jpath(F.col(DOC), "$.properties"), "map<string,string>")
    return F.to_json(F.map_filter(parsed, lambda k, v: F.array_contains(wanted, k)))


def project_properties(docs: DataFrame, properties: Sequence[str]) -> DataFrame:
    """The requested keys of ``properties`` as text, beside the document
    (source key order kept)."""
    return docs.withColumn("properties_projected", _projected(properties))


def project_objects(docs: DataFrame, properties: Sequence[str]) -> DataFrame:
    """Objects whose ``properties`` hold the requested keys only, as if the
    source had been asked for no others; the other members stay as they are."""
    names = ("id", "createdAt", "updatedAt", "archived")
    whole = F.from_json(F.col(DOC), "map<string,string>", {"mode": "FAILFAST"})
    typed = F.from_json(F.col(DOC), "struct<" + ",".join(f"{n}:variant" for n in names) + ">")
    pieces = [F.when(F.map_contains_key(whole, n), F.concat(F.lit(f'"{n}":'), F.coalesce(F.to_json(typed[n]), F.lit("null")))) for n in names]
    pieces.insert(1, F.when(F.map_contains_key(whole, "properties"), F.concat(F.lit('"properties":'), F.coalesce(_projected(properties), F.lit("{}")))))
    return docs.withColumn(DOC, F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}")))


def scope_to_ids(edges: DataFrame, ids: DataFrame, edge_col: str = "from_id", id_col: str = "id") -> DataFrame:
    """Keep association results whose from-id was extracted in this run
    (EXISTS); an empty id set yields no rows. Spark picks broadcast or
    shuffle for the semi join from the id side's measured size."""
    return edges.join(ids.select(F.col(id_col).alias(edge_col)), edge_col, "left_semi")


def scope_results_to_ids(results: DataFrame, ids: DataFrame, *, doc_col: str = DOC,
                         id_col: str = "id") -> DataFrame:
    """Keep association batch results whose ``from.id`` was extracted in this
    run, before they are flattened: the semi join then moves one document per
    result instead of one row per edge and type, and a sampled run flattens
    only its own results. (Catalyst does not push a semi join below a
    generator.) Documents come out parsed to VARIANT, so this is their only
    parse."""
    keyed = as_variant(results, doc_col).withColumn("__from_id", from_id(F.col(doc_col)))
    return scope_to_ids(keyed, ids.select(F.col(id_col).alias("id")).distinct(),
                        edge_col="__from_id").drop("__from_id")


def sample_first(rows: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """Deterministic sample: first ``n`` rows by ``order_by`` (top-k per
    partition, then one bounded merge)."""
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
