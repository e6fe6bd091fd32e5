"""Landing documents derived from the driver tables.

The driver tables stand in for the CRM source: every scenario below builds
the JSON texts an extract would land (entity objects, owners, pipelines with
stages, association batch results, page envelopes) from whole tables with
row-wise expressions, so the work grows with the tables. Run-to-run changes
are rules over the data (status, priority, dates), applied to every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import VALID_FROM, crm_contracts

# Fixed values of the scenarios: source tag, column prefix, run ids and clocks.
SOURCE = "crm"
PREFIX = "source"
RUNS = {
    "r1": "2024-01-01 00:00:00",
    "r2": "2024-01-02 00:00:00",
    "r3": "2024-01-03 00:00:00",
}
R2_UPDATED = "2024-01-02T00:00:00Z"
FIRST_CUTOFF = "2001-01-01"     # run 1 holds the orders placed before this date
EMPTY_HORIZON = "2100-01-01"    # no order is placed after this date
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"

CONTRACTS = crm_contracts(PREFIX)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The same rows in several tasks per core, dealt by all their columns.
    Texts that are built and parsed from a row cost far more than reading it,
    and scan tasks are cut by bytes, none finer than a row group: 128 MB of
    narrow rows are minutes of work for one core while others idle."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *df.columns)


def money(c: Column) -> Column:
    return c.cast("decimal(12,2)").cast("string")


def iso(c: Column) -> Column:
    return F.date_format(c, ISO)


# --------------------------------------------------------------- orders -> deals
def _order_run_columns(o: DataFrame, run: str) -> DataFrame:
    """Status/updatedAt of an order as seen by ``run``, and whether the order
    is in that run's extract."""
    flipped = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")
    deleted = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    created = iso(F.col("o_orderdate"))
    if run == "all":
        return o.select("*", F.col("o_orderstatus").alias("status"), created.alias("updated"))
    if run == "r1":
        return o.where(F.col("o_orderdate") < F.lit(FIRST_CUTOFF).cast("timestamp_ntz")).select(
            "*", F.col("o_orderstatus").alias("status"), created.alias("updated"))
    status = F.when(flipped, F.lit("F")).otherwise(F.col("o_orderstatus"))
    updated = F.when(flipped, F.lit(R2_UPDATED)).otherwise(created)
    if run == "r2":
        return o.where(~deleted).select("*", status.alias("status"), updated.alias("updated"))
    if run == "r3":
        return o.select("*", status.alias("status"), updated.alias("updated"))
    if run == "empty":
        return o.where(F.col("o_orderdate") > F.lit(EMPTY_HORIZON).cast("timestamp_ntz")).select(
            "*", F.col("o_orderstatus").alias("status"), created.alias("updated"))
    raise ValueError(run)


def order_properties(status: Column) -> Column:
    return F.struct(
        status.alias("status"),
        F.col("o_orderpriority").alias("priority"),
        money(F.col("o_totalprice")).alias("amount"),
        F.col("o_custkey").cast("string").alias("customer"),
    )


def order_docs(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """Deal objects of one run's extract as JSON text (column ``doc``)."""
    o = _order_run_columns(table(spark, sf_dir, "orders"), run)
    return o.select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        order_properties(F.col("status")).alias("properties"),
        iso(F.col("o_orderdate")).alias("createdAt"),
        F.col("updated").alias("updatedAt"),
        F.lit(False).alias("archived"),
    )).alias("doc"))


def order_pages(spark: SparkSession, sf_dir: str, run: str, page_size: int = 100) -> DataFrame:
    """The same extract as page envelopes of ``page_size`` consecutive keys
    (``o_orderkey`` is the primary key, so a page never exceeds the size)."""
    o = _order_run_columns(table(spark, sf_dir, "orders"), run)
    page = F.floor(F.col("o_orderkey") / F.lit(page_size)).cast("long")
    obj = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        order_properties(F.col("status")).alias("properties"),
        iso(F.col("o_orderdate")).alias("createdAt"),
        F.col("updated").alias("updatedAt"),
        F.lit(False).alias("archived"),
    )
    pages = o.groupBy(page.alias("page")).agg(F.collect_list(obj).alias("results"))
    nxt = F.struct(F.struct(((F.col("page") + 1) * page_size).cast("string").alias("after")).alias("next"))
    return pages.select(F.to_json(F.struct("results", nxt.alias("paging"))).alias("value"), "page")


def broken_order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as pages, some of them damaged by rule: every seventh ends
    halfway, every eleventh is an error answer."""
    whole = order_pages(spark, sf_dir, "all")
    half = F.substring("value", F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    return whole.select(F.when(F.col("page") % 7 == 3, half).when(F.col("page") % 11 == 5, F.lit('{"status":"error"}'))
                        .otherwise(F.col("value")).alias("value"))


#: Extracts of all orders that lost or gained pages by rule.
CHAINS = ("whole", "no_first", "no_middle", "no_last", "doubled", "cycle")


def order_page_chains(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """All orders as a chain of pages that carry their request cursors
    (``extract, value``), once whole and once per kind of damage. Keys are
    consecutive, so every page number up to the last one exists."""
    whole = order_pages(spark, sf_dir, "all", page_size)
    last = whole.agg(F.max("page")).scalar()
    page = F.col("page")
    half = F.floor(last / 2)
    cursor = lambda p: F.struct((p * page_size).cast("string").alias("after"))
    results = F.from_json("value", "struct<results:array<string>>", {"mode": "FAILFAST"})["results"]
    head = F.to_json(F.struct(F.when(page > 0, cursor(page)).alias("request")))
    # pages from the middle on lead back to the middle, the one before ends the chain
    ahead = F.when(F.col("extract") == "cycle", F.when(page == last, half).when(page != half - 1, page + 1)).when(page != last, page + 1)
    paging = F.to_json(F.struct(F.struct(F.when(ahead.isNotNull(), cursor(ahead)).alias("next")).alias("paging")))
    text = F.concat(F.regexp_replace(head, "}$", F.when(page > 0, ",").otherwise("")), F.lit('"results":['), F.array_join("results", ","), F.lit("],"), F.substr(paging, F.lit(2)))
    copies = F.when((F.col("extract") == "doubled") & (page % 11 == 5), 2).otherwise(1)
    gone = F.coalesce(((F.col("extract") == "no_first") & (page == 0)) | ((F.col("extract") == "no_middle") & (page % 7 == 3)) | ((F.col("extract") == "no_last") & (page == last)), F.lit(False))
    rows = whole.select("page", results.alias("results"), F.explode(F.array(*map(F.lit, CHAINS))).alias("extract")).where(~gone)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select("extract", text.alias("value"))


# ---------------------------------------------------------- customer -> companies
def customer_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.regexp_replace("c_name", "#", "-")), F.lit(".example")).alias("domain"),
            F.col("c_mktsegment").alias("segment"),
            money(F.col("c_acctbal")).alias("balance"),
            F.col("c_nationkey").cast("string").alias("nation"),
        ).alias("properties"),
        F.concat(F.lit("2020-01-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"),
                 F.lit("T00:00:00Z")).alias("createdAt"),
        F.lit("2023-12-31T00:00:00Z").alias("updatedAt"),
        (F.col("c_acctbal") < 0).alias("archived"),
    )).alias("doc"))


# ------------------------------------------------------------- supplier -> owners
def supplier_docs(spark: SparkSession, sf_dir: str, run: str = "r1") -> DataFrame:
    """Owner objects; suppliers with a negative balance have no user id and no
    teams. Run 2 leaves out suppliers of nation 0; run 3 renames e-mails."""
    s = table(spark, sf_dir, "supplier")
    if run == "r2":
        s = s.where(F.col("s_nationkey") != 0)
    local = F.lower(F.regexp_replace("s_name", "#", "."))
    domain = F.lit("@example.com") if run != "r3" else F.lit("@example.org")
    neg = F.col("s_acctbal") < 0
    team = F.array(F.struct(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("id")))
    return s.select(F.to_json(F.struct(
        F.col("s_suppkey").alias("id"),
        F.when(~neg, F.col("s_nationkey") + 1000).alias("userId"),
        F.concat(local, domain).alias("email"),
        F.lit("Supplier").alias("firstName"),
        F.col("s_suppkey").cast("string").alias("lastName"),
        F.when(~neg, team).alias("teams"),
        F.lit("2020-01-01T00:00:00Z").alias("createdAt"),
        F.lit(False).alias("archived"),
    )).alias("doc"))


# ------------------------------------------------------------ part -> pipelines
def part_pipeline_docs(spark: SparkSession, sf_dir: str, block: int = 100) -> DataFrame:
    """Pipelines = brand x block of ``block`` consecutive part keys (a bounded
    stage list per pipeline); stages = parts."""
    p = table(spark, sf_dir, "part")
    pid = F.concat(F.col("p_brand"), F.lit("/"), F.floor(F.col("p_partkey") / F.lit(block)).cast("string"))
    stage = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("label"),
        F.col("p_size").alias("displayOrder"),
        F.struct(F.col("p_type").alias("type"), money(F.col("p_retailprice")).alias("price")).alias("metadata"),
        (F.col("p_size") > 45).alias("archived"),
    )
    grouped = p.groupBy(pid.alias("id"), F.col("p_brand").alias("label")).agg(
        F.collect_list(stage).alias("stages"))
    return grouped.select(F.to_json(F.struct(
        "id", "label", F.lit("2020-01-01T00:00:00Z").alias("createdAt"),
        F.lit(False).alias("archived"), "stages")).alias("doc"))


# --------------------------------------------------- lineitem -> associations
def lineitem_assoc_docs(spark: SparkSession, sf_dir: str, *, dealt: bool = False) -> DataFrame:
    """One association batch result per line item: from = the order, to =
    [the part, the supplier]. The supplier item carries ``toObjectId`` 0 and
    the id in ``id``; returned lines ('N') have an empty type list. ``dealt``
    spreads the line items before any text is built."""
    li = table(spark, sf_dir, "lineitem")
    if dealt:
        li = spread(li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"))
    line_type = F.struct(F.lit("ORDER_LINE").alias("category"), F.col("l_linenumber").alias("typeId"),
                         F.col("l_returnflag").alias("label"))
    status_type = F.struct(F.lit("LINE_STATUS").alias("category"),
                           F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("typeId"),
                           F.col("l_linestatus").alias("label"))
    part_types = F.when(F.col("l_returnflag") == "N", F.array().cast(
        "array<struct<category:string,typeId:int,label:string>>")).otherwise(F.array(line_type, status_type))
    part_item = F.struct(F.col("l_partkey").alias("toObjectId"), part_types.alias("associationTypes"))
    supp_item = F.struct(F.lit(0).alias("toObjectId"), F.col("l_suppkey").cast("string").alias("id"),
                         F.array(F.struct(F.lit("SUPPLIER").alias("category"), F.lit(7).alias("typeId"),
                                          F.lit("supplies").alias("label"))).alias("associationTypes"))
    # the two items have different shapes, so the "to" array is joined as text
    return li.select(F.concat(
        F.lit('{"from":'), F.to_json(F.struct(F.col("l_orderkey").alias("id"))),
        F.lit(',"to":['), F.to_json(part_item), F.lit(","), F.to_json(supp_item), F.lit("]}"),
    ).alias("doc"))


def unique_assoc_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as association results that pass the uniqueness gate: one
    edge, of a type of its own, per line."""
    kind = F.struct(F.lit("LINE").alias("category"), F.col("l_linenumber").alias("typeId"), F.col("l_returnflag").alias("label"))
    item = F.struct((F.col("l_partkey") + 1).alias("toObjectId"), F.array(kind).alias("associationTypes"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_returnflag").alias("l_returnflag"))
    return lines.select(F.to_json(F.struct(F.struct(F.col("l_orderkey").alias("id")).alias("from"), F.array(item).alias("to"))).alias("doc"))


# ------------------------------------------------------------ events -> replay
def event_day_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily full extracts of users: a user is in day d's extract when it had
    an event that day; its ``segment`` is the type of its last event of the
    day. Columns: ``user_id, day, segment, last_ts``."""
    e = table(spark, sf_dir, "events")
    day = F.to_date(F.col("ts"))
    return e.groupBy(F.col("user_id"), day.alias("day")).agg(
        F.max_by(F.col("event_type"), F.struct(F.col("ts"), F.col("event_id"))).alias("segment"),
        F.max("ts").alias("last_ts"),
    )


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day between the first and last event (including days without
    events): ``run_seq`` 1..N and ``_valid_from`` = the next midnight."""
    e = table(spark, sf_dir, "events")
    bounds = e.agg(F.min(F.to_date("ts")).alias("d0"), F.max(F.to_date("ts")).alias("d1"))
    days = bounds.select("d0", F.explode(F.sequence("d0", "d1")).alias("day"))
    return days.select(
        "day",
        (F.datediff("day", "d0") + 1).alias("run_seq"),
        F.date_add("day", 1).cast("timestamp").alias(VALID_FROM),
    )
