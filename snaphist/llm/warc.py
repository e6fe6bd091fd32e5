"""WARC archives: segmented records, revisits, chunked payloads.

Writing: a page becomes a ``response`` record whose block is an HTTP answer in
chunked transfer framing. A block longer than ``segment_bytes`` is cut: the
first part stays in the response (segment 1), the rest follows in
``continuation`` records that name the response as their origin; the last one
states the total length. Of equal payloads, the one with the smallest key is
the response and the others become ``revisit`` records without a body.

Reading: Spark's text reader, split at the start of the next record, yields a
record a row, so files of any size stream in bounded memory, from any store
that Spark reads. A record is held against its ``Content-Length``. Segments, and
only they, are shuffled by their origin and sorted by number; a run of one
origin is put together while it streams by. Total length, chunk framing and
payload digest are verified; what is wrong with a record stands in ``fault``.

Scale: equal payloads meet as 20-byte digests, of which only those that occur
twice or more are joined back (broadcast behind a check of their number,
otherwise a shuffled join that AQE splits at a hot digest). No group is
gathered: a segmented record is at most one payload.

Defined results: a NULL payload is an empty one; a NULL key sorts after all
others and is written without a key; rows that repeat the smallest key of a
payload are responses too; a NULL or empty URI leaves its field out; line
breaks in a URI are percent-encoded; an empty table gives an archive without
pages. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.llm.lineage import broadcast_if_small, cut

SEGMENT_BYTES = 16 << 10  # of a record's block
CHUNK_BYTES = 4 << 10  # of the chunked framing
FLUSH_BYTES = 4 << 20  # of records given to Spark at a time
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
VERSION, RECORD_START, CRLF = b"WARC/1.1", b"WARC/1.", b"\r\n"
NEXT_RECORD = CRLF + CRLF + RECORD_START
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked\r\n\r\n"
# Fields of our own.
KEY, REFERS_TO = "Record-Key", "Refers-To-Key"
# Kinds of ``fault``.
BAD_LENGTH, BAD_SEGMENTS, BAD_TOTAL, BAD_CHUNKS, BAD_DIGEST = "content_length", "segments", "total_length", "chunks", "digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------------- writing
def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing. A chunk also ends inside anything that looks
    like the start of the next record."""
    cuts = set(range(size, len(payload), size))
    at = payload.find(NEXT_RECORD)
    while at >= 0:
        cuts.add(at + 5)
        at = payload.find(NEXT_RECORD, at + 1)
    out, lo = [], 0
    for hi in sorted(cuts | {len(payload)}):
        if hi > lo:
            out += [b"%x" % (hi - lo), CRLF, payload[lo:hi], CRLF]
        lo = hi
    return b"".join([*out, b"0\r\n\r\n"])


def segments_of(block: bytes, size: int) -> list[bytes]:
    """``block`` in parts of at most ``size`` bytes (which must exceed 8)."""
    out, lo = [], 0
    while len(block) - lo > size:
        hi = lo + size
        if block.startswith(RECORD_START, hi):  # else it would follow the header's empty line
            hi -= 1
        out.append(block[lo:hi])
        lo = hi
    return [*out, block[lo:]]


def record(kind: str, record_id: str, block: bytes, date: str, **fields) -> bytes:
    """One record without its last line break; fields that are None are left out."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), *((k.replace("_", "-"), v) for k, v in fields.items()), ("Content-Length", len(block))]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head if v is not None)]
    return b"".join([CRLF.join(lines), CRLF, CRLF, block, CRLF])


def page_records(key: int | None, uri: str | None, payload: bytes, first_key: int | None, new_id, size: int, date: str) -> Iterator[bytes]:
    """The records of one page; a revisit if ``first_key`` is another page's."""
    own = new_id()
    uri = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", uri) if uri else None
    common = {"WARC_Target_URI": uri, "Record_Key": key, "WARC_Payload_Digest": f"sha1:{base32_sha1(payload)}", "Content_Type": "application/http;msgtype=response"}
    if first_key is not None and key != first_key:
        yield record("revisit", own, HTTP_HEAD, date, **common, WARC_Profile=REVISIT_PROFILE, Refers_To_Key=first_key)
        return
    block = HTTP_HEAD + chunked(payload)
    parts = segments_of(block, size)
    yield record("response", own, parts[0], date, **common, WARC_Segment_Number=1 if len(parts) > 1 else None)
    for k, part in enumerate(parts[1:], 2):
        yield record("continuation", new_id(), part, date, WARC_Target_URI=uri, WARC_Segment_Number=k, WARC_Segment_Origin_ID=own,
                     WARC_Segment_Total_Length=len(block) if k == len(parts) else None)


def write_archive(pages: DataFrame, path: str, *, key: str = "page_id", uri: str = "url", payload: str = "html", min_revisit_bytes: int = 0,
                  segment_bytes: int = SEGMENT_BYTES, date: str = DATE, compression: str = "gzip") -> None:
    """Writes ``pages`` as WARC files below ``path``, by Spark's own writer (a
    lost task's file is never seen). Payloads of fewer than
    ``min_revisit_bytes`` bytes are never revisits."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    digest = F.unhex(F.sha1("payload"))
    first = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy(digest.alias("digest")).agg(F.min("key").alias("first_key"), F.count("*").alias("n"))
    first = broadcast_if_small(cut(first.where("n > 1").select("digest", "first_key")))
    rows = rows.join(first, digest == first.digest, "left").select("key", "uri", "payload", F.when(F.octet_length("payload") >= min_revisit_bytes, F.col("first_key")).alias("first_key"))

    def write(batches):
        task, n = TaskContext.get().partitionId(), 0

        def new_id() -> str:
            nonlocal n
            n += 1
            return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}/{task}/{n}')}>"

        out = [record("warcinfo", new_id(), b"format: WARC File Format 1.1\r\n", date, Content_Type="application/warc-fields")]
        held = 0
        for b in batches:
            for k, u, p, f in zip(*(b.column(c) for c in ("key", "uri", "payload", "first_key"))):
                for r in page_records(k.as_py(), u.as_py(), p.as_py(), f.as_py(), new_id, segment_bytes, date):
                    out.append(r)
                    held += len(r)
                if held > FLUSH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows.mapInArrow(write, "record binary").select(F.col("record").cast("string").alias("value")) \
        .write.options(**{"lineSep": "\r\n", "compression": compression, "zlib.compress.level": "BEST_SPEED"}).text(path)


# ------------------------------------------------------------------- reading
def fields_of(head: bytes) -> dict[str, str]:
    """Named fields by lower-case name; folded lines continue the one before."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(CRLF)[1:]
    named = (x.partition(b":") for x in lines)
    return {k.strip().decode("latin-1").lower(): v.strip().decode("utf-8", "replace") for k, sep, v in named if sep}


def dechunk(body: bytes) -> bytes | None:
    """The data of chunked framing; None if the framing is broken. Chunk
    extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), end + 2
        if not n:
            break
        out.append(body[at:at + n])
        if body[at + n:at + n + 2] != CRLF:
            return None
        at += n + 2
    while not body.startswith(CRLF, at):  # trailers, up to an empty line
        end = body.find(CRLF, at)
        if end < 0:
            return None
        at = end + 2
    return b"".join(out) if at + 2 == len(body) else None


def payload_of(block: bytes) -> tuple[bytes, str | None]:
    """(payload, fault) of an HTTP answer."""
    head, _, body = block.partition(CRLF + CRLF)
    if "chunked" not in fields_of(head).get("transfer-encoding", "").lower():
        return body, None
    data = dechunk(body)
    return (b"", BAD_CHUNKS) if data is None else (data, None)


def split_records(rows: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(fields, block, fault) of each record. ``rows`` were cut wherever a
    record seems to start; one shorter than its ``Content-Length`` goes on in
    the next row. A row may hold several (the line reader misses a separator
    that overlaps the end of its buffer)."""
    held = b""
    for row in rows:
        starts = row.startswith(RECORD_START)
        if held and not starts:
            raw = held + NEXT_RECORD + row
        else:
            if held:  # a file that ends within a record
                yield fields_of(held.partition(CRLF + CRLF)[0]), b"", BAD_LENGTH
            raw = row if starts else RECORD_START + row
        held = b""
        while raw.strip(CRLF):
            head, _, block = raw.partition(CRLF + CRLF)
            f = fields_of(head)
            n = int(f["content-length"]) if f.get("content-length", "").isdigit() else 0
            if len(block) < n:
                held = raw
                break
            raw = block[n:].lstrip(CRLF)
            whole = "content-length" in f and (not raw or raw.startswith(RECORD_START))
            yield f, block[:n], None if whole else BAD_LENGTH
            raw = raw if whole else b""
    if held:
        yield fields_of(held.partition(CRLF + CRLF)[0]), b"", BAD_LENGTH


RECORD = "record_type string, key long, uri string, refers_to long, payload_digest string, payload binary, fault string"
SEGMENT = "origin string, number int, total long, block binary, record_type string, key long, uri string, refers_to long, payload_digest string, fault string"


def _columns(f: dict[str, str]) -> dict:
    whole = lambda name: int(f[name]) if re.fullmatch(r"-?\d+", f.get(name, "")) else None
    digest = f.get("warc-payload-digest", "")
    return {"record_type": f.get("warc-type"), "key": whole(KEY.lower()), "uri": f.get("warc-target-uri"), "refers_to": whole(REFERS_TO.lower()),
            "payload_digest": digest.removeprefix("sha1:") if digest.startswith("sha1:") else None}


def _decoded(row: dict, block: bytes, fault: str | None) -> dict:
    data, bad = (b"", None) if row["record_type"] == "revisit" or fault else payload_of(block)
    fault = fault or bad
    if not fault and row["record_type"] == "response":
        own = base32_sha1(data)
        fault = BAD_DIGEST if row["payload_digest"] not in (None, own) else None
        row = row | {"payload_digest": own}
    return row | {"payload": data, "fault": fault}


def _batches(rows: Iterator[dict], schema: pa.Schema, size: str) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for r in rows:
        out.append(r)
        held += len(r[size]) + 200
        if held > FLUSH_BYTES:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, held = [], 0
    yield pa.RecordBatch.from_pylist(out, schema)


ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, ARROW[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _values(batches) -> Iterator[bytes]:
    for b in batches:
        for v in b.column("value"):
            yield v.as_py()


def join_segments(rows: Iterator[dict]) -> Iterator[dict]:
    """Whole records of segments that come by origin and number."""
    def whole(parts: list[dict]) -> dict:
        first, block = parts[0], b"".join(p["block"] for p in parts)
        total = parts[-1]["total"]
        fault = next((p["fault"] for p in parts if p["fault"]), None)
        if not fault and ([p["number"] for p in parts] != list(range(1, len(parts) + 1)) or total is None):
            fault = BAD_SEGMENTS
        if not fault and total != len(block):
            fault = BAD_TOTAL
        return _decoded({c.split()[0]: first[c.split()[0]] for c in RECORD.split(", ")[:5]}, block, fault)

    parts: list[dict] = []
    for r in rows:
        if parts and parts[0]["origin"] != r["origin"]:
            yield whole(parts)
            parts = []
        parts.append(r)
    if parts:
        yield whole(parts)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit below ``path``: record_type, key, uri,
    refers_to, payload_digest (of the payload as read; a revisit's as stated),
    payload, and ``fault`` (NULL if all is well)."""
    lines = spark.read.option("lineSep", NEXT_RECORD.decode()).text(path).select(F.col("value").cast("binary").alias("value"))

    def single(batches):
        rows = ((_columns(f), block, fault) for f, block, fault in split_records(_values(batches)) if "warc-segment-number" not in f and (fault or f.get("warc-type") in ("response", "revisit")))
        yield from _batches((_decoded(*r) for r in rows), _schema(RECORD), "payload")

    def segments(batches):
        def rows():
            for f, block, fault in split_records(_values(batches)):
                if "warc-segment-number" in f:
                    number, total = f["warc-segment-number"], f.get("warc-segment-total-length", "")
                    yield _columns(f) | {"origin": f.get("warc-segment-origin-id") or f.get("warc-record-id"), "number": int(number) if number.isdigit() else -1,
                                         "total": int(total) if total.isdigit() else None, "block": block, "fault": fault}
        yield from _batches(rows(), _schema(SEGMENT), "block")

    def joined(batches):
        yield from _batches(join_segments(r for b in batches for r in b.to_pylist()), _schema(RECORD), "payload")

    parts = lines.mapInArrow(segments, SEGMENT).repartition("origin").sortWithinPartitions("origin", "number")
    return lines.mapInArrow(single, RECORD).unionByName(parts.mapInArrow(joined, RECORD))


def payload_sizes(records: DataFrame) -> DataFrame:
    """key, uri, payload_bytes, payload_digest, record_type, refers_to of the
    records, a revisit's size taken from the response that it refers to.
    A record with a fault, or a revisit without its response, fails the job."""
    r = records.select("key", "uri", "record_type", "refers_to", "payload_digest", "fault", F.octet_length("payload").cast("long").alias("payload_bytes"))
    r = cut(r.withColumn("fault", F.when(F.col("fault").isNotNull(), F.raise_error(F.concat(F.lit("archive record with a fault: "), "fault")).cast("string"))))
    known = r.where("record_type = 'response' AND key IS NOT NULL").groupBy(F.col("key").alias("k"), F.col("payload_digest").alias("d")).agg(F.min("payload_bytes").alias("b"))
    out = ["key", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    again = r.where("record_type = 'revisit'").join(known, (F.col("refers_to") == F.col("k")) & (F.col("payload_digest") == F.col("d")), "left") \
        .withColumn("payload_bytes", F.coalesce("b", F.raise_error(F.lit("revisit without its response")).cast("long")))
    return r.where("record_type = 'response'").select(*out).unionByName(again.select(*out))


#: What comes back, in plain SQL (table pages): base32 from five-digit groups of the hash.
ARCHIVE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(d.h, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d JOIN f ON d.h = f.h
"""
