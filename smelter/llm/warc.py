"""WARC archives of pages, written and read as a chunked record table.

``chunk_table`` cuts every payload into rows (record, chunk) of at most
``CHUNK_BYTES``; each row carries the SHA-256 of the payload up to its end, the
last one that of the whole.  Only these rows are sorted, shuffled, written or
handed to Python, so no task ever holds a whole oversized record.

``write_archives`` writes one WARC/1.1 record per page.  Of pages with equal
payloads of at least ``LEAST_SHARED`` bytes the one with the least id is a
``response``; the others are ``revisit`` records, which hold no payload and
name the response.  A payload of several chunks becomes a segmented record: a
``response`` with segment number 1 and ``continuation`` records, the last with
the total length.  Archives are gzip files that Spark's text sink commits: a
lost executor's files are written again, and never half seen.

``read_records`` reads archives (these, or others, gzipped or plain) line by
line against each record's Content-Length, so payloads may hold any bytes,
line ends and ``WARC/1.1`` included.  It hashes chunk after chunk and checks
each carried digest; the chunks of segmented records, whichever files they
stand in, are brought together by record and hashed in order.  A truncated archive is an error.

Defined results: a null payload is empty; a null id is written as no id and
counts as the greatest; of wholly repeated rows one is the response and the
others revisit it; white space and control characters are taken out of URLs,
a null URL is ``about:blank``; other columns take no part; an empty table
gives no record.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm.common import stored
from smelter.operators.sizing import broadcast_if_small
from smelter.session import scratch_dir

CHUNK_BYTES = 64 << 10
#: Shorter payloads are written out each time.
LEAST_SHARED = 100
#: Written into every record; pages carry no crawl time of their own.
DATE = "1970-01-01T00:00:00Z"
#: Bytes of chunks that a Python task holds before it sends them on.
HELD_BYTES = 4 << 20

#: Beyond so many bytes without its end an HTTP head is taken for payload.
HTTP_HEAD_BYTES = 64 << 10

#: Fixed values of the format.
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
HTTP_TYPE = "application/http;msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- chunks ------------------------------------------------------------------

def chunk_table(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html",
                size: int = CHUNK_BYTES) -> DataFrame:
    """Rows (record, page, url, chunk, last, end, body, digest); ``end`` is the
    payload's length up to the end of this chunk, ``digest`` its SHA-256."""
    body = F.coalesce(pages[payload].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("record"), pages[id].alias("page"),
                        pages[url].cast("string").alias("url"), body.alias("whole"))
    total = F.octet_length("whole")
    rows = rows.withColumn("chunks", F.ceil(F.greatest(total, F.lit(1)) / size).cast("int"))
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("record", "page", "url", "chunk", (F.col("chunk") == F.col("chunks") - 1).alias("last"),
                       F.least((F.col("chunk").cast("long") + 1) * size, total.cast("long")).alias("end"),
                       F.substring("whole", F.col("chunk") * size + 1, F.lit(size)).alias("body"))

    def run(batches):
        sha = hashlib.sha256()
        for batch in batches:
            digests = []
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                if chunk == 0:  # the chunks of a record come one after another
                    sha = hashlib.sha256()
                sha.update(body.as_buffer())
                digests.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())],
                                             [*batch.schema.names, "digest"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("digest", T.StringType())]))


def revisits(chunks: DataFrame) -> DataFrame:
    """(record, page, url, digest, first_record, first_page, first_url) of the
    records whose payload another one holds."""
    ends = chunks.where("last").select("record", "page", "url", F.col("end").alias("size"), "digest")
    order = F.struct(F.col("page").isNull().alias("no_page"), "page", "url", "record")
    groups = (ends.where(F.col("size") >= LEAST_SHARED).groupBy("digest", "size")
              .agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1"))
    # stored, so that a digest of many records can be split over tasks
    groups = stored(groups.select("digest", "size", F.col("first.record").alias("first_record"),
                                  F.col("first.page").alias("first_page"), F.col("first.url").alias("first_url")), "shared-payloads")
    found = ends.join(broadcast_if_small(groups), ["digest", "size"])
    return found.where("record <> first_record").drop("size")


# ---- writing -------------------------------------------------------------------

def _record_id(record: str, page: str, url: str, chunk: Column) -> Column:
    whole = F.concat_ws("/", F.col(record).cast("string"), F.coalesce(F.col(page).cast("string"), F.lit("-")),
                        F.coalesce(F.col(url), F.lit("-")), chunk.cast("string"))
    h = F.md5(whole.cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _field(name: str, value: Column | str) -> Column:
    """A header line, or nothing where the value is null."""
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _uri(url: str) -> Column:
    return F.coalesce(F.regexp_replace(url, r"[\x00-\x20\x7F]", ""), F.lit("about:blank"))


def _segments(chunks: DataFrame) -> DataFrame:
    """One text per chunk: a response, or a segment of one."""
    first, alone = F.col("chunk") == 0, (F.col("chunk") == 0) & F.col("last")
    head = F.when(first, F.lit(HTTP_HEAD)).otherwise(F.lit(""))
    origin = _record_id("record", "page", "url", F.lit(0))
    fields = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(first, F.lit("response")).otherwise(F.lit("continuation"))),
        _field("WARC-Record-ID", _record_id("record", "page", "url", F.col("chunk"))),
        _field("WARC-Date", DATE),
        _field("WARC-Target-URI", F.when(first, _uri("url"))),
        _field("Content-Type", F.when(first, F.lit(HTTP_TYPE))),
        _field("WARC-Segment-Number", F.when(~alone, F.col("chunk") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(~first, origin)),
        _field("WARC-Segment-Total-Length", F.when(F.col("last") & ~first, F.col("end") + len(HTTP_HEAD))),
        _field("WARC-Payload-Digest", F.when(F.col("last"), F.concat(F.lit("sha256:"), "digest"))),
        _field("X-Running-Digest", F.when(~F.col("last"), F.concat(F.lit("sha256:"), "digest"))),
        _field("X-Page-Id", F.col("page")),
        _field("Content-Length", F.octet_length("body") + F.octet_length(head)), F.lit("\r\n"), head)
    return chunks.select(F.concat(fields.cast("binary"), F.col("body")).cast("string").alias("value"))


def _revisit_records(found: DataFrame) -> DataFrame:
    return found.select(F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", "revisit"),
        _field("WARC-Record-ID", _record_id("record", "page", "url", F.lit(0))), _field("WARC-Date", DATE),
        _field("WARC-Target-URI", _uri("url")), _field("Content-Type", HTTP_TYPE), _field("WARC-Profile", REVISIT_PROFILE),
        _field("WARC-Refers-To", _record_id("first_record", "first_page", "first_url", F.lit(0))),
        _field("WARC-Refers-To-Target-URI", _uri("first_url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")), _field("X-Page-Id", F.col("page")),
        _field("Content-Length", F.lit(len(HTTP_HEAD))), F.lit("\r\n" + HTTP_HEAD)).alias("value"))


def write_archives(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html",
                   size: int = CHUNK_BYTES) -> None:
    """Gzipped WARC files below ``path``, one per task."""
    spark = pages.sparkSession
    where = scratch_dir(spark, "chunks")
    table = chunk_table(pages, id, url, payload, size)
    table.write.option("compression", "zstd").parquet(where)
    chunks = spark.read.schema(table.schema).parquet(where)
    found = stored(revisits(chunks), "revisits")
    kept = chunks.join(broadcast_if_small(found.select("record")), "record", "left_anti")
    texts = _segments(kept.sortWithinPartitions("record", "chunk")).union(_revisit_records(found))
    texts.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


# ---- reading -------------------------------------------------------------------

class _Parser:
    """Lines of archives in order, to chunks of records."""

    def __init__(self, size: int):
        self.size, self.fields, self.left, self.file = size, None, 0, None

    def chunks(self, batches):
        """Tuples (fields, part, body, end of the WARC record)."""
        for batch in batches:
            files = batch.column("file").to_numpy()
            change = np.flatnonzero(np.diff(files)) + 1
            bounds = [0, *change.tolist(), len(files)]
            lines = batch.column("line").to_pylist()
            for a, b in zip(bounds, bounds[1:], strict=False):
                if a < b and files[a] != self.file:
                    self.close()
                    self.file = files[a]
                for line in lines[a:b]:
                    yield from self.line(line)
        self.close()

    def close(self):
        if self.fields is not None:
            raise ValueError("a WARC archive ends within a record")

    def line(self, line: bytes):
        if self.left:
            yield from self.block(line)
        elif self.fields is None:
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
            self.fields = {}
        elif line.rstrip(b"\r"):
            name, _, value = line.partition(b":")
            self.fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        else:
            # the block and the two line ends that close it
            self.left = int(self.fields["content-length"]) + 4
            self.parts, self.held, self.part = [], 0, 0
            # a payload stands behind the HTTP head, in the first segment only
            self.strip = (self.fields.get("content-type", "").startswith("application/http")
                          and int(self.fields.get("warc-segment-number", 1)) == 1)

    def block(self, line: bytes):
        self.left -= len(line) + 1
        if self.left < 0:
            raise ValueError("a WARC record is longer than its Content-Length")
        self.parts.append(line)
        self.held += len(line) + 1
        if self.left and self.held < self.size + 4:
            return
        data = b"\n".join(self.parts) + b"\n"
        if not self.left and not data.endswith(b"\r\n\r\n"):
            raise ValueError("a WARC record is not closed where its Content-Length says")
        # the last four bytes may be the closing line ends
        body, rest = data[:-4], data[-4:]
        if self.strip:
            at = body.find(b"\r\n\r\n")
            if at < 0 and self.left and self.held < HTTP_HEAD_BYTES:
                self.parts = [data[:-1]]
                return
            body, self.strip = (body[at + 4:] if at >= 0 else body), False
        self.parts, self.held = [rest[:-1]], 4
        for at in range(0, max(len(body), 1), self.size):
            ends = not self.left and at + self.size >= len(body)
            yield self.fields, self.part, body[at:at + self.size], ends
            self.part += 1
        if not self.left:
            self.fields = None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # gzip files are not divided; a plain file is read as one piece as well
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line")))


#: Columns of a chunk that is read: ``origin`` is the record id of a record's
#: first segment, ``last`` says that the whole record ends here.
READ = ("origin string, type string, page string, refers string, number int, part int, last boolean, "
        "size long, digest string, carried string, body binary")


def _described(fields: dict, part: int, ends: bool):
    number = int(fields.get("warc-segment-number", 1))
    last = ends and ("warc-segment-number" not in fields or "warc-segment-total-length" in fields)
    digest = fields.get("warc-payload-digest" if last or "x-running-digest" not in fields else "x-running-digest", "")
    carried = digest.partition(":")[2].lower() if ends and digest.startswith("sha256:") else None
    return fields.get("warc-segment-origin-id", fields.get("warc-record-id")), number, last, carried


def _batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_chunks(spark: SparkSession, path: str, size: int = CHUNK_BYTES) -> DataFrame:
    """All records below ``path`` as chunk rows with their bodies."""

    def run(batches):
        rows, held = [], 0
        for fields, part, body, ends in _Parser(size).chunks(batches):
            origin, number, last, carried = _described(fields, part, ends)
            rows.append((origin, fields.get("warc-type"), fields.get("x-page-id"), fields.get("warc-refers-to"),
                         number, part, last, len(body), None, carried, body))
            held += len(body) + 500
            if held > HELD_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return _lines(spark, path).mapInArrow(run, READ)


def _pieces(spark: SparkSession, path: str, size: int) -> DataFrame:
    """One row per record that is not segmented, with the size and digest
    read; the chunks of segmented ones, with their bodies."""

    def run(batches):
        rows, held, sha, count = [], 0, None, 0
        for fields, part, body, ends in _Parser(size).chunks(batches):
            origin, number, last, carried = _described(fields, part, ends)
            about = (origin, fields.get("warc-type"), fields.get("x-page-id"), fields.get("warc-refers-to"), number, part, last)
            held += 500
            if "warc-segment-number" in fields:
                rows.append((*about, len(body), None, carried, body))
                held += len(body)
            else:
                if part == 0:
                    sha, count = hashlib.sha256(), 0
                sha.update(body)
                count += len(body)
                if ends:
                    rows.append((*about, count, sha.hexdigest(), carried, None))
            if held > HELD_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return _lines(spark, path).mapInArrow(run, READ)


def _joined(chunks: DataFrame) -> DataFrame:
    """Segmented records from their chunks, wherever these stood: each
    record's chunks come in order and are hashed one after another."""

    def run(batches):
        at = sha = about = None
        count, due, good, rows = 0, (1, 0), True, []
        for batch in batches:
            for *what, number, part, last, _, _, carried, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if what[0] != at:
                    at, sha, count, due, good, about = what[0], hashlib.sha256(), 0, (1, 0), True, what
                good = good and (number, part) in (due, (due[0] + 1, 0))
                sha.update(body)
                count, due = count + len(body), (number, part + 1)
                good = good and carried in (None, sha.hexdigest())
                if last:
                    rows.append((*about, 1, 0, True, count, sha.hexdigest(), carried if good else "", None))
                    at = None
            if rows:
                yield _batch(rows)
                rows = []

    ordered = chunks.repartition("origin").sortWithinPartitions("origin", "number", "part")
    return ordered.mapInArrow(run, READ)


def read_records(spark: SparkSession, path: str, id_type: str = "long", size: int = CHUNK_BYTES) -> DataFrame:
    """One row per response and revisit below ``path``: page_id, payload_bytes,
    payload_digest, record_type, refers_to, intact (the bytes read have the
    digest that the record carries; a revisit: its response's one)."""
    pieces = stored(_pieces(spark, path, size), "pieces")
    found = pieces.where("body is null").union(_joined(pieces.where("body is not null")))
    found = found.select("origin", "type", F.col("page").cast(id_type).alias("page"), "refers", "size", "digest", "carried")
    # stored, so that the many revisits of one response can be split over tasks
    found = stored(found.where("type in ('response', 'revisit')"), "records")
    responses = found.where("type = 'response'")
    whole = responses.select("page", "size", "digest", F.col("type").alias("record_type"), F.lit(None).cast(id_type).alias("refers_to"),
                             F.coalesce(F.col("digest") == F.col("carried"), F.col("carried").isNull()).alias("intact"))
    target = responses.select(F.col("origin").alias("refers"), F.col("page").alias("refers_to"),
                              F.col("size").alias("full"), F.col("digest").alias("read"))
    again = (found.where("type = 'revisit'").join(target, "refers", "left")
             .select("page", F.col("full").alias("size"), F.col("carried").alias("digest"), F.col("type").alias("record_type"),
                     "refers_to", F.coalesce(F.col("read") == F.col("carried"), F.lit(False)).alias("intact")))
    return whole.union(again).select(F.col("page").alias("page_id"), F.col("size").alias("payload_bytes"),
                                     F.col("digest").alias("payload_digest"), "record_type", "refers_to", "intact")
