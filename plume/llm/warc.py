"""WARC archives: pages to request, response (or revisit) and metadata
records, and back, with the records of one capture put together through their
WARC-Concurrent-To identifiers.

Writing is DataFrame work: each record is one binary string, and Spark's text
writer ends each with CRLF CRLF, as the format asks. Of pages with the same
payload of :data:`REVISIT_BYTES` or more, the one with the smallest id is a
response; the others are revisits that refer to it and hold no payload.

Files are bounded by bytes (:data:`FILE_BYTES`), however large the pages are.
Reading parses whole archive files by Content-Length, so payloads may contain
anything.

Defined results: null payloads are empty ones; a page with a null id is a
response; of rows with one id, payload and size that allow a revisit, but
different addresses, the first by a hash of the address is the response; rows
that are equal throughout are written alike and give as many rows when read;
an identifier that no record has, or identifiers that run in a ring, leave
their records as captures of their own; a chain of identifiers leads to the
record that names no other; of several main records of one capture the one
with the smallest identifier counts. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plume.llm.common import pa_schema, stored, text_columns
from plume.session import scratch_path

REVISIT_BYTES = 100
#: Bytes of an archive file, about and at most, before compression; a larger record has a file of its own.
FILE_BYTES = 64 << 20
#: Payloads up to this size share files of FILE_BYTES / SMALL_BYTES pages; larger ones those of their own.
SMALL_BYTES = 64 << 10
#: Records of a page.
PER_PAGE = 3
CRLF = "\r\n"

RECORDS = ("type string, id string, concurrent_to string, refers_to string, target_uri string, page_id long, "
           "payload_digest string, payload_bytes long, payload binary")


def _record(kind: str, record_id: Column, concurrent: Column | None, uri: Column, extra: list[Column],
            block: Column) -> Column:
    """One record as binary, without the blank lines that end it."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), record_id)]
    if concurrent is not None:
        lines.append(F.concat(F.lit("WARC-Concurrent-To: "), concurrent))
    lines.append(F.concat(F.lit("WARC-Target-URI: "), uri))
    lines.append(F.lit("WARC-Date: 1970-01-01T00:00:00Z"))
    lines += extra
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    head = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2))
    return F.concat(head.cast("binary"), block)


def write_archive(pages: DataFrame, path: str | None = None) -> str:
    """Write the pages (page_id, url, html) as WARC files; gives the folder. Large pages are written by themselves, as many
    to a file as the largest one allows; equal payloads have equal sizes, so each group is in one of the two parts."""
    path = path or scratch_path(pages.sparkSession, "warc")
    size = F.coalesce(F.octet_length(F.col("html").cast("binary")), F.lit(0))
    largest = pages.agg(F.max(size)).first()[0] or 0
    _write(pages.where(size <= SMALL_BYTES) if largest > SMALL_BYTES else pages, path, SMALL_BYTES)
    if largest > SMALL_BYTES:
        _write(pages.where(size > SMALL_BYTES), path, largest)
    return path


def _write(pages: DataFrame, path: str, largest: int) -> None:
    own = text_columns(pages, "page_id", "url", "html").withColumn(
        "payload", F.coalesce(F.col("html").cast("binary"), F.lit(b""))).withColumn(
        "digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload")).withColumn(
        "name", F.concat_ws("-", F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
                            F.substring(F.sha2(F.concat_ws(" ", "digest", "url"), 256), 1, 16)))
    # Heads of groups with equal payloads: counted before the shuffle, so a hot payload is one row a task. They are stored,
    # so that the join below reads two tables and adaptive execution can split a payload with very many copies.
    heads = stored(own.where((F.col("bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("page_id", "name")).alias("head"), F.count("*").alias("copies")).where("copies > 1"), "heads")
    joined = own.join(heads, "digest", "left")
    urn = lambda kind, name="name": F.concat(F.lit(f"<urn:plume:{kind}:"), F.col(name), F.lit(">"))
    revisit = F.col("page_id").isNotNull() & F.col("head").isNotNull() & (F.col("name") != F.col("head.name"))
    # A line break in an address would end the header line.
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    marks = [F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
             F.concat(F.lit("Plume-Page-ID: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")))]
    http = F.encode(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF * 2}"), "UTF-8")
    main = urn("response")
    response = _record("response", main, None, uri, [F.lit("Content-Type: application/http; msgtype=response"), *marks],
                       F.concat(http, F.col("payload")))
    again = _record("revisit", main, None, uri, [
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.concat(F.lit("WARC-Refers-To: "), urn("response", "head.name")), *marks],
        http)
    page_path = F.regexp_extract(uri, r"^[^:]*://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract(uri, r"://([^/?#]*)", 1)
    ask = F.concat(F.lit("GET "), F.when(page_path.startswith("/"), page_path).otherwise(F.concat(F.lit("/"), page_path)),
                   F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2)).cast("binary")
    request = _record("request", urn("request"), main, uri, [F.lit("Content-Type: application/http; msgtype=request")], ask)
    note = _record("metadata", urn("metadata"), urn("request"), uri, [F.lit("Content-Type: application/warc-fields")],
                   F.concat(F.lit("fetched-bytes: "), F.col("bytes").cast("string")).cast("binary"))
    records = joined.select(F.explode(F.array(request, F.when(revisit, again).otherwise(response), note)).alias("record"))
    # Text keeps the bytes of a binary value as they are.
    in_file = max(1, FILE_BYTES // max(largest, 1)) * (PER_PAGE if largest <= FILE_BYTES else 1)
    records.select(F.col("record").cast("string").alias("value")).write.mode("append").option("lineSep", CRLF * 2).option(
        "compression", "gzip").option("maxRecordsPerFile", in_file).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of an archive file, gzipped or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        headers = dict((k.lower(), v) for k, _, v in (line.partition(": ") for line in lines))
        size = int(headers["content-length"])
        yield headers, content[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def _rows(content: bytes) -> Iterator[dict]:
    for headers, block in parse(content):
        kind = headers["warc-type"]
        _, _, payload = block.partition(b"\r\n\r\n") if kind == "response" else (b"", b"", None)
        page = headers.get("plume-page-id", "")
        digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
        if kind == "response":
            found = hashlib.sha256(payload).hexdigest()
            if digest is not None and found != digest:
                raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
            digest = found
        yield {"type": kind, "id": headers["warc-record-id"], "concurrent_to": headers.get("warc-concurrent-to"),
               "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"),
               "page_id": int(page) if page else None, "payload_digest": digest,
               "payload_bytes": None if payload is None else len(payload), "payload": payload}


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives in a folder; ``payloads=False`` leaves the payload bytes behind."""
    schema = pa_schema(spark, RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for k in range(part.num_rows):
                rows, size = [], 0
                for row in _rows(part.column("content")[k].as_py()):
                    size += row["payload_bytes"] or 0
                    rows.append(row if payloads else row | {"payload": None})
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def _capture_of(records: DataFrame) -> DataFrame:
    """(id, capture): the record at the end of each chain of concurrent-to identifiers.

    Pointer jumping: each round doubles the length that is resolved. Rings never
    end; they are what is left when a round resolves nothing more.
    """
    own = records.groupBy("id").agg(F.min("concurrent_to").alias("capture")).select(
        "id", F.coalesce("capture", "id").alias("capture"))
    known = own.select(F.col("id").alias("there"), (F.col("id") == F.col("capture")).alias("root"))
    links = stored(own.join(known, own["capture"] == known["there"], "left").select(
        "id", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("capture")).alias("capture"),
        F.coalesce("root", F.lit(True)).alias("done")), "links")
    left = links.where("NOT done").count()
    while left:
        onward = links.select(F.col("id").alias("there"), F.col("capture").alias("next"), F.col("done").alias("ended"))
        pending = links.where("NOT done")
        moved = pending.join(onward, pending["capture"] == onward["there"]).select(
            "id", F.col("next").alias("capture"), F.col("ended").alias("done"))
        links = stored(links.where("done").unionByName(moved), "links")
        before, left = left, links.where("NOT done").count()
        if left == before:
            break
    return links.select("id", F.when(F.col("done"), F.col("capture")).otherwise(F.col("id")).alias("capture"))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: response or revisit, request and metadata."""
    links = _capture_of(records)
    whole = records.join(links, "id", "left")
    one = lambda kinds, name: F.min_by(F.when(F.col("type").isin(*kinds), F.col(name)), F.when(
        F.col("type").isin(*kinds), F.col("id")))
    main = ("response", "revisit")
    grouped = whole.groupBy("capture").agg(
        *[one(main, c).alias(f"m_{c}") for c in ("type", "refers_to", "target_uri", "page_id", "payload_digest",
                                                 "payload_bytes", "payload")],
        *[one(("request",), c).alias(f"r_{c}") for c in ("id", "target_uri")],
        F.sort_array(F.collect_list(F.when(F.col("type") == "metadata", F.col("id")))).alias("notes"),
        F.count(F.when(F.col("type").isin(*main), F.col("id"))).alias("copies"))
    return grouped.select(
        "capture",
        F.struct(*[F.col(f"m_{c}").alias(c) for c in ("type", "refers_to", "target_uri", "page_id", "payload_digest",
                                                      "payload_bytes", "payload")]).alias("response"),
        F.struct(F.col("r_id").alias("id"), F.col("r_target_uri").alias("target_uri")).alias("request"),
        F.col("notes").alias("metadata"), F.col("copies"))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Page rows; a revisit takes its payload's size from the response it refers to."""
    own = stored(captures.select("capture", "response.type", "response.page_id", "response.payload_bytes",
                                 "response.payload_digest", "response.refers_to", "copies").where("type IS NOT NULL"),
                 "captures")
    heads = own.where("type = 'response'").select(
        F.col("capture").alias("there"), F.col("page_id").alias("head"), F.col("payload_bytes").alias("full"))
    # Only revisits take part in the join: responses name no record, and would all meet at null.
    again = own.where("type = 'revisit'")
    joined = again.join(heads, again["refers_to"] == heads["there"], "left").select(*own.columns, "head", "full")
    joined = joined.unionByName(own.where("type = 'response'").withColumns(
        {"head": F.lit(None).cast("long"), "full": F.lit(None).cast("long")}))
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "page_id", F.coalesce("payload_bytes", "full").alias("payload_bytes"), "payload_digest",
        F.col("type").alias("record_type"), F.when(F.col("type") == "revisit", F.col("head")).alias("refers_to"))
