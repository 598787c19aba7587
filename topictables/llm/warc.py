"""WARC archives: writing captures, and assembling their records into transactions."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import shared_folder, table

#: Payloads of fewer bytes are always kept whole.
LEAST_BYTES = 100
#: Records of one archive file at most, by the largest payload in it: no file holds more than about 400 MB.
FILE_RECORDS = ((1 << 16, 6000), (1 << 20, 384), (1 << 24, 24), (None, 3))
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"

RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "content_type string, declared_digest string, payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """One record without the two line ends that close it. Headers whose value is null are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines += [F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def write(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> None:
    """Writes a request, a response or revisit, and a metadata record for each row, gzip-compressed.

    Of rows with equal payloads of LEAST_BYTES or more the one with the smallest id is the response,
    rows with other ids revisit it and carry no payload. Null payloads are empty, null urls are left out.
    A null id is no target of a revisit unless no row with that payload has one; rows that share the
    smallest id are all responses. Line ends inside urls become spaces. The records are text, ended by
    two line ends, which is what Spark's text writer writes: files appear through its commit, wherever
    the path lies. Captures of similar size are written together, the fewer to a file the larger
    they are (FILE_RECORDS); an empty table leaves an archive without records.
    """
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    rows = pages.select(F.col(id_column).cast("string").alias("id"), F.col(id_column).alias("key"), F.regexp_replace(url_column, r"[\r\n]+", " ").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    # Small payloads meet nothing, so they need not meet each other either.
    rows = rows.withColumn("meet", F.when(F.col("bytes") >= LEAST_BYTES, F.col("digest")).otherwise(F.concat_ws("-", "id", F.substring("digest", 1, 8))))
    firsts = rows.where(F.col("bytes") >= LEAST_BYTES).groupBy(F.col("digest").alias("meet")).agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").select("meet", "first")
    decided = rows.join(firsts, "meet", "left").withColumn("revisit", F.coalesce(~F.col("key").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)))

    def name(kind: str, of: Column) -> Column:
        return F.concat(F.lit("<urn:capture:"), F.coalesce(of.cast("string"), F.lit("")), F.lit(":"), F.substring("digest", 1, 16), F.lit(f":{kind}>"))

    main = name("main", F.col("key"))
    uri = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    request_line = F.concat(F.lit("GET "), F.coalesce(F.regexp_replace("url", " ", "%20"), F.lit("/")), F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    response = _record("response", main, [uri, digest], "application/http; msgtype=response", F.concat(http, F.col("payload")))
    revisit = _record("revisit", main, [uri, digest, ("WARC-Refers-To", name("main", F.col("first"))), ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))], "application/http; msgtype=response", http)
    request = _record("request", name("request", F.col("key")), [("WARC-Concurrent-To", main), uri], "application/http; msgtype=request", request_line)
    fields = F.concat(F.lit("payload-length: "), F.col("bytes").cast("string"), F.lit(CRLF))
    metadata = _record("metadata", name("metadata", F.col("key")), [("WARC-Concurrent-To", main), uri], "application/warc-fields", fields)
    three = F.explode(F.array(request, F.when(F.col("revisit"), revisit).otherwise(response), metadata)).alias("value")
    largest = rows.agg(F.max("bytes")).first()[0] or 0
    above = -1
    for number, (most, records) in enumerate(FILE_RECORDS):
        some = decided.where(F.col("bytes") > above)
        if most is not None and largest > most:
            some = some.where(F.col("bytes") <= most)
        some.select(three).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records).text(f"{path}/{number}")
        if most is None or largest <= most:
            return
        above = most


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of a WARC file that is not compressed."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        last = None
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in " \t" and last:
                headers[last] += " " + text.strip()
            else:
                field, _, value = text.partition(":")
                last = field.strip().lower()
                headers[last] = value.strip()
        size = int(headers.get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a WARC record ends before its Content-Length")
        yield headers, block


def _fields(block: bytes) -> list[tuple[str, str]]:
    lines = [line.partition(":") for line in block.decode("utf-8", "replace").splitlines()]
    return [(name.strip(), value.strip()) for name, colon, value in lines if colon]


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all WARC files under a path, plain or gzip-compressed (as a whole or by record).

    payload is what follows the HTTP head in requests, responses and revisits, else the whole block;
    its size and SHA-256 are computed from it. fields are those of application/warc-fields. A file is
    the unit of a task, so archives should be of bounded size. Files that are no WARC, or end early, fail.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                stream = io.BytesIO(raw)
                if raw[:2] == b"\x1f\x8b":
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
                rows: list[tuple] = []
                for h, block in parse(stream):
                    http = h.get("content-type", "").startswith("application/http")
                    payload = block.partition(b"\r\n\r\n")[2] if http else block
                    fields = _fields(block) if h.get("content-type", "").startswith("application/warc-fields") else None
                    rows.append((h.get("warc-type"), h.get("warc-record-id"), h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"), h.get("content-type"), h.get("warc-payload-digest"), len(payload), hashlib.sha256(payload).hexdigest(), fields, payload if with_payload else None))
                    if len(rows) >= 1000:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(records, RECORD)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * 8 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture (the response or revisit), request, metadata (array).

    Requests and metadata find their capture through the record they are concurrent to. Of several
    requests of one capture the first in order is taken, metadata records are all listed; records
    whose capture is missing, and such of other types, form no transaction. Captures that repeat stay
    repeated. A capture without request or metadata has null or an empty array there.
    """
    body = F.struct("record_id", "target_uri", "date", "content_type", "payload_bytes", "payload_digest", "payload")
    request = records.where("type = 'request' and concurrent_to is not null").groupBy(F.col("concurrent_to").alias("record_id")).agg(F.min(body).alias("request"))
    pairs = F.array_sort(F.map_entries("fields"))
    note = records.where("type = 'metadata' and concurrent_to is not null").groupBy(F.col("concurrent_to").alias("record_id")).agg(F.sort_array(F.collect_set(F.struct(F.col("record_id").alias("id"), pairs.alias("fields")))).alias("metadata"))
    capture = records.where("type in ('response', 'revisit')").select("record_id", F.struct("type", "record_id", "refers_to", "target_uri", "date", "declared_digest", "payload_bytes", "payload_digest", "payload").alias("capture"))
    empty = F.array().cast("array<struct<id:string,fields:array<struct<key:string,value:string>>>>")
    return capture.join(request, "record_id", "left").join(note, "record_id", "left").select("capture", "request", F.coalesce("metadata", empty).alias("metadata"))


def op10_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages hold; null payloads, urls and ids as in `write`."""
    path = shared_folder(spark)
    write(table(spark, sf_dir, "pages"), path)
    found = transactions(read(spark, path, with_payload=False))
    revisit = F.col("capture.type") == "revisit"
    id_of = lambda c: F.regexp_extract(c, r"^<urn:capture:(-?\d*):", 1)
    number = lambda c: F.when(id_of(c) != "", id_of(c).cast("long"))
    noted = F.element_at(F.map_from_entries(F.get(F.col("metadata.fields"), F.lit(0))), "payload-length").cast("long")
    declared = F.regexp_extract("capture.declared_digest", "^sha256:(.*)$", 1)
    return found.select(
        number(F.col("capture.record_id")).alias("page_id"),
        F.when(revisit, noted).otherwise(F.col("capture.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, declared).otherwise(F.col("capture.payload_digest")).alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        F.when(revisit, number(F.col("capture.refers_to"))).alias("refers_to"),
    )


ORACLE = """
WITH p AS (
    SELECT page_id, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes FROM pages
), f AS (SELECT digest, min(page_id) AS first FROM p WHERE bytes >= 100 GROUP BY digest)
SELECT page_id, bytes AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""
