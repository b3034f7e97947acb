"""WARC archives with revisit records.

Headers (record key, digest, length) are shuffled by payload digest, never the payloads; the
first capture of each digest keeps its payload and the others become revisit records that refer
to it. Archives are written by Spark's own text writer, whose record separator is exactly the
end mark of a WARC record, so a lost executor's half-written files are never seen. Reading
parses each archive by its Content-Length fields and joins revisits to their originals.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook.llm.common import parts_for, table
from clientbook.operators.staging import shared_folder, staged

#: Payloads shorter than this are always stored: a revisit record would save nothing.
LEAST_BYTES = 100
#: Payload bytes that one archive holds on average.
ARCHIVE_BYTES = 8 << 20
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def headers_of(captures: DataFrame) -> DataFrame:
    """(capture_id, digest, bytes, record_key) of captures (capture_id, uri, payload)."""
    digest = F.sha2(_payload().cast("binary"), 256)
    return captures.select(
        "capture_id",
        digest.alias("digest"),
        F.octet_length(_payload()).cast("bigint").alias("bytes"),
        _record_key(F.col("capture_id"), digest).alias("record_key"),
    )


def _payload() -> Column:
    return F.coalesce(F.col("payload").cast("string"), F.lit(""))


def _record_key(capture_id: Column, digest: Column) -> Column:
    return F.concat_ws(":", F.coalesce(capture_id.cast("string"), F.lit("")), digest)


def resolve(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(record_key, refers_to) of the captures that revisit an earlier one.

    Of captures with equal payloads of at least ``least_bytes`` that with the smallest id is
    the original. The minimum is aggregated before the shuffle, so a payload that a third of all
    captures share is one row per task; digests seen once never reach the join. Rows that repeat
    the smallest id are originals as well; a null id is never an original if another id is there.
    """
    large = headers.filter(F.col("bytes") >= least_bytes)
    originals = (
        large.groupBy("digest")
        .agg(F.min("capture_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    return (
        large.join(originals, "digest")
        .filter("capture_id IS NULL OR capture_id > refers_to")
        .select("record_key", "refers_to")
        .distinct()
    )


def write_archives(captures: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> str:
    """Write one record per capture (capture_id, uri, payload) below ``path``; returns ``path``.

    A null payload is empty. Other columns are ignored. An empty frame writes no record.
    """
    captures = captures.select("capture_id", "uri", "payload")
    headers = staged(headers_of(captures))
    parts = parts_for(headers.agg(F.sum("bytes")).first()[0], ARCHIVE_BYTES)
    revisits = resolve(headers, least_bytes).repartition(parts, "record_key")
    digest = F.sha2(_payload().cast("binary"), 256)
    keyed = captures.select(
        "capture_id",
        "uri",
        _payload().alias("payload"),
        digest.alias("digest"),
        _record_key(F.col("capture_id"), digest).alias("record_key"),
    ).repartition(parts, "record_key")
    resolved = keyed.join(revisits, "record_key", "left")
    resolved.select(_record().alias("value")).write.option("compression", "gzip").option(
        "lineSep", CRLF + CRLF
    ).text(path)
    return path


def _record() -> Column:
    """The record as text, without the end mark that the writer adds."""

    def urn(capture_id: Column) -> Column:
        return F.concat(F.lit("<urn:capture:"), F.coalesce(capture_id.cast("string"), F.lit("")), F.lit(">"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.regexp_replace(F.coalesce(F.col("uri").cast("string"), F.lit("")), r"\s", "%20")
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        field("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", urn(F.col("capture_id"))),
        field("WARC-Date", now),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            is_revisit,
            F.concat(field("WARC-Refers-To", urn(F.col("refers_to"))), field("WARC-Profile", F.lit(PROFILE))),
        ).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )


_ID = re.compile(rb"<urn:capture:(-?\d*)>")
_READ = pa.schema(
    [
        ("capture_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("stated_digest", pa.string()),
        ("stored_bytes", pa.int64()),
        ("stored_digest", pa.string()),
    ]
)
_PAYLOAD = pa.field("payload", pa.binary())


def records(archive: memoryview) -> Iterator[tuple[dict[bytes, bytes], memoryview]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    at, whole = 0, archive.obj
    while at < len(archive):
        end = whole.index(b"\r\n\r\n", at)
        lines = bytes(archive[at:end]).split(b"\r\n")
        fields = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields[b"content-length"])
        yield fields, archive[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def _parse(with_payload: bool):
    schema = _READ.append(_PAYLOAD) if with_payload else _READ

    def number(value: bytes | None):
        found = _ID.match(value or b"")
        return int(found[1]) if found and found[1] else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for fields, block in records(memoryview(archive.as_py())):
                    start = bytes(block[:4096]).index(b"\r\n\r\n") + 4
                    payload = block[start:]
                    kind = fields[b"warc-type"].decode()
                    stored = kind != "revisit"
                    rows.append(
                        {
                            "capture_id": number(fields[b"warc-record-id"]),
                            "record_type": kind,
                            "refers_to": number(fields.get(b"warc-refers-to")),
                            "stated_digest": fields[b"warc-payload-digest"].decode().removeprefix("sha256:"),
                            "stored_bytes": len(payload) if stored else None,
                            "stored_digest": hashlib.sha256(payload).hexdigest() if stored else None,
                            **({"payload": bytes(payload) if stored else None} if with_payload else {}),
                        }
                    )
                    held += len(payload)
                    if len(rows) >= 5000 or with_payload and held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return parse, schema


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record, with length and digest of the payload as it is stored.

    A revisit stores none: its three ``stored`` values are null, see :func:`with_originals`.
    """
    parse, schema = _parse(with_payload)
    names = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    ddl = ", ".join(f"{f.name} {names[f.type]}" for f in schema)
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.col("value").cast("binary").alias("archive")).mapInArrow(parse, ddl)


def with_originals(read: DataFrame) -> DataFrame:
    """Each record with length and digest of its full payload, taken from the original for revisits.

    The join is on the digest that both records state, and on the original's id.
    """
    originals = (
        read.filter("record_type <> 'revisit'")
        .select(
            F.col("capture_id").alias("refers_to"),
            "stated_digest",
            F.col("stored_bytes").alias("original_bytes"),
            F.col("stored_digest").alias("original_digest"),
        )
        .dropDuplicates(["refers_to", "stated_digest"])
    )
    revisits = read.filter("record_type = 'revisit'").join(originals, ["refers_to", "stated_digest"], "left")
    kept = read.filter("record_type <> 'revisit'").select(
        "capture_id", "record_type", "refers_to",
        F.col("stored_bytes").alias("payload_bytes"), F.col("stored_digest").alias("payload_digest"),
    )
    return kept.unionByName(
        revisits.select(
            "capture_id", "record_type", "refers_to",
            F.col("original_bytes").alias("payload_bytes"), F.col("original_digest").alias("payload_digest"),
        )
    )


def query(spark, folder: str) -> DataFrame:
    """Every page as found in the archives written from the table: response, or revisit of an equal payload."""
    pages = table(spark, folder, "pages")
    captures = pages.select(
        F.col("page_id").alias("capture_id"), F.col("url").alias("uri"), F.col("html").alias("payload")
    )
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(captures, path)
    records_read = staged(read_archives(spark, path))
    return with_originals(records_read).select(
        F.col("capture_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM m
"""
