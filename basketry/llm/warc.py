"""WARC archives: write, read back, and revisit resolution.

Records are rows: page_id, url, record_type (``response`` or ``revisit``), payload
(binary; null for a revisit read from an archive), payload_bytes and payload_digest
(SHA-256, both of the full payload), refers_to.

``resolve_revisits``: the headers (digest, id, length; never payloads) are combined per
digest before they are shuffled, so a payload that a third of all pages share is one
row per task; digests that occur more than once are written as a small table and
joined back. Both join sides are then plain shuffles, so Spark may broadcast the small
side when it measures it under its limit and otherwise splits a hot digest.

``write_archive`` lets Spark's text writer put down whole records (fresh headers, CRLF
separators, gzip); ``read_archive`` reads the files through Spark and cuts records by
their Content-Length, so payloads may hold any bytes, also whole WARC records. Each
file is one gzip member.

Defined results: null payload = empty payload. Payloads under ``min_bytes`` are always
responses. Rows that repeat the smallest id stay responses; a null id with a payload
that occurs elsewhere is a revisit. A revisit record without any original keeps its
old refers_to. A line break in a url is written as %0A.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import materialize, table
from basketry.session import scratch_path

MIN_BYTES = 100
RECORDS_PER_FILE = 2000
# Header lines of the archive format.
VERSION = "WARC/1.0"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORD = (
    "page_id bigint, url string, record_type string, payload binary, "
    "payload_bytes bigint, payload_digest string, refers_to bigint"
)


def response_records(pages: DataFrame) -> DataFrame:
    """One response record per page row."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.lit("response").alias("record_type"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
        F.lit(None).cast("long").alias("refers_to"),
    )


def resolve_revisits(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Each record as response or revisit; revisits point at the smallest id."""
    long_enough = F.col("payload_bytes") >= min_bytes
    originals = (
        records.where(long_enough)
        .groupBy(F.unhex("payload_digest").alias("__key"))
        .agg(
            F.min(F.when(F.col("record_type") == "response", F.col("page_id"))).alias("__first"),
            F.count(F.lit(1)).alias("__n"),
        )
        .where("__n > 1 AND __first IS NOT NULL")
        .drop("__n")
    )
    originals = materialize(originals, "warc-originals")
    # short payloads match nothing: their keys, shorter than any digest, only spread them
    own = F.col("page_id").cast("string").cast("binary")
    joined = records.withColumn(
        "__key", F.when(long_enough, F.unhex("payload_digest")).otherwise(own)
    ).join(originals, "__key", "left")
    again = F.col("__first").isNotNull() & ~F.col("__first").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id",
        "url",
        F.when(again, "revisit").otherwise(F.col("record_type")).alias("record_type"),
        F.when(~again, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(again, F.col("__first"))
        .when(F.col("record_type") == "revisit", F.col("refers_to"))
        .alias("refers_to"),
    )


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def record_text() -> Column:
    """The record as text, up to the CRLF that the writer adds (null fields: no line)."""
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(
        F.coalesce(F.col("payload").cast("string"), F.lit(""))
    )
    lines = F.concat_ws(
        "\r\n",
        F.lit(VERSION),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        F.lit(f"WARC-Date: {DATE}"),
        _line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]+", "%0A")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("X-Payload-Length", F.col("payload_bytes")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.lit("Content-Type: text/html"),
        _line("Content-Length", F.octet_length(block)),
    )
    return F.concat(lines, F.lit("\r\n\r\n"), block, F.lit("\r\n"))


def write_archive(records: DataFrame, path: str) -> None:
    """Write records as gzip-compressed WARC files (RECORDS_PER_FILE records a file)."""
    (
        records.select(record_text().alias("value"))
        .write.option("lineSep", "\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def _number(value: str | None) -> int | None:
    return int(value[len("<urn:page:") : -1]) if value else None


def _records(stream: io.BufferedIOBase) -> Iterator[tuple]:
    """(headers, payload) of each record of an archive stream."""
    while line := stream.readline():
        if line.strip() == b"":
            continue
        if line.strip() != VERSION.encode():
            raise ValueError(f"not a record start: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        yield head, block


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archive files under ``path``; digests of responses are computed
    from the payload that was read."""
    import gzip
    import hashlib

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(),
                 pa.int64()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                held = 0
                for head, block in _records(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    kind = head["warc-type"]
                    digest = head["warc-payload-digest"].partition(":")[2]
                    size = int(head["x-payload-length"])
                    if kind == "response":
                        digest, size = hashlib.sha256(block).hexdigest(), len(block)
                    rows.append((
                        _number(head.get("warc-record-id")),
                        head.get("warc-target-uri"),
                        kind,
                        block if payloads and kind == "response" else None,
                        size,
                        digest,
                        _number(head.get("warc-refers-to")),
                    ))
                    held += len(block) if payloads else 0
                    if held > 8 << 20:
                        cols = list(zip(*rows, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(cols, types, strict=True)], schema=schema
                        )
                        rows, held = [], 0
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], schema=schema
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the pages as a deduplicated archive, read it back, one row per page."""
    path = scratch_path(spark, "warc")
    write_archive(resolve_revisits(response_records(table(spark, sf_dir, "pages"))), path)
    return read_archive(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(strlen(html), 0) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
