import gzip
import hashlib

import llm_tables as T
import pytest

from basketry.llm import warc
from basketry.session import scratch_path

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (1, "u\r\nx", "a" * 200),
    (2, None, "a" * 200),
    (2, "again", "a" * 200),  # a repeated id
    (3, "u", None),
    (4, "u", "b" * 99),  # too short to be a revisit
    (5, "u", "b" * 99),
    (6, "u", "é" * 50),  # 100 bytes
    (7, "u", "é" * 50),
    (8, "q", "WARC/1.0\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\nhéllo\r\n\r\n" * 5),
    (9, "", ""),
    (10, "long", "z" * 3_000_000),
    (None, "n", "a" * 200),
]


@pytest.fixture()
def archive(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' AS payload", "'y' AS __key")
    path = scratch_path(spark, "warc-test")
    warc.write_archive(warc.resolve_revisits(warc.response_records(df)), path)
    return path


def test_round_trip_and_revisits(spark, archive):
    got = warc.read_archive(spark, archive).collect()
    assert len(got) == len(ROWS)
    want = {1: None, 2: 1, 3: None, 4: None, 5: None, 6: None, 7: 6, 8: None, 9: None, 10: None}
    html = {i: (h or "").encode() for i, _, h in ROWS}
    for r in got:
        first = 1 if r.page_id is None else want[r.page_id]
        assert r.refers_to == first
        assert r.record_type == ("revisit" if first else "response")
        assert r.payload_bytes == len(html[r.page_id])
        assert r.payload_digest == hashlib.sha256(html[r.page_id]).hexdigest()
        assert r.payload == (None if first else html[r.page_id])
    assert {r.url for r in got if r.page_id == 1} == {"u%0Ax"}


def test_files_are_plain_archives(spark, archive):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(archive)
    text = b"".join(gzip.decompress(bytes(r.content)) for r in files.collect())
    assert text.startswith(b"WARC/1.0\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")
    assert text.count(b"\r\nWARC-Type: revisit\r\n") == 4


def test_old_revisits_are_joined_to_their_originals(spark):
    records = spark.createDataFrame(
        [
            (5, "a", "revisit", None, 300, "ab", None),
            (3, "b", "response", bytearray(b"x" * 300), 300, "ab", None),
            (9, "c", "revisit", None, 300, "cd", 77),
        ],
        warc.RECORD,
    )
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.resolve_revisits(records).collect()}
    assert got == {5: ("revisit", 3), 3: ("response", None), 9: ("revisit", 77)}


def test_empty(spark):
    path = scratch_path(spark, "warc-test")
    none = spark.createDataFrame([], SCHEMA)
    warc.write_archive(warc.resolve_revisits(warc.response_records(none)), path)
    assert warc.read_archive(spark, path).count() == 0
    assert T.empty(spark).count() == 0


def test_short_payloads_are_spread_and_stay_responses(spark):
    """Most payloads are short: they share no join key, whatever the join."""
    rows = [(i, f"http://x/{i}", "s" if i % 3 else "l" * 200) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        resolved = warc.resolve_revisits(warc.response_records(pages))
        got = {r.page_id: (r.record_type, r.refers_to) for r in resolved.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for i, _, _ in rows:
        assert got[i] == (("revisit", 0) if i % 3 == 0 and i else ("response", None))
