"""Archives: round trip, revisits, chunks with running digests, archives over several runs."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from martkit.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    long, longer = "é" * 700, "<p>\r\n\r\nWARC/1.1\r\n" * 20_000
    rows = [(1, "u1", long), (2, "u\n2", long), (5, None, long), (3, "u3", "short"), (4, "u4", "short"), (6, "u6", None),
            (7, "u7", ""), (8, "u8", longer), (None, "u9", longer), (5, "again", long), (None, "u10", "null id")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("chunk", F.lit("clash"))


def test_round_trip(spark, pages, tmp_path):
    manifest = warc.archive_pages(pages, str(tmp_path), chunk_bytes=1000)
    rows = warc.read_archives(manifest, chunk_bytes=700, with_data=True).collect()
    last = [r for r in rows if r["last"]]
    assert len(last) == pages.count() and all(r.intact for r in last)
    source = {(p.page_id, (p.url or "").replace("\n", "%0A") or None): (p.html or "").encode() for p in pages.collect()}
    for r in last:
        payload = source[r.page_id, r.url]
        assert r.payload_bytes == len(payload) and r.payload_digest == hashlib.sha1(payload).hexdigest()
        shared = len(payload) >= 1000 and r.page_id != (5 if payload.startswith("é".encode()) else 8)
        assert r.record_type == ("revisit" if shared else "response")
        assert r.refers_to == ((5 if payload.startswith("é".encode()) else 8) if shared else None)
    whole = sorted((r for r in rows if r.url == "u8"), key=lambda r: r.chunk)
    assert b"".join(bytes(r.data) for r in whole) == source[8, "u8"] and len(whole) > 300
    seen = b""
    for r in whole:
        seen += bytes(r.data)
        assert len(r.data) <= 700 and r.bytes_so_far == len(seen) and r.sha1_so_far == hashlib.sha1(seen).hexdigest()


def test_files_are_plain_warc(spark, pages, tmp_path):
    warc.archive_pages(pages.filter("page_id = 3"), str(tmp_path))
    [file] = tmp_path.glob("*.warc.gz")
    head, _, block = gzip.decompress(file.read_bytes()).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1" and "Content-Length: 5" in lines and "WARC-Type: response" in lines
    digest = base64.b32encode(hashlib.sha1(b"short").digest()).decode()
    assert f"WARC-Payload-Digest: sha1:{digest}" in lines and block == b"short\r\n\r\n"


def test_runs_and_files(spark, tmp_path):
    """Small limits: several files, several runs in each, and all records found again."""
    pages = spark.range(200).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(CAST(id AS STRING), 256), 50) AS html")
    chunks = warc.record_chunks(warc.with_revisits(pages).repartition(2), 999)
    manifest = warc.write_archives(chunks, str(tmp_path), file_bytes=10_000, run_bytes=2_000)
    assert manifest.select("path").distinct().count() > 2 and manifest.count() > 8
    assert warc.read_archives(manifest).filter("last AND intact").select("page_id").distinct().count() == 200


def test_damage_is_seen(spark, pages, tmp_path):
    manifest = warc.archive_pages(pages.filter("page_id = 8"), str(tmp_path)).withColumn("end", F.col("end") - 40)
    with pytest.raises(Exception, match="archive ends"):
        warc.read_archives(manifest).collect()


def test_no_pages(pages, tmp_path):
    assert warc.read_archives(warc.archive_pages(pages.limit(0), str(tmp_path))).count() == 0
