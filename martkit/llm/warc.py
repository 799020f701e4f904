"""WARC archives as a chunked record table, both ways.

A record is never held in one piece by a Python task. ``record_chunks`` turns each payload into rows
(record number, chunk number, bytes), ``write_archives`` streams those rows into gzip members of WARC 1.1 files,
and ``read_archives`` streams the files back as rows (record id, chunk number, bytes so far, SHA-1 so far):
each chunk row carries the digest of its record up to and with that chunk, so the last one has it whole.

Files go below the shared folder under names no other task attempt uses; the manifest, written by Spark, names
those of the tasks that succeeded, and the runs of records inside each file that one reading task takes. So a
lost executor costs only its own tasks, and a large archive is read by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import file_system, new_file
from martkit.session import scratch_path
from martkit.sources.layers import stored

CHUNK_BYTES = 64 * 1024
#: Payloads shorter than this are stored again rather than referred to.
LEAST_SHARED = 1000
FILE_BYTES = 256 * 1024 * 1024
RUN_BYTES = 16 * 1024 * 1024
#: Fixed values of the WARC format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, start long, end long, records long"
CHUNKS = (
    "record_id string, page_id long, url string, record_type string, refers_to long, chunk int, chunk_bytes int, "
    "bytes_so_far long, sha1_so_far string, last boolean, payload_bytes long, payload_digest string, intact boolean"
)


def _record_id(page: Column) -> Column:
    return F.when(page.isNotNull(), F.concat(F.lit("urn:page:"), page.cast("string")))


def with_revisits(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Add payload (null: empty), payload_bytes, payload_digest, record_type and refers_to.

    Of rows with equal payloads of at least ``least`` bytes that with the largest page_id is the response and
    the others revisit it; rows that repeat this page_id, and all shorter payloads, are responses. The largest
    page_id of each digest is found from numbers and digests alone, combined per task; the join back is one
    that adaptive execution splits where a digest is frequent.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select("page_id", "url", payload.alias("payload"))
    full = full.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")})
    shared = (
        full.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull())
        .drop("n")
    )
    again = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return full.join(shared, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def record_chunks(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of each record's block, in order: header columns, chunk, chunks, data.

    A record without a block has one empty chunk. Only the first row of a record carries its url.
    """
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    chunks = F.greatest(F.ceil(F.octet_length("block") / chunk_bytes).cast("int"), F.lit(1))
    piece = F.substring("block", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    return (
        records.withColumn("block", block)
        .withColumn("chunks", chunks)
        .withColumn("block_bytes", F.octet_length("block").cast("bigint"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "page_id", _record_id(F.col("page_id")).alias("record_id"), F.when(F.col("chunk") == 0, F.col("url")).alias("url"),
            "record_type", "refers_to", _record_id(F.col("refers_to")).alias("refers_to_id"), "payload_bytes",
            "payload_digest", "block_bytes", "chunk", "chunks", piece.alias("data"),
        )
    )


def _header(row: dict, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id'] or 'urn:page:'}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        # An extension field: a revisit has no block, and its length is wanted without its response.
        ("Payload-Length", str(row["payload_bytes"])),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(row["block_bytes"])),
    ]
    if row["record_type"] == "revisit":
        fields[5:5] = [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{row['refers_to_id']}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + lines + b"\r\n"


def write_archives(chunks: DataFrame, folder: str, file_bytes: int = FILE_BYTES, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Write chunk rows (records whole and in order within a partition) and return the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        out, path, at, start, records, packer, found = None, "", 0, 0, 0, None, []
        for batch in batches:
            names = [c for c in batch.schema.names if c != "data"]
            heads = batch.select(names).to_pylist()
            data = batch.column("data")
            for i, row in enumerate(heads):
                if row["chunk"] == 0:
                    if out is None:
                        path, system, inner = new_file(folder, ".warc.gz")
                        out, at, start, records = system.open_output_stream(inner, compression=None), 0, 0, 0
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    at += out.write(packer.compress(_header(row, date)))
                at += out.write(packer.compress(data[i].as_buffer()))
                if row["chunk"] == row["chunks"] - 1:
                    at += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    records += 1
                    if at - start >= run_bytes or at >= file_bytes:
                        found.append((path, start, at, records))
                        start, records = at, 0
                    if at >= file_bytes:
                        out.close()
                        out = None
        if out is not None:
            out.close()
            if records:
                found.append((path, start, at, records))
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "start", "end", "records"), x, strict=True)) for x in found],
                                         schema=pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("records", pa.int64())]))

    return stored(chunks.mapInArrow(write, MANIFEST), "warc-manifest")


class _Members:
    """Reads bytes across the gzip members of one run of a file, a bounded piece at a time."""

    def __init__(self, stream, length: int, piece: int = 1 << 15):
        self.stream, self.rest, self.piece = stream, length, piece
        self.raw, self.ready, self.unpacker = b"", bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.unpacker.eof:
            self.raw, self.unpacker = self.unpacker.unused_data, zlib.decompressobj(31)
        if not self.raw:
            if not self.rest:
                return False
            self.raw = self.stream.read(min(self.piece, self.rest))
            self.rest -= len(self.raw)
            if not self.raw:
                raise EOFError("the archive ends inside a run of records")
        self.ready += self.unpacker.decompress(self.raw)
        self.raw = b""
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None after the last record."""
        while (end := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                return None
        out = bytes(self.ready[:end])
        del self.ready[: end + 2]
        return out

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise EOFError("the archive ends inside a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def _page(ref: str | None) -> int | None:
    number = (ref or "").strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _records(path: str, start: int, end: int, chunk_bytes: int) -> Iterator[dict]:
    system, inner = file_system(path)
    with system.open_input_file(inner) as stream:
        stream.seek(start)
        members = _Members(stream, end - start)
        while (line := members.line()) is not None:
            if line != VERSION:
                raise ValueError(f"no WARC record where one should start in {path}")
            head = {}
            while line := members.line():
                name, _, value = line.decode().partition(": ")
                head[name] = value
            left, chunk, seen, digest = int(head["Content-Length"]), 0, 0, hashlib.sha1(usedforsecurity=False)
            whole = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            while True:
                data = members.take(min(chunk_bytes, left))
                left -= len(data)
                seen += len(data)
                digest.update(data)
                row = {
                    "record_id": head["WARC-Record-ID"].strip("<>"), "page_id": _page(head["WARC-Record-ID"]),
                    "url": head["WARC-Target-URI"] or None, "record_type": head["WARC-Type"],
                    "refers_to": _page(head.get("WARC-Refers-To")), "chunk": chunk, "chunk_bytes": len(data),
                    "bytes_so_far": seen, "sha1_so_far": digest.hexdigest(), "last": not left,
                    "payload_bytes": None, "payload_digest": None, "intact": None, "data": data,
                }
                if not left:
                    has_block = head["WARC-Type"] != "revisit"
                    row["payload_bytes"] = seen if has_block else int(head["Payload-Length"])
                    row["payload_digest"] = row["sha1_so_far"] if has_block else whole
                    row["intact"] = not has_block or row["sha1_so_far"] == whole
                yield row
                chunk += 1
                if not left:
                    break
            if members.take(4) != b"\r\n\r\n":
                raise ValueError(f"a record of {path} doesn't end where its length says")


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = False) -> DataFrame:
    """The chunk rows of all records of a manifest, in order within a record.

    The last chunk of a record has payload_bytes, payload_digest and intact (its digest is that of the header);
    for a revisit, which has no block, length and digest are those its header states. With ``with_data`` each
    row carries its bytes.
    """
    schema = CHUNKS + (", data binary" if with_data else "")
    fields = [f.strip().rpartition(" ") for f in schema.split(",")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    arrow = pa.schema([(name, kinds[kind]) for name, _, kind in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                held, size = [], 0
                for row in _records(run["path"], run["start"], run["end"], chunk_bytes):
                    size += row["chunk_bytes"]
                    if not with_data:
                        del row["data"]
                    held.append(row)
                    if len(held) >= 2000 or size >= 64 * chunk_bytes:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(spread, "path", "start").mapInArrow(read, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) and return the manifest.

    Handles null ids (the record id has no number), null urls and null or empty html; an empty table writes
    no file. Columns beyond these three are not archived.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return write_archives(record_chunks(with_revisits(pages), chunk_bytes), folder)
