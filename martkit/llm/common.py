"""Small things several of these operators share: text columns, word splitting, files in a shared folder."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as white space between words: space, tab, line feed, vertical tab, form feed, return.
WHITESPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_LIBC = ctypes.CDLL(None)


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """True for rows no model may learn from: crc32 of the id as text, modulo 4, is 2 (null id: learned from)."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batch: pa.RecordBatch, column: str, budget: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``budget`` bytes in one column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > budget:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def release_memory() -> None:
    """Give what Arrow and the C library keep of freed memory back, so that a worker between batches holds little."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def frequent_floor(counts: DataFrame, column: str, most: int) -> int:
    """The smallest power of two that at most ``most`` rows reach with this column of positive counts.

    So a table of the most frequent rows has a size that is known before it is sent anywhere.
    """
    sizes = counts.groupBy(F.length(F.bin(column)).alias("bits")).agg(F.count(F.lit(1)).alias("n")).collect()
    rows, bits = 0, 63
    for b, n in sorted(((r["bits"], r["n"]) for r in sizes), reverse=True):  # at most 63 rows
        if rows + n > most:
            break
        rows, bits = rows + n, b
    else:
        return 1
    return 1 << (bits - 1) if rows else 1 << 62


# --- files that tasks write and read themselves ------------------------------------------------------


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the path inside it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path)


def new_file(folder: str, suffix: str) -> tuple[str, pafs.FileSystem, str]:
    """A path below folder that no other task attempt uses: (path as given to readers, file system, inner path).

    A failed or repeated attempt leaves a file that no manifest names, so readers never see it.
    """
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    system, inner = file_system(path)
    system.create_dir(os.path.dirname(inner), recursive=True)
    return path, system, inner
