"""What runs have done, step by step, so that a run that failed goes on where it stopped.

A run has a key made of its delivery (path, size and time of every source file) and its settings. Its start and each finished step
are appended to the ledger at once, with the number of the manifest it left. The next run skips what the last one finished if
that one has the same key, did not come to its end, and nobody has committed anything since.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "run string, key string, step string, place int, status string, manifest bigint, recorded_at timestamp"
STARTED, OK, SKIPPED, FAILED = "STARTED", "OK", "SKIPPED", "FAILED"
ROUNDS = 100_000


def delivery_key(spark: SparkSession, paths: Sequence[str], settings: Mapping[str, object], salt: str) -> str | None:
    """The key of a run; None if a source is not there, and then no earlier run counts.

    The files are listed and summed up by Spark, whatever their number; their content is not read. The salt is in the
    key by a slow hash, so that the ledger doesn't give it away.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        mark = F.xxhash64("path", "length", "modificationTime")
        files = listed.load(list(paths)).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("marks")).first()
    except AnalysisException:
        return None
    text = json.dumps([files["n"], files["marks"], sorted(paths), sorted((k, str(v)) for k, v in settings.items())])
    return hashlib.pbkdf2_hmac("sha256", text.encode(), salt.encode(), ROUNDS).hex()


def read_ledger(spark: SparkSession, root: str) -> DataFrame | None:
    """All entries; None before the first run."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{root}/run_ledger")
    except AnalysisException:
        return None


def note(spark: SparkSession, root: str, run: str, key: str | None, place: int, step: str, status: str, manifest: int) -> None:
    """Append one entry."""
    row = (run, key, step, place, status, manifest, datetime.now(UTC))
    spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(f"{root}/run_ledger")


def finished_steps(spark: SparkSession, root: str, key: str | None, steps: Sequence[str], manifest: int) -> int:
    """How many of the first steps need not run again."""
    ledger = read_ledger(spark, root)
    if key is None or ledger is None:
        return 0
    last = ledger.agg(F.max_by("run", F.struct("recorded_at", "place"))).scalar()
    entries = ledger.filter(F.col("run") == last).orderBy("place").collect()  # one per step of one run
    done = [e for e in entries if e["status"] in (OK, SKIPPED)]
    if not done or any(e["key"] != key for e in entries) or done[-1]["manifest"] != manifest:
        return 0
    in_order = [e["step"] for e in done] == list(steps[: len(done)])
    return len(done) if in_order and len(done) < len(steps) else 0
