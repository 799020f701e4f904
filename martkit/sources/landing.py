"""Landing of source files in the raw layer."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from martkit.functions.portable import nan_to_null
from martkit.functions.privacy import pseudonymize, synthetic_subject
from martkit.sources.layers import read_layer, stored, write_month
from martkit.sources.schemas import RAW_ZONES, TRIP_SOURCE, WEATHER_DOCUMENT

# Texts a CSV cell may hold for "missing".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Footers that one task reads.
FOOTERS_PER_TASK = 64
# Fixed value: where Spark keeps the schema of what it wrote in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

#: Which salt the pseudonyms of a landed row were made with.
KEY_VERSION = "_key_version"

# Source header to table column.
ZONE_HEADER = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone_name",
    "service_zone": "service_zone",
}


def with_lineage(df: DataFrame, source: str | Column | None = None) -> DataFrame:
    """Add when a row was landed and from which file.

    Without a source the file name comes from the scan itself, so df must then read files directly.
    """
    origin = F.col("_metadata.file_name") if source is None else source
    if isinstance(origin, str):
        origin = F.lit(origin)
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source_file": origin})


def _with_row_numbers(groups: list[DataFrame]) -> list[DataFrame]:
    """Add ``_source_file`` and ``_source_row``: the row's number in its file plus the rows of all files before it.

    One rule for any layout: the rows of a month get the same numbers whether they come in one file or in several
    named in order. The rows per file are counted first; that table has a row per file of one month's delivery, whose
    list the driver holds anyway, and is sent along, so the rows themselves aren't shuffled.
    """
    path = F.col("_metadata.file_path").alias("_path")
    files = union_by_name([g.groupBy(path).agg(F.count(F.lit(1)).alias("_rows")) for g in groups])
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(files.select("_path", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    name, index = F.col("_metadata.file_name").alias("_source_file"), F.col("_metadata.row_index").alias("_index")
    row = (F.col("_start") + F.col("_index")).alias("_source_row")
    return [
        g.select("*", path, name, index).join(starts, "_path").select("*", row).drop("_path", "_index", "_start")
        for g in groups
    ]


def _footer_mark(path: str) -> str | None:
    """What a Parquet file's footer says of its columns; None if this worker can't open the file by itself."""
    try:
        system, place = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        with system.open_input_file(place) as file:
            footer = pq.read_metadata(file)
    except (OSError, ValueError, NotImplementedError):  # no such file system here, no credentials, unusual names
        return None
    columns = [(c.path, c.physical_type, str(c.logical_type), c.max_definition_level, c.max_repetition_level)
               for c in map(footer.schema.column, range(footer.num_columns))]
    return repr([columns, (footer.metadata or {}).get(SPARK_SCHEMA)])


def _footer_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("path").to_pylist()
        yield pa.RecordBatch.from_pydict({"path": paths, "mark": pa.array([_footer_mark(p) for p in paths], pa.string())})


def _by_footer(spark: SparkSession, src: str) -> list[DataFrame]:
    """The files of a month, grouped by the columns in their footers, which differ where a column's width drifted.

    Footers are read in tasks. Files that workers can't open without Spark have their schemas read through Spark, one
    after the other, which is slower and gives the same groups or coarser ones.
    """
    whole = spark.read.parquet(src)
    files = whole.inputFiles()  # those of one month's delivery
    if len(files) == 1:
        return [whole]
    paths = spark.createDataFrame([(f,) for f in files], "path string").repartition(-(-len(files) // FOOTERS_PER_TASK))
    groups: dict[str, list[str]] = {}
    for path, mark in sorted(paths.mapInArrow(_footer_marks, "path string, mark string").collect(), key=lambda r: r["path"]):
        groups.setdefault(spark.read.parquet(path).schema.json() if mark is None else mark, []).append(path)
    return [whole] if len(groups) == 1 else [spark.read.parquet(*paths) for paths in groups.values()]


def _declared(found: DataFrame) -> DataFrame:
    """Declared names and widths first, columns beyond them as they are; declared ones it lacks are null."""
    lineage = [c for c in found.columns if c.startswith("_source_")]
    have = {c.lower(): c for c in found.columns if c not in lineage}
    declared = [
        (F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TRIP_SOURCE.fields
    ]
    known_names = {f.name for f in TRIP_SOURCE.fields}
    extras = [F.col(c).alias(low) for low, c in have.items() if low not in known_names]
    return found.select(*declared, *extras, *lineage)


def read_trip_source(spark: SparkSession, src: str) -> DataFrame:
    """Read one month as delivered and give it the declared names and widths, ``_source_file`` and ``_source_row``.

    Each file is read with the schema of its own footer and cast, which covers drift of width or letter case
    between months and between the files of a month.
    """
    return union_by_name([_declared(g) for g in _with_row_numbers(_by_footer(spark, src))])


def land_trips(
    spark: SparkSession,
    src: str,
    root: str,
    month: str,
    salt: str,
    domain: str = "example.test",
    key_version: int | None = None,
) -> int:
    """Land one month of trips under ``root/year=/month=`` and return how many rows were written.

    Adds the invented subject of each trip (fixed by its row number), its pseudonym and the lineage. The month's
    folder is replaced, also by a delivery without rows. The count is observed while the rows are written. Where salts
    are changed from time to time, ``key_version`` says which one this is; the month keeps it as ``_key_version``.
    """
    trips = nan_to_null(read_trip_source(spark, src))
    trips = trips.withColumn("driver_email", synthetic_subject("_source_row", domain))
    trips = trips.withColumn("driver_pseudo", pseudonymize("driver_email", salt))
    if key_version is not None:
        trips = trips.withColumn(KEY_VERSION, F.lit(key_version).cast("int"))
    landed = with_lineage(trips, F.col("_source_file"))
    written = Observation(f"land_trips_{month}")
    write_month(landed.observe(written, F.count(F.lit(1)).alias("rows")), root, month)
    return written.get["rows"]


def rekey_month(spark: SparkSession, root: str, month: str, salt: str, key_version: int) -> int:
    """Give a landed month the pseudonyms of another salt, from the clear identifiers beside them; returns its rows.

    Only this month is read and written. The other columns, extra ones included, stay as they are.
    """
    year, number = month.split("-")
    place = f"{root}/year={int(year)}/month={int(number):02d}"
    trips = spark.read.parquet(place).withColumns(
        {"driver_pseudo": pseudonymize("driver_email", salt), KEY_VERSION: F.lit(key_version).cast("int")}
    )
    written = Observation(f"rekey_{month}")
    # Stored first: a folder can't be replaced by what is being read from it.
    write_month(stored(trips.observe(written, F.count(F.lit(1)).alias("rows")), "rekeyed"), root, month)
    return written.get["rows"]


def key_versions(spark: SparkSession, root: str) -> DataFrame:
    """Which salts the landed months have: year, month, key_version (null: landed without one), rows."""
    trips = read_layer(spark, root, f"driver_pseudo string, {KEY_VERSION} int, year int, month string")
    rows = F.count(F.lit(1)).alias("rows")
    return trips.groupBy("year", "month", F.col(KEY_VERSION).alias("key_version")).agg(rows)


def load_zones(spark: SparkSession, path: str) -> DataFrame:
    """Read the zone CSV: header row, cells that mean "missing" to null, table column names."""
    raw = spark.read.option("header", "true").csv(path)
    missing = list(NULL_TOKENS)
    cleaned = raw.select(
        *[F.when(~F.col(c).isin(missing), F.col(c)).alias(c) for c in raw.columns]
    ).withColumnsRenamed(ZONE_HEADER)
    return cleaned.select(*[F.col(f.name).cast(f.dataType) for f in RAW_ZONES.fields])


def land_zones(spark: SparkSession, src: str, path: str) -> int:
    """Land the whole zone table again, replacing the old one."""
    written = Observation("land_zones")
    zones = load_zones(spark, src).observe(written, F.count(F.lit(1)).alias("rows"))
    zones.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return written.get["rows"]


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    """Read weather documents, each an object of parallel arrays, as one row per day."""
    days = F.arrays_zip(*[F.col(f"daily.{f.name}") for f in WEATHER_DOCUMENT["daily"].dataType.fields])
    docs = spark.read.schema(WEATHER_DOCUMENT).option("multiLine", "true").json(path)
    return docs.select(F.inline(days)).withColumnRenamed("time", "weather_date")


def land_weather(spark: SparkSession, src: str, root: str, month: str) -> int:
    """Land one month of daily weather under ``root/year=/month=``; that folder is replaced."""
    written = Observation(f"land_weather_{month}")
    days = nan_to_null(load_weather(spark, src))
    write_month(days.observe(written, F.count(F.lit(1)).alias("rows")), root, month)
    return written.get["rows"]


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """One table from frames whose columns match by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
