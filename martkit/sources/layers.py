"""Parquet layers: partitioned writes, schema-checked reads, named tables and views."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.session import scratch_path


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("year", "month"),
    cluster: bool = False,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write Parquet folders ``year=2024/month=01``; only the folders present in df are replaced.

    Rows that come month by month are written where they are. ``cluster`` is for rows in mixed order,
    where every task would open a file in every folder: they are first brought together by folder, and
    adaptive execution splits a folder that holds most of the rows over several tasks and files.
    ``derive`` makes the rows to write, row by row, of those brought together and sorted by folder, so that only
    what they are made of is shuffled and sorted. It must leave the folder columns as they are.
    """
    ready = df
    if "month" in by:
        ready = df.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    if cluster:
        ready = ready.hint("rebalance", *[F.col(c) for c in by])
    if derive is not None:
        ready = derive(ready.sortWithinPartitions(*by))
    (
        ready.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_month(df: DataFrame, root: str, month: str) -> None:
    """Replace the folder ``root/year=2024/month=01`` by df, also when df has no row."""
    year, number = month.split("-")
    plain = df.drop("year", "month")
    place = f"{root}/year={int(year)}/month={int(number):02d}"
    plain.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(place)


#: Spark's setting that removes a query's shuffle files when it ends, instead of when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, keep_shuffles: bool = True) -> DataFrame:
    """Write df once to the shared folder and continue from the file.

    Cuts the lineage like ``checkpoint`` does, but runs the plan once instead of twice and leaves columns
    that can be read one by one. A lost executor costs nothing that was stored. Without ``keep_shuffles`` the shuffle
    files of the write are removed as soon as it has ended.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    if not keep_shuffles:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if not keep_shuffles:
            spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read a Parquet tree of any depth, columns by name, folder columns included.

    With a schema nothing is inferred: files narrower than declared are widened, columns a file lacks
    are null, and letter case does not matter. Without one, file schemas are merged by name.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read every Parquet file below a folder whose sub-folders carry no meaning."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def register_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, partitioned_by: Sequence[str] = ()
) -> None:
    """Declare an external table with a fixed schema over a Parquet folder, creating its database."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    folders = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{folders} LOCATION '{location}'")
    if partitioned_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def build_table(
    spark: SparkSession, name: str, df: DataFrame, path: str, replace: bool = True
) -> DataFrame:
    """Store a query result as Parquet under path and name it; returns the stored table.

    With ``replace`` an older table of that name is dropped and its folder overwritten; without it an
    existing table is an error.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    mode = "overwrite" if replace else "errorifexists"
    df.write.mode(mode).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def register_views(spark: SparkSession, sources: Mapping[str, DataFrame]) -> None:
    """Give each DataFrame a name usable in ``spark.sql``."""
    for name, df in sources.items():
        df.createOrReplaceTempView(name)


# --- months ----------------------------------------------------------------------------------------


def parse_months(text: str) -> list[str]:
    """``"2024-01, 2024-02"`` to a list; blanks are dropped."""
    return [m.strip() for m in text.split(",") if m.strip()]


def month_spans(months: DataFrame, column: str = "months") -> DataFrame:
    """Rows of comma-separated month lists to one row per month with its first and last day."""
    month = F.explode(F.split(F.col(column), ",")).alias("month")
    first = F.to_date(F.concat("month", F.lit("-01")))
    return (
        months.select(month)
        .select(F.trim("month").alias("month"))
        .filter(F.col("month") != "")
        .select("month", first.alias("first_day"), F.last_day(first).alias("last_day"))
    )


def for_months(df: DataFrame, months: Sequence[str]) -> DataFrame:
    """Keep some months of a layer foldered by year and month; the scan lists only those folders."""
    wanted: dict[int, list[str]] = {}
    for m in months:
        year, month = m.split("-")
        wanted.setdefault(int(year), []).append(f"{int(month):02d}")
    folder = F.lit(False)
    for year, numbers in sorted(wanted.items()):
        folder = folder | ((F.col("year") == year) & F.col("month").isin(numbers))
    return df.filter(folder)


# --- row counts ------------------------------------------------------------------------------------


def layer_counts(spark: SparkSession, layers: Mapping[str, str | Callable[[], DataFrame | None]]) -> DataFrame:
    """Rows per layer, ``{name: path}`` or ``{name: function that reads it}``; a layer that is not there (None), or can't
    be read, counts as null."""
    counts = []
    for name, layer in layers.items():
        try:
            found = layer() if callable(layer) else spark.read.parquet(layer)
            rows = found.count() if found is not None else None
        except (AnalysisException, PySparkException, Py4JJavaError):
            rows = None
        counts.append((name, rows))
    return spark.createDataFrame(counts, "layer string, row_count bigint")
