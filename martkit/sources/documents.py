"""JSON in and out: result rows and the model metrics document."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.sources.schemas import ML_METRICS

# Fixed value: the error text when no metrics were written yet.
NO_METRICS = "métriques non disponibles — lancer la pipeline ML d'abord"


def to_json_rows(df: DataFrame, path: str | None = None) -> DataFrame:
    """Each row as one JSON object, nulls included; also written as text files if a path is given.

    The files are in row order within each partition, so a sorted df reads back sorted.
    """
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    if path is not None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").text(path)
    return rows


def write_metrics(df: DataFrame, path: str) -> None:
    """Write the one-row metrics document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Read the metrics document, or one row with an ``error`` column when there is none."""
    try:
        found = spark.read.schema(ML_METRICS).json(path)
        if not found.isEmpty():
            return found
    except AnalysisException:
        pass
    return spark.range(1).select(F.lit(NO_METRICS).alias("error"))
