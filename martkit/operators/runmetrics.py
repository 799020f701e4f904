"""Numbers about a run, taken while it runs."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRIC_SCHEMA = "name string, value double, tags map<string,string>, recorded_at timestamp"
STEP_SCHEMA = "step string, status string, attempts int, seconds double"


class Observed:
    """A DataFrame whose row count (and further aggregates) become known when an action runs on it."""

    def __init__(self, df: DataFrame, name: str, tags: dict[str, str], **more: Column):
        self._watch = Observation(name)
        extra = [expr.alias(key) for key, expr in more.items()]
        self.df = df.observe(self._watch, F.count(F.lit(1)).alias("rows"), *extra)
        self.name, self.tags = name, tags

    @property
    def values(self) -> dict:
        """Blocks until the first action on ``df`` has finished."""
        return self._watch.get

    @property
    def rows(self) -> int:
        return self.values["rows"]


def observed(df: DataFrame, name: str, **tags: str) -> Observed:
    """Count the rows of df while a later action runs over it; no job of its own."""
    return Observed(df, name, {k: str(v) for k, v in tags.items()})


def append_metrics(spark: SparkSession, path: str, metrics: list[tuple[str, float, dict]]) -> None:
    """Append (name, value, tags) records to the metrics table, stamped with the current time."""
    now = datetime.now(UTC)
    rows = [(name, float(value), tags, now) for name, value, tags in metrics]
    spark.createDataFrame(rows, METRIC_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run_report(steps: DataFrame, counts: DataFrame) -> DataFrame:
    """One nested row: total seconds, error rate as ``failed/all``, the steps, and rows per layer."""
    failed = F.count_if(F.col("status") == "FAILED").cast("string")
    summary = steps.agg(
        F.round(F.sum("seconds"), 1).alias("total_seconds"),
        F.concat(failed, F.lit("/"), F.count(F.lit(1)).cast("string")).alias("error_rate"),
        F.collect_list(F.struct("step", "status", "attempts", "seconds")).alias("steps"),
    )
    layers = counts.agg(F.map_from_entries(F.collect_list(F.struct("layer", "row_count"))))
    return summary.withColumn("rows_per_layer", layers.scalar())
