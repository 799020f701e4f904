"""The row-quality rules of the clean layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.portable import minutes_between


def quality_rules(minutes: str = "boundary") -> dict[str, Column]:
    """Rule name to condition over the raw trip columns. An unknown (null) condition rejects the row."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return {
        "pickup_present": pickup.isNotNull(),
        "dropoff_after_pickup": dropoff > pickup,
        "distance_above_0": F.col("trip_distance") > 0,
        "distance_below_200": F.col("trip_distance") < 200,
        "fare_not_negative": F.col("fare_amount") >= 0,
        "total_not_negative": F.col("total_amount") >= 0,
        "passengers_1_to_8": F.col("passenger_count").between(1, 8),
        "duration_1_to_240": minutes_between(pickup, dropoff, minutes).between(1, 240),
    }


def clean_trips(trips: DataFrame, minutes: str = "boundary") -> DataFrame:
    """Keep the trips that meet every rule; the comparisons reach the Parquet scan."""
    return trips.filter(reduce(lambda a, b: a & b, quality_rules(minutes).values()))


def rejected_rows(trips: DataFrame, minutes: str = "boundary") -> DataFrame:
    """Rows each rule rejects (a row can break several), in one pass over the trips."""
    rules = quality_rules(minutes)
    counts = trips.agg(
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()]
    )
    return counts.unpivot([], list(rules), "rule", "rejected")
