"""Left joins of trips to their dimensions.

None of the joins carries a broadcast hint. Dimensions are landed Parquet tables, so Spark knows their
size from the files and broadcasts one only while it stays below ``spark.sql.autoBroadcastJoinThreshold``;
the trips then never move. A dimension beyond that is joined by shuffle, where adaptive execution splits
the partitions of hot keys on the trips side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A dimension holds several rows for one key, so joining it would multiply trips."""


def assert_unique_key(dim: DataFrame, key: str) -> DataFrame:
    """Return dim, or raise if one of its non-null keys repeats."""
    repeated = (
        dim.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1).collect()
    )
    if repeated:
        raise DuplicateKeyError(f"{key}={repeated[0][0]!r} occurs {repeated[0][1]} times")
    return dim


def with_zone(trips: DataFrame, zones: DataFrame, key: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_borough`` and ``<prefix>_zone`` of the location in ``key``; unmatched trips stay."""
    side = zones.select(
        F.col("location_id").alias("_location"),
        F.col("borough").alias(f"{prefix}_borough"),
        F.col("zone_name").alias(f"{prefix}_zone"),
    )
    return trips.join(side, F.col(key) == F.col("_location"), "left").drop("_location")


def with_daily(trips: DataFrame, daily: DataFrame, ts: str, date: str) -> DataFrame:
    """Add the columns of a daily table for the calendar day of ``ts``; ``date`` may be text."""
    values = [c for c in daily.columns if c != date]
    side = daily.select(F.col(date).cast("date").alias("_day"), *values)
    return trips.join(side, F.to_date(ts) == F.col("_day"), "left").drop("_day")


def enrich(trips: DataFrame, zones: DataFrame, weather: DataFrame) -> DataFrame:
    """Pickup zone, dropoff zone and weather of the pickup day for every trip."""
    placed = with_zone(trips, zones, "pulocationid", "pu")
    placed = with_zone(placed, zones, "dolocationid", "do")
    daily = weather.select(
        "weather_date", "temperature_2m_mean", "temperature_2m_max", "precipitation_sum"
    )
    return with_daily(placed, daily, "tpep_pickup_datetime", "weather_date")
