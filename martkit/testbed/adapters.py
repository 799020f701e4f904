"""The raw layer derived from the driver tables, and the layers above it.

No trip data comes with the project, so trips, zones and weather are derived from the driver tables by
arithmetic that Spark and the oracle engine evaluate alike. Like any raw layer they are landed first, as
Parquet in the shared folder, once per session and data folder: trips in year and month folders, as the
real ones are. Every query then reads pruned columns, filters and months from files, and a dimension has
a size Spark can read off its files before it decides to broadcast it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.privacy import pseudonymize, synthetic_subject
from martkit.plans.marts import demand_by_zone_hour, tips_analysis
from martkit.plans.pipeline import Sources
from martkit.plans.silver import build_silver
from martkit.session import scratch_path
from martkit.sources.landing import ZONE_HEADER
from martkit.sources.layers import read_layer, write_partitioned
from martkit.sources.schemas import RAW_WEATHER, RAW_ZONES

SALT = "testbed-salt"
DOMAIN = "example.test"


# The landed trips of the testbed: the columns the queries use, a unique key and the month folders.
TESTBED_TRIPS = (
    "vendorid int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, pulocationid int, dolocationid int, "
    "payment_type bigint, fare_amount double, tip_amount double, total_amount double, "
    "driver_email string, trip_key string, driver_pseudo string, year int, month string"
)
DRIVER_SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "nation": ("n_nationkey int, n_name string, n_regionkey int"),
    "region": ("r_regionkey int, r_name string"),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


#: The columns of lineitem that trips are derived from.
TRIP_BASE = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_shipdate",
)
MONTH = ("year", "month")


def _pickup() -> Column:
    second_of_day = (
        F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 3607 + F.col("l_partkey") * 13
    ) % 86400
    return F.timestamp_add("SECOND", second_of_day, F.col("l_shipdate"))


def _trip_key() -> Column:
    return F.concat_ws(
        ":",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("bigint"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint"),
    )


def _month_folders(line: DataFrame) -> DataFrame:
    """Add the folder columns of each trip's month."""
    return line.withColumns(
        {"year": F.year(_pickup()), "month": F.lpad(F.month(_pickup()).cast("string"), 2, "0")}
    )


def _as_trips(line: DataFrame, *more: str) -> DataFrame:
    """Raw trips of rows of lineitem with a unique ``trip_key``, and columns that are there already."""
    ride_seconds = (F.col("l_partkey") * 37 + F.col("l_suppkey") * 101) % 15600 - 300
    pickup = _pickup()
    free = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    fare = F.when(free, F.lit(0.0)).otherwise(F.col("l_extendedprice") / 1000.0 - 2.0)
    return line.select(
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("vendorid"),
        pickup.alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", ride_seconds, pickup).alias("tpep_dropoff_datetime"),
        F.when(F.col("l_quantity") != 50, F.col("l_quantity") % 10).alias("passenger_count"),
        ((F.col("l_quantity") - 1.0) * 4.1).alias("trip_distance"),
        (F.col("l_partkey") % 27).cast("int").alias("pulocationid"),
        (F.col("l_suppkey") % 26).cast("int").alias("dolocationid"),
        (F.col("l_linenumber") % 5 + 1).cast("bigint").alias("payment_type"),
        fare.alias("fare_amount"),
        (fare * F.col("l_discount")).alias("tip_amount"),
        (fare + fare * F.col("l_discount") + F.col("l_tax") * 10.0).alias("total_amount"),
        synthetic_subject("l_orderkey", DOMAIN).alias("driver_email"),
        _trip_key().alias("trip_key"),
        *more,
    )


def _with_pseudonym(line: DataFrame) -> DataFrame:
    """Trips of rows of lineitem that have their folder columns."""
    trips = _as_trips(line, "year", "month").withColumn("driver_pseudo", pseudonymize("driver_email", SALT))
    return trips.select(*[c for c in trips.columns if c not in MONTH], *MONTH)


def derive_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with a unique ``trip_key`` and the folder columns of their month."""
    return _with_pseudonym(_month_folders(driver_table(spark, sf_dir, "lineitem")))


def derive_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = driver_table(spark, sf_dir, "nation"), driver_table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone_name"),
        F.lit(None).cast("string").alias("service_zone"),
    )


def derive_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = driver_table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        (F.sum("o_custkey") % 400 / 10.0).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    return per_day.select(
        F.col("day").cast("string").alias("weather_date"),
        F.col("mean").alias("temperature_2m_mean"),
        (F.col("mean") + 5.0).alias("temperature_2m_max"),
        F.when(F.col("n") % 3 == 0, F.col("n") / 2.0).otherwise(F.lit(0.0)).alias("precipitation_sum"),
    )


def deliver(spark: SparkSession, sf_dir: str) -> Sources:
    """All test trips as one delivered month in files that are in key order, weather documents, and a zone CSV."""
    root = scratch_path(spark, "delivered")
    # Only what trips are derived from is shuffled.
    line = driver_table(spark, sf_dir, "lineitem").select(*TRIP_BASE).repartitionByRange(_trip_key())
    _as_trips(line).drop("driver_email").sortWithinPartitions("trip_key").write.parquet(f"{root}/trips")
    days = derive_weather(spark, sf_dir)
    names = ["time", *days.columns[1:]]
    lists = [F.collect_list(c).alias(n) for c, n in zip(days.columns, names, strict=True)]
    daily = days.groupBy(F.substring("weather_date", 1, 4)).agg(F.struct(*lists).alias("daily"))
    daily.select(F.to_json(F.struct("daily")).alias("value")).repartition("value").write.option(
        "maxRecordsPerFile", 1
    ).text(f"{root}/weather")
    zones = derive_zones(spark, sf_dir).withColumnsRenamed({new: old for old, new in ZONE_HEADER.items()})
    zones.write.option("header", "true").csv(f"{root}/zones")
    return Sources(f"{root}/trips", f"{root}/weather", f"{root}/zones")


_landed: dict[tuple[str, str, str], DataFrame] = {}


def _landed_table(
    spark: SparkSession, sf_dir: str, name: str, schema: str | T.StructType, land: Callable
) -> DataFrame:
    """A raw table, landed when this session asks for it the first time."""
    asked = (spark.sparkContext.applicationId, sf_dir, name)
    if asked not in _landed:
        path = scratch_path(spark, name)
        land(path)
        _landed[asked] = read_layer(spark, path, schema)
    return _landed[asked]


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    def land(path: str) -> None:
        line = _month_folders(driver_table(spark, sf_dir, "lineitem").select(*TRIP_BASE))
        write_partitioned(line, path, cluster=True, derive=_with_pseudonym)

    return _landed_table(spark, sf_dir, "trips", TESTBED_TRIPS, land)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    def land(path: str) -> None:
        derive_zones(spark, sf_dir).write.parquet(path)

    return _landed_table(spark, sf_dir, "zones", RAW_ZONES, land)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    def land(path: str) -> None:
        derive_weather(spark, sf_dir).write.parquet(path)

    return _landed_table(spark, sf_dir, "weather", RAW_WEATHER, land)


def land_raw(spark: SparkSession, sf_dir: str) -> None:
    """Land all raw tables now, so that a benchmark can time it apart from the queries."""
    for raw in (raw_trips, raw_zones, raw_weather):
        raw(spark, sf_dir)


_views: dict[tuple, DataFrame] = {}


def _view(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The lazy plan of a higher layer, put together once per session like a named view."""
    asked = (spark.sparkContext.applicationId, sf_dir, name)
    if asked not in _views:
        _views[asked] = build()
    return _views[asked]


def silver(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    def build() -> DataFrame:
        raw = (raw_trips(spark, sf_dir), raw_zones(spark, sf_dir), raw_weather(spark, sf_dir))
        return build_silver(*raw, keep)

    return _view(spark, sf_dir, f"silver{keep}", build)


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "demand", lambda: demand_by_zone_hour(silver(spark, sf_dir)))


def tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "tips", lambda: tips_analysis(silver(spark, sf_dir)))
