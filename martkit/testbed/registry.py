"""Every registered query: name to (session, data folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.labels import PAYMENT_DEFAULT, PAYMENT_LABELS, WEEKDAY_LABELS, label_codes
from martkit.functions.portable import (
    iso_dow,
    minutes_between,
    nan_to_null,
    round_to_int,
    scale_round,
    stable_avg,
    stable_sum,
)
from martkit.functions.privacy import protect, pseudonymize, synthetic_subject
from martkit.operators import cost, learning, quality, reads
from martkit.operators.cleaning import clean_trips, rejected_rows
from martkit.operators.dimensions import assert_unique_key, enrich, with_daily, with_zone
from martkit.operators.grouping import suppressed_groups, top_k
from martkit.operators.isoforest import Forest, IsolationForest
from martkit.operators.runmetrics import Observed
from martkit.operators.selection import sample_n, split
from martkit.plans import marts
from martkit.plans.pipeline import Lake, Run
from martkit.plans.silver import is_rainy, is_rush_hour, is_weekend, time_columns, tip_pct
from martkit.session import scratch_path
from martkit.sources import landing
from martkit.sources.documents import read_metrics, to_json_rows, write_metrics
from martkit.sources.layers import (
    build_table,
    for_months,
    layer_counts,
    month_spans,
    read_folder,
    read_layer,
    register_table,
    register_views,
    stored,
    write_partitioned,
)
from martkit.sources.models import load_model, stage_model
from martkit.sources.schemas import DEMAND, LANDED_WEATHER, ML_METRICS, MONTH_FOLDERS, PREDICTIONS, SILVER_TRIPS
from martkit.sources.versions import Versions
from martkit.testbed import adapters as raw

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

SAMPLE_SIZE = 20_000
#: More than any feature has values in the test data, so that the trainer tries all thresholds there are.
ROOT_BINS = 1_024
CHOSEN_MONTHS = ("1996-01", "1996-02", "1999-12")
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and sinks -----------------------------------------------------------------------------


@query
def partitioned_layer(spark, sf_dir):
    """Month folders as written and read back: rows and fares per folder."""
    trips = raw.raw_trips(spark, sf_dir)
    return trips.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trips"), stable_sum("fare_amount", 2).alias("fares")
    )


@query
def month_selection(spark, sf_dir):
    """Rows of chosen months; the scan lists only their folders."""
    chosen = for_months(raw.raw_trips(spark, sf_dir), CHOSEN_MONTHS)
    return chosen.select("trip_key", "year", "month", PICKUP, "fare_amount")


@query
def month_rewrite(spark, sf_dir):
    """A landed month is written again: that month is replaced, all others stay."""
    path = scratch_path(spark, "rewrite")
    weather = nan_to_null(raw.raw_weather(spark, sf_dir))
    day = F.to_date("weather_date")
    foldered = weather.withColumns({"year": F.year(day), "month": F.month(day)})
    write_partitioned(foldered, path, cluster=True)
    again = for_months(read_layer(spark, path, LANDED_WEATHER), CHOSEN_MONTHS[:1])
    write_partitioned(stored(again.withColumn("precipitation_sum", F.lit(99.0)), "month"), path)
    return read_layer(spark, path, LANDED_WEATHER)


@query
def zones_csv(spark, sf_dir):
    """Zones written as the CSV they come from, with a text for "missing", and loaded again."""
    path = scratch_path(spark, "zones-csv")
    header = {new: old for old, new in landing.ZONE_HEADER.items()}
    zones = raw.raw_zones(spark, sf_dir).fillna("N/A", ["service_zone"])
    zones.withColumnsRenamed(header).write.option("header", "true").csv(path)
    return landing.load_zones(spark, path)


@query
def weather_documents(spark, sf_dir):
    """Daily weather as monthly documents of parallel arrays (at most 31 days each), loaded again."""
    path = scratch_path(spark, "weather-json")
    weather = raw.raw_weather(spark, sf_dir)
    names = ["time", *weather.columns[1:]]
    days = F.sort_array(F.collect_list(F.struct(F.col("weather_date").alias("time"), *names[1:])))
    months = weather.groupBy(F.substring("weather_date", 1, 7).alias("m")).agg(days.alias("d"))
    daily = F.struct(*[F.col(f"d.{n}").alias(n) for n in names]).alias("daily")
    documents = months.select(F.to_json(F.struct(daily)).alias("value"))
    # One document per file, as the source delivers them.
    documents.repartition("value").write.option("maxRecordsPerFile", 1).text(path)
    return landing.load_weather(spark, path)


@query
def json_rows(spark, sf_dir):
    """The demand mart as JSON records, read back."""
    path = scratch_path(spark, "json")
    to_json_rows(raw.demand(spark, sf_dir), path)
    return spark.read.schema(DEMAND).json(path)


@query
def recursive_folder(spark, sf_dir):
    """A Parquet tree read as one table without its folder columns."""
    path = scratch_path(spark, "tree")
    demand = raw.demand(spark, sf_dir).withColumn("part", F.col("pickup_dow_iso"))
    write_partitioned(demand, path, by=["part"], cluster=True)
    return read_folder(spark, path, DEMAND)


@query
def layer_row_counts(spark, sf_dir):
    """Rows per stored layer, and null for one that is not there."""
    lake = Lake(scratch_path(spark, "lake"))
    raw.silver(spark, sf_dir).write.parquet(lake.silver)
    silver = spark.read.parquet(lake.silver)
    marts.demand_by_zone_hour(silver).write.parquet(lake.demand)
    marts.tips_analysis(silver).write.parquet(lake.tips)
    paths = {"silver_trips": lake.silver, "gold_demand_by_zone_hour": lake.demand, "gold_tips_analysis": lake.tips}
    return layer_counts(spark, {**paths, "gold_ml_predictions": lake.predictions})


@query
def landed_trips(spark, sf_dir):
    """A month delivered in several files, landed: rows are numbered over the files, subjects follow the number."""
    root = scratch_path(spark, "landed")
    landing.land_trips(spark, raw.deliver(spark, sf_dir).trips, root, "2024-01", raw.SALT, raw.DOMAIN)
    trips = spark.read.parquet(root)
    return trips.select(
        "trip_key", "vendorid", "fare_amount", "driver_email", "driver_pseudo", "_source_row", "year",
        F.col("_ingested_at").isNotNull().alias("stamped"),
    )


@query
def drifted_files(spark, sf_dir):
    """A month delivered in many files of two widths and spellings of its columns, read as one table."""
    path, trips = scratch_path(spark, "drifted"), raw.raw_trips(spark, sf_dir)
    for vendor, columns in (
        (1, {"VendorID": "int", "passenger_count": "double"}), (2, {"vendorid": "bigint", "Passenger_Count": "bigint"})
    ):
        widths = [F.col(name.lower()).cast(width).alias(name) for name, width in columns.items()]
        part = trips.filter(F.col("vendorid") == vendor).select("trip_key", *widths, "total_amount")
        part.repartition(16, "trip_key").write.mode("append").parquet(path)
    return landing.read_trip_source(spark, path).select("trip_key", "vendorid", "passenger_count", "total_amount")


@query
def lake_build(spark, sf_dir):
    """Rows per layer after a run has landed and built everything from delivered files."""
    run = Run(spark, Lake(scratch_path(spark, "lake")), raw.deliver(spark, sf_dir), ["2024-01"], raw.SALT)
    run.land()
    run.transform()
    return layer_counts(spark, run.lake.counted(spark))


def _table_name() -> str:
    return f"testbed_{uuid.uuid4().hex[:12]}"


@query
def external_table(spark, sf_dir):
    """The demand mart as a table declared over its files."""
    path, name = scratch_path(spark, "external"), _table_name()
    raw.demand(spark, sf_dir).write.parquet(path)
    register_table(spark, name, DEMAND, path)
    return spark.sql(f"SELECT * FROM {name}")


@query
def table_as_select(spark, sf_dir):
    """A table made from a query."""
    busy = raw.demand(spark, sf_dir).filter("trips >= 6")
    return build_table(spark, _table_name(), busy, scratch_path(spark, "table"), replace=False)


@query
def rebuilt_table(spark, sf_dir):
    """A table built again replaces its rows."""
    name, path = _table_name(), scratch_path(spark, "table")
    demand = raw.demand(spark, sf_dir)
    build_table(spark, name, demand, path)
    return build_table(spark, name, demand.filter("pickup_hour < 12"), path)


@query
def view_read(spark, sf_dir):
    """A mart by the name of a view."""
    name = _table_name()
    register_views(spark, {name: raw.tips(spark, sf_dir)})
    return spark.sql(f"SELECT pu_borough, payment_type, trips FROM {name} WHERE is_rainy")


@query
def key_guard(spark, sf_dir):
    """Which columns may serve as a dimension's key."""
    found = []
    orders, zones = raw.driver_table(spark, sf_dir, "orders"), raw.raw_zones(spark, sf_dir)
    for table, df, key in (("zones", zones, "location_id"), ("orders", orders, "o_orderkey"), ("orders", orders, "o_custkey")):
        try:
            assert_unique_key(df, key)
            found.append((table, key, True))
        except ValueError:
            found.append((table, key, False))
    return spark.createDataFrame(found, "table_name string, key_name string, is_unique boolean")


@query
def observed_counts(spark, sf_dir):
    """Rows and total trips of a mart, counted while it was written."""
    watched = Observed(raw.demand(spark, sf_dir), "demand", {}, trips=F.sum("trips"))
    watched.df.write.parquet(scratch_path(spark, "observed"))
    return spark.createDataFrame([(watched.rows, watched.values["trips"])], "row_count bigint, trips bigint")


@query
def month_list(spark, sf_dir):
    """Months with orders, given as one comma-separated list per year, with their first and last day."""
    orders = raw.driver_table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    lists = orders.groupBy(F.year("o_orderdate").alias("y")).agg(
        F.concat_ws(" , ", F.sort_array(F.collect_set(month))).alias("months")
    )
    return month_spans(lists)


# --- projections -----------------------------------------------------------------------------------


@query
def silver_trips(spark, sf_dir):
    """The clean layer, all 26 columns."""
    return raw.silver(spark, sf_dir)


@query
def derived_time_columns(spark, sf_dir):
    columns = time_columns(F.col(PICKUP))
    trips = raw.raw_trips(spark, sf_dir)
    return trips.select("trip_key", *[c.alias(n) for n, c in columns.items()])


@query
def minutes_between_times(spark, sf_dir):
    return raw.raw_trips(spark, sf_dir).select(
        "trip_key",
        minutes_between(PICKUP, DROPOFF).alias("boundary_minutes"),
        minutes_between(PICKUP, DROPOFF, "elapsed").alias("elapsed_minutes"),
    )


@query
def round_to_whole(spark, sf_dir):
    """Halves included: half the passenger count."""
    half = F.col("passenger_count") / 2
    return raw.raw_trips(spark, sf_dir).select("trip_key", round_to_int(half).alias("half_rounded"))


@query
def round_decimals(spark, sf_dir):
    return raw.raw_trips(spark, sf_dir).select(
        "trip_key",
        scale_round("fare_amount", 2).alias("fare_2"),
        scale_round("tip_amount", 1).alias("tip_1"),
        scale_round("total_amount", 0).alias("total_0"),
    )


@query
def tip_percentage(spark, sf_dir):
    pct = tip_pct("tip_amount", "fare_amount")
    return raw.raw_trips(spark, sf_dir).select("trip_key", pct.alias("tip_pct"))


@query
def rain_flag(spark, sf_dir):
    trips = raw.silver(spark, sf_dir, ("trip_key",))
    return trips.select("trip_key", "precip_mm", is_rainy("precip_mm").alias("is_rainy"))


@query
def pseudonyms(spark, sf_dir):
    trips = raw.raw_trips(spark, sf_dir)
    return trips.select("trip_key", pseudonymize("driver_email", raw.SALT).alias("driver_pseudo"))


@query
def synthetic_subjects(spark, sf_dir):
    line = raw.driver_table(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", synthetic_subject("l_orderkey", raw.DOMAIN).alias("driver_email")
    )


@query
def protect_pii(spark, sf_dir):
    trips = raw.raw_trips(spark, sf_dir).select("trip_key", "driver_email", "fare_amount")
    return protect(trips, {"driver_email": "driver_pseudo"}, raw.SALT)


@query
def payment_labels(spark, sf_dir):
    code = (F.col("payment_type") + 1).alias("code")
    label = label_codes("code", PAYMENT_LABELS, PAYMENT_DEFAULT).alias("label")
    return raw.raw_trips(spark, sf_dir).select("trip_key", code).select("trip_key", "code", label)


@query
def weekday_labels(spark, sf_dir):
    label = label_codes(iso_dow(PICKUP), WEEKDAY_LABELS)
    return raw.raw_trips(spark, sf_dir).select("trip_key", label.alias("jour"))


@query
def weekday_flags(spark, sf_dir):
    """Trips per weekend and rush-hour flag, counted over all raw trips."""
    flags = raw.raw_trips(spark, sf_dir).select(
        is_weekend(iso_dow(PICKUP)).alias("is_weekend"),
        is_rush_hour(F.hour(PICKUP)).alias("is_rush_hour"),
        "fare_amount",
    )
    return flags.groupBy("is_weekend", "is_rush_hour").agg(
        F.count(F.lit(1)).alias("trips"), stable_avg("fare_amount", 4).alias("avg_fare")
    )


@query
def missing_values(spark, sf_dir):
    """NaN and null treated alike: a fare of 0 becomes NaN on the way."""
    fare = F.when(F.col("fare_amount") == 0, F.lit(float("nan"))).otherwise(F.col("fare_amount"))
    trips = raw.raw_trips(spark, sf_dir).select("payment_type", fare.alias("fare_amount"))
    return (
        nan_to_null(trips)
        .groupBy("payment_type")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.count("fare_amount").alias("known_fares"),
            stable_avg("fare_amount", 4).alias("avg_fare"),
        )
    )


# --- filters ---------------------------------------------------------------------------------------


@query
def clean_rows(spark, sf_dir):
    return clean_trips(raw.raw_trips(spark, sf_dir)).select(
        "trip_key", "passenger_count", "trip_distance", "fare_amount", "total_amount"
    )


@query
def clean_rows_elapsed(spark, sf_dir):
    """The filter with durations counted as full elapsed minutes."""
    trips = clean_trips(raw.raw_trips(spark, sf_dir), "elapsed")
    return trips.select("trip_key", minutes_between(PICKUP, DROPOFF, "elapsed").alias("minutes"))


@query
def rejected_by_rule(spark, sf_dir):
    return rejected_rows(raw.raw_trips(spark, sf_dir))


# --- joins -----------------------------------------------------------------------------------------


@query
def zone_enrich_pickup(spark, sf_dir):
    trips = raw.raw_trips(spark, sf_dir).select("trip_key", "pulocationid")
    return with_zone(trips, raw.raw_zones(spark, sf_dir), "pulocationid", "pu")


@query
def zone_enrich_dropoff(spark, sf_dir):
    trips = raw.raw_trips(spark, sf_dir).select("trip_key", "dolocationid")
    return with_zone(trips, raw.raw_zones(spark, sf_dir), "dolocationid", "do")


@query
def weather_enrich(spark, sf_dir):
    trips = raw.raw_trips(spark, sf_dir).select("trip_key", PICKUP)
    return with_daily(trips, raw.raw_weather(spark, sf_dir), PICKUP, "weather_date")


@query
def star_enrich(spark, sf_dir):
    """All three dimensions over all raw trips, clean or not."""
    trips = raw.raw_trips(spark, sf_dir).select("trip_key", PICKUP, "pulocationid", "dolocationid")
    return enrich(trips, raw.raw_zones(spark, sf_dir), raw.raw_weather(spark, sf_dir))


# --- months that are replaced at once, and what is merged from them --------------------------------


def _by_month(spark, sf_dir) -> DataFrame:
    """The clean layer with the month folder each trip was landed in."""
    return raw.silver(spark, sf_dir, ("year", "month"))


def _one_month_again(spark, sf_dir, make: Callable[[DataFrame, tuple], DataFrame], schema: T.StructType | str) -> DataFrame:
    """What all months keep of the clean layer, after one month was first kept wrong and then built again by itself."""
    versions, again = Versions(spark, scratch_path(spark, "versions")), CHOSEN_MONTHS[0]
    rows = _by_month(spark, sf_dir)
    held = versions.stage_months("kept", make(rows, ("year", "month")))
    year, month = again.split("-")
    wrong = rows.filter(~((F.col("year") == int(year)) & (F.col("month") == month) & (F.col("pickup_hour") < 12)))
    held |= {again: versions.stage_months("kept", make(for_months(wrong, [again]), ("year", "month")))[again]}
    versions.commit({"kept": held})
    versions.replace("kept", make(for_months(rows, [again]).drop("year", "month"), ()), again)
    return versions.read("kept", schema)


def _merged_mart(spark, sf_dir, mart: marts.Mart) -> DataFrame:
    return mart.merge(_one_month_again(spark, sf_dir, mart.parts, mart.parts_schema(SILVER_TRIPS)))


@query
def demand_from_months(spark, sf_dir):
    """The demand mart put together from what each month keeps; one month was built again by itself."""
    return _merged_mart(spark, sf_dir, marts.DEMAND)


@query
def tips_from_months(spark, sf_dir):
    return _merged_mart(spark, sf_dir, marts.TIPS)


@query
def quality_from_months(spark, sf_dir):
    """The checks read off the sums of every month's counters."""
    states = _one_month_again(spark, sf_dir, quality.check_state, quality.STATE_SCHEMA)
    return quality.report_of(quality.merge_states(states))


@query
def month_swap(spark, sf_dir):
    """A landed month is replaced in one commit; a version that was written and never committed isn't seen."""
    versions, month = Versions(spark, scratch_path(spark, "swap")), CHOSEN_MONTHS[0]
    weather, day = nan_to_null(raw.raw_weather(spark, sf_dir)), F.to_date("weather_date")
    versions.commit({"weather": versions.stage_months("weather", weather.withColumns({"year": F.year(day), "month": F.month(day)}))})
    again = versions.read("weather", LANDED_WEATHER, [month])
    versions.replace("weather", again.withColumn("precipitation_sum", F.lit(99.0)), month)
    versions.stage("weather", again.withColumn("precipitation_sum", F.lit(-1.0)), month)
    return versions.read("weather", LANDED_WEATHER)


@query
def table_swap(spark, sf_dir):
    """A whole table built again: readers of the older manifest keep its rows, new readers get the new ones."""
    versions, demand = Versions(spark, scratch_path(spark, "swap")), raw.demand(spark, sf_dir)
    before = versions.replace("demand", demand)
    versions.replace("demand", demand.filter("pickup_hour < 12"))
    versions.collect_old(keep=2, older_than=0.0)
    old = versions.read("demand", DEMAND, manifest=before).agg(F.count(F.lit(1)).alias("n"), F.sum("trips").alias("t"))
    new = versions.read("demand", DEMAND).agg(F.count(F.lit(1)).alias("n"), F.sum("trips").alias("t"))
    return old.select(F.lit("old").alias("reader"), "n", "t").unionByName(new.select(F.lit("new").alias("reader"), "n", "t"))


# --- marts and reads -------------------------------------------------------------------------------


@query
def demand_by_zone_hour(spark, sf_dir):
    return raw.demand(spark, sf_dir)


@query
def tips_analysis(spark, sf_dir):
    return raw.tips(spark, sf_dir)


@query
def k_suppressed_groups(spark, sf_dir):
    return suppressed_groups(marts.demand_source(raw.silver(spark, sf_dir)), marts.DEMAND_KEYS)


@query
def top_zones(spark, sf_dir):
    return reads.top_zones(raw.demand(spark, sf_dir))


@query
def top_zones_whole(spark, sf_dir):
    return reads.top_zones(raw.demand(spark, sf_dir), decimals=0)


@query
def busiest_hours(spark, sf_dir):
    return reads.busiest_hours(raw.demand(spark, sf_dir))


@query
def tips_by_payment(spark, sf_dir):
    return reads.tips_by_payment(raw.tips(spark, sf_dir))


@query
def kpis(spark, sf_dir):
    return reads.kpis(raw.demand(spark, sf_dir))


@query
def dashboard_top_zones(spark, sf_dir):
    return reads.dashboard_top_zones(raw.demand(spark, sf_dir))


@query
def demand_heat(spark, sf_dir):
    return reads.demand_heat(raw.demand(spark, sf_dir))


@query
def heat_matrix(spark, sf_dir):
    return reads.heat_matrix(raw.demand(spark, sf_dir))


@query
def demand_listing(spark, sf_dir):
    return reads.demand_filtered(raw.demand(spark, sf_dir))


@query
def demand_filtered(spark, sf_dir):
    return reads.demand_filtered(raw.demand(spark, sf_dir), borough="ASIA", hour=0, limit=500)


@query
def tips_ranked(spark, sf_dir):
    return reads.tips_ranked(raw.tips(spark, sf_dir))


@query
def labelled_tips(spark, sf_dir):
    return reads.labelled_tips(raw.tips(spark, sf_dir))


@query
def dearest_trips(spark, sf_dir):
    """Top 25 clean trips by total."""
    trips = raw.silver(spark, sf_dir, ("trip_key",)).select("trip_key", "pu_zone", "total_amount")
    return top_k(trips, "total_amount", 25, ["trip_key"])


# --- quality ---------------------------------------------------------------------------------------


@query
def quality_report(spark, sf_dir):
    return quality.quality_report(raw.silver(spark, sf_dir))


@query
def quality_report_raw(spark, sf_dir):
    """The checks on rows nobody cleaned, clear identifier included: most of them fail."""
    trips = raw.raw_trips(spark, sf_dir)
    placed = with_zone(trips, raw.raw_zones(spark, sf_dir), "pulocationid", "pu")
    return quality.quality_report(
        placed.select(
            F.col(PICKUP).alias("pickup_ts"),
            F.col("pulocationid").alias("pu_location_id"),
            minutes_between(PICKUP, DROPOFF).alias("trip_duration_min"),
            tip_pct("tip_amount", "fare_amount").alias("tip_pct"),
            "pu_borough",
            "driver_email",
        )
    )


@query
def gate_verdicts(spark, sf_dir):
    """What the gate says of the clean layer, from its months' counters, and of the raw rows: stopped, and by which checks."""
    found = []
    for layer, report in (("clean", quality_from_months(spark, sf_dir)), ("raw", quality_report_raw(spark, sf_dir))):
        try:
            quality.quality_gate(report)
            found.append((layer, False, None))
        except quality.QualityGateError as error:
            names = str(error).partition(": ")[2].split(", ")
            found.append((layer, True, ", ".join(sorted(names))))
    return spark.createDataFrame(found, "layer string, stopped boolean, failed string")


# --- sampling and learning -------------------------------------------------------------------------


def _learning_rows(spark, sf_dir) -> DataFrame:
    return raw.silver(spark, sf_dir, ("trip_key",))


def _narrow_rows(spark, sf_dir) -> DataFrame:
    """Key, features and target, stored: the searches of ranks read these files instead of cleaning again."""
    narrow = _learning_rows(spark, sf_dir).select("trip_key", *learning.FEATURES, learning.TARGET)
    return stored(narrow, "narrow")


@query
def sampled_trips(spark, sf_dir):
    """Exactly 20,000 clean trips, or all of them if there are fewer."""
    trips = clean_trips(raw.raw_trips(spark, sf_dir)).select("trip_key", "total_amount")
    return sample_n(trips, SAMPLE_SIZE, "trip_key", 42)


@query
def impute_median(spark, sf_dir):
    filled = learning.impute_median(_narrow_rows(spark, sf_dir))
    return filled.select("trip_key", "temp_mean_c", "precip_mm")


@query
def complete_rows(spark, sf_dir):
    """Clean trips that miss no feature, without filling weather gaps first."""
    return learning.complete_rows(_learning_rows(spark, sf_dir)).select("trip_key", "temp_mean_c")


def _guess():
    """A fixed linear guess of the total, which the oracle can state."""
    return F.lit(12.0) + F.col("trip_distance") * 0.25


def _ready_rows(spark, sf_dir) -> DataFrame:
    return learning.prepare(_narrow_rows(spark, sf_dir))


def _split(rows):
    return split(rows, "trip_key", 0.2, "42:split")


@query
def split_rows(spark, sf_dir):
    """Which part each prepared trip belongs to."""
    rows = _ready_rows(spark, sf_dir)
    part = F.when(_split(rows).in_test, "test").otherwise("train").alias("part")
    return rows.select("trip_key", part)


@query
def mean_baseline(spark, sf_dir):
    parts = _split(_ready_rows(spark, sf_dir))
    errors = learning.mean_baseline(parts.train, parts.test)
    return errors.select(scale_round("mae", 4).alias("mae"), scale_round("rmse", 4).alias("rmse"))


@query
def regression_metrics(spark, sf_dir):
    """Errors of a fixed linear guess on all clean trips, and its gain over a guess of 40."""
    trips = _learning_rows(spark, sf_dir)
    flat = F.abs(F.col("total_amount") - 40.0)
    m = learning.regression_metrics(trips, "total_amount", _guess(), flat=F.avg(flat))
    return m.select(
        *[scale_round(c, 4).alias(c) for c in ("mae", "rmse", "r2")],
        scale_round(learning.improvement_pct(F.col("mae"), F.col("flat")), 2).alias("gain_pct"),
    )


def _guessed(spark, sf_dir) -> DataFrame:
    """All clean trips scored by the fixed guess, flagged where it is far off: a mart the oracle can check."""
    far = F.abs(F.col("total_amount") - _guess()) > 40
    scored = _learning_rows(spark, sf_dir).withColumns(
        {"prediction": _guess(), "is_anomaly": far.cast("int")}
    )
    return learning.prediction_mart(scored, "trip_key")


@query
def guess_mart(spark, sf_dir):
    """The predictions mart of the fixed guess: all rows in its published form."""
    return _guessed(spark, sf_dir)


@query
def guess_top_errors(spark, sf_dir):
    return reads.top_errors(_guessed(spark, sf_dir), 100)


@query
def guess_anomalies(spark, sf_dir):
    return reads.top_errors(_guessed(spark, sf_dir), 20, anomalies_only=True)


@query
def guess_scatter(spark, sf_dir):
    return reads.actual_vs_predicted(_guessed(spark, sf_dir))


@query
def forest_root_split(spark, sf_dir):
    """First split of a tree fitted on all prepared trips, with a bin for each value, and what it does to these trips."""
    rows = stored(_ready_rows(spark, sf_dir), "root-rows")
    model = learning.fit_price_model(rows, trees=1, depth=1, bins=ROOT_BINS, bootstrap=False)
    at = learning.root_split(model)
    left = F.col(at.variable) <= at.threshold
    return rows.agg(
        F.lit(at.variable).alias("variable"), F.lit(at.threshold).alias("threshold"),
        F.count_if(left).alias("left_rows"), F.count_if(~left).alias("right_rows"),
        scale_round(F.lit(at.left), 4).alias("left_value"), scale_round(F.lit(at.right), 4).alias("right_value"),
        F.lit(learning.importances(model)[at.variable]).alias("importance"),
    )


_learned: dict[tuple[str, str], dict] = {}


def _learn(spark, sf_dir) -> dict:
    """Train and score once per session; the results are checkpointed tables and a model."""
    asked = (spark.sparkContext.applicationId, sf_dir)
    if asked not in _learned:
        _learned[asked] = learning.train_and_score(_learning_rows(spark, sf_dir), "trip_key")
    return _learned[asked]


@query
def price_model(spark, sf_dir):
    """Error of the forest next to the baseline."""
    return _learn(spark, sf_dir)["metrics"].select(
        "n_train", "n_test", "baseline.mae", F.col("model_metrics.mae").alias("model_mae"),
        "model_metrics.r2", "improvement_mae_pct",
    )


@query
def ml_metrics(spark, sf_dir):
    """The metrics document as JSON text written and read back."""
    path = scratch_path(spark, "metrics")
    _learn(spark, sf_dir)["metrics"].write.json(path)
    return spark.read.schema(ML_METRICS).json(path)


@query
def feature_importance(spark, sf_dir):
    return learning.importance_rows(_learn(spark, sf_dir)["metrics"])


@query
def prediction_mart(spark, sf_dir):
    return _learn(spark, sf_dir)["predictions"]


@query
def top_errors(spark, sf_dir):
    return reads.top_errors(_learn(spark, sf_dir)["predictions"], 100)


@query
def top_anomalies(spark, sf_dir):
    return reads.top_errors(_learn(spark, sf_dir)["predictions"], 20, anomalies_only=True)


@query
def actual_vs_predicted(spark, sf_dir):
    return reads.actual_vs_predicted(_learn(spark, sf_dir)["predictions"])


@query
def guess_metrics_document(spark, sf_dir):
    """A metrics document written and read back: the split's baseline, and the fixed guess on its test rows."""
    path = scratch_path(spark, "guess-metrics")
    parts = _split(stored(_ready_rows(spark, sf_dir), "ready"))
    errors = learning.regression_metrics(parts.test, "total_amount", _guess())
    far = parts.test.filter(F.abs(F.col("total_amount") - _guess()) > 40).count()
    baseline = learning.mean_baseline(parts.train, parts.test)
    document = learning.ml_metrics(baseline, errors, {}, parts.n_train, parts.n_test, far, "fixed")
    write_metrics(document, path)
    return read_metrics(spark, path).select(
        "run_id", "model", "n_train", "n_test", F.col("baseline.mae").alias("base_mae"),
        F.col("baseline.rmse").alias("base_rmse"), "model_metrics.mae", "model_metrics.rmse", "model_metrics.r2",
        "improvement_mae_pct", "anomalies_detected",
    )


@query
def importance_listing(spark, sf_dir):
    """Importance rows of a map made from the data: each borough's share of the clean trips."""
    trips = _learning_rows(spark, sf_dir).filter("pu_borough IS NOT NULL")
    n = F.count(F.lit(1))
    shares = trips.groupBy("pu_borough").agg(n.alias("n")).agg(
        F.map_from_entries(F.collect_list(F.struct("pu_borough", F.col("n").cast("double")))).alias("feature_importance")
    )
    return learning.importance_rows(shares)


@query
def later_months(spark, sf_dir):
    """A model of the trips before 1997, published, loaded again, and the months since predicted with it."""
    trips = stored(_learning_rows(spark, sf_dir), "all-months")
    early, later = trips.filter("pickup_date < '1997-01-01'"), trips.filter("pickup_date >= '1997-01-01'")
    fitted = learning.train_and_score(early, "trip_key", fit_rows=5_000, trees=5, depth=5)["fitted"]
    versions = Versions(spark, scratch_path(spark, "models"))
    versions.commit({"price": stage_model(versions, "price", fitted)})
    months = later.select(F.date_format("pickup_date", "yyyy-MM")).distinct().collect()  # a row per month
    foldered = later.withColumns({"year": F.year("pickup_date"), "month": F.month("pickup_date")})
    path = scratch_path(spark, "later-months")
    write_partitioned(foldered, path, cluster=True)  # so that each month reads its own rows only
    schema = T.StructType([*later.schema.fields, *MONTH_FOLDERS.fields])
    for (month,) in sorted(months):
        rows = for_months(read_layer(spark, path, schema), [month]).drop("year", "month")
        versions.replace("predictions", learning.predict(load_model(versions, "price"), rows), month)
    predicted = versions.read("predictions", PREDICTIONS)
    cents = F.sum(F.round(100 * F.col("actual_total")).cast("bigint"))
    per_month = predicted.groupBy(F.substring("pickup_date", 1, 7).alias("month"))
    return per_month.agg(
        F.count(F.lit(1)).alias("rows"), cents.alias("actual_cents"),
        F.count_if(F.col("predicted_total").isNotNull() & F.col("is_anomaly").isNotNull()).alias("predicted"),
    )


@query
def trained_facts(spark, sf_dir):
    """What is known beforehand of any trained model: sizes of both parts, a row per test row."""
    learned = _learn(spark, sf_dir)
    rows = learned["predictions"].agg(F.count(F.lit(1)).alias("rows"), F.sum("is_anomaly").alias("flagged"))
    metrics = learned["metrics"].select(
        "n_train", "n_test", F.col("anomalies_detected").alias("flagged"),
        (F.abs(F.aggregate(F.map_values("feature_importance"), F.lit(0.0), lambda a, x: a + x) - 1) < 0.01).alias("shares_add_up"),
    )
    same = metrics.join(rows, "flagged").withColumn("few_flagged", F.col("flagged") <= F.ceil(F.col("n_test") * 0.02))
    return same.select("n_train", "n_test", "rows", "shares_add_up", "few_flagged")


@query
def scored_test_rows(spark, sf_dir):
    """The totals of all rows that the trained model has scored."""
    return _learn(spark, sf_dir)["predictions"].select("pickup_date", "pu_zone", "pu_borough", "actual_total")


@query
def fixed_forest_scores(spark, sf_dir):
    """All clean trips scored and flagged by two small fixed trees."""
    cuts = np.array([[20.0, 60.0, 100.0, 0, 0, 0, 0], [30.0, 0, 0, 0, 0, 0, 0]])
    feature = np.array([[2, 0, 1, 0, 0, 0, 0], [2, 0, 0, 0, 0, 0, 0]])
    # Right child before left child for each node; a leaf has itself twice.
    children = np.array([[2, 1, 4, 3, 6, 5, 3, 3, 4, 4, 5, 5, 6, 6], [2, 1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6]])
    length = np.array([[0, 0, 0, 2.0, 3.0, 3.5, 1.0], [0, 4.0, 1.5, 0, 0, 0, 0]])
    fixed = Forest(feature, cuts, children, length, 2, 4.0)
    forest = IsolationForest(columns=learning.OUTLIER_FEATURES, key="trip_key")
    trips = _learning_rows(spark, sf_dir).select("trip_key", *learning.OUTLIER_FEATURES)
    scored = forest.score(trips, fixed)
    flag = (F.col("anomaly_score") > 0.6).cast("int").alias("is_anomaly")
    return scored.select("trip_key", scale_round("anomaly_score", 6).alias("anomaly_score"), flag)


@query
def isolation_forest(spark, sf_dir):
    """Outlier score and flag for every clean trip."""
    forest = IsolationForest(columns=learning.OUTLIER_FEATURES, key="trip_key")
    trips = _learning_rows(spark, sf_dir).select("trip_key", *learning.OUTLIER_FEATURES)
    flagged = forest.fit_flag(stored(trips, "outlier-rows"))
    return flagged.withColumn("anomaly_score", scale_round("anomaly_score", 6))


# --- cost ------------------------------------------------------------------------------------------


def _usage(spark, sf_dir) -> DataFrame:
    """The event stream read as a usage log: one metered quantity per event."""
    events = raw.driver_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    meter = (
        F.when(kind.isin("view", "click"), "athena_tb_scanned")
        .when(kind == "purchase", "s3_put_per_1k")
        .otherwise("s3_gb_month")
    )
    return events.select(
        F.when(F.col("user_id") % 2 == 0, "dev").otherwise("run").alias("scenario"),
        kind.alias("item"),
        meter.alias("meter"),
        F.col("value").alias("quantity"),
    )


@query
def cost_report(spark, sf_dir):
    return cost.cost_report(_usage(spark, sf_dir), cost.price_table(spark))


@query
def cost_annualized(spark, sf_dir):
    monthly = cost.cost_report(_usage(spark, sf_dir), cost.price_table(spark), decimals=None)
    totals = monthly.filter(F.col("item") == cost.TOTAL)
    return totals.select("scenario", cost.annualize("cost").alias("yearly_cost"))
