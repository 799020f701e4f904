"""The physical plans that matter at scale, held in place."""

import pytest

from martkit.plans import marts
from martkit.testbed import adapters


def plan(df):
    """Physical plan before any run (a plan that ran shows its stages twice)."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    return adapters.silver(spark, sf_dir)


def test_silver_moves_no_trips(silver):
    """Dimensions small enough are broadcast; the trips are neither shuffled nor sorted."""
    text = plan(silver)
    assert text.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(marts.demand_by_zone_hour(adapters.silver(spark, sf_dir)))
    assert "GreaterThan(trip_distance,0.0)" in text
    assert "LessThan(trip_distance,200.0)" in text
    assert "GreaterThanOrEqual(passenger_count,1.0)" in text
    for unused in ("driver_email", "tip_amount", "payment_type"):
        assert f"{unused}:" not in text, unused


def test_marts_combine_before_their_only_shuffle(silver):
    for mart in (marts.demand_by_zone_hour(silver), marts.tips_analysis(silver)):
        text = plan(mart)
        assert text.count("Exchange hashpartitioning") == 1
        before = text.split("Exchange hashpartitioning", 1)[1]
        assert "partial_sum" in before and "partial_count" in before


def test_no_python_on_the_way_to_the_marts(silver):
    text = plan(marts.demand_by_zone_hour(silver))
    assert "Python" not in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_large_dimension_is_not_broadcast(spark, silver):
    """Without room for a broadcast the same joins go by shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        text = plan(silver)
        assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rankings_do_not_sort_everything(spark, sf_dir):
    from martkit.operators.reads import top_zones

    text = plan(top_zones(adapters.demand(spark, sf_dir)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_hot_location_is_split_when_joined_by_shuffle(spark):
    """Two thirds of the trips at one location: its partition is read in several pieces."""
    from pyspark.sql import functions as F

    from martkit.operators.dimensions import with_zone

    trips = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 1000).alias("loc"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    zones = spark.range(1000).selectExpr("id AS location_id", "concat('b', id) AS borough", "'z' AS zone_name")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        joined = with_zone(trips, zones, "loc", "pu")
        counts = {r.pu_borough: r["count"] for r in joined.groupBy("pu_borough").count().collect()}
        assert sum(counts.values()) == 200_000 and counts["b7"] > 133_000
        rows = joined.filter(F.length("payload") > 0).select("payload", "pu_borough")
        assert len(rows.collect()) == 200_000
        final = rows._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in final.split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
