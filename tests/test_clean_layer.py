"""Cleaning, dimension joins, marts and reads on small edge tables."""

from datetime import datetime, timedelta

import pytest

from martkit.operators import reads
from martkit.operators.cleaning import clean_trips, rejected_rows
from martkit.operators.dimensions import DuplicateKeyError, assert_unique_key, with_zone
from martkit.operators.grouping import k_anonymous, suppressed_groups, top_k
from martkit.plans.marts import demand_by_zone_hour, tips_analysis
from martkit.plans.silver import build_silver
from martkit.sources.schemas import RAW_TRIPS, RAW_WEATHER, RAW_ZONES, SILVER_TRIPS

START = datetime(2024, 1, 8, 8, 0, 0)


def trip(**changes):
    row = dict.fromkeys(RAW_TRIPS.names)
    row |= {
        "vendorid": 1,
        "tpep_pickup_datetime": START,
        "tpep_dropoff_datetime": START + timedelta(minutes=10),
        "passenger_count": 1.0,
        "trip_distance": 2.0,
        "pulocationid": 1,
        "dolocationid": 2,
        "payment_type": 1,
        "fare_amount": 10.0,
        "tip_amount": 2.0,
        "total_amount": 13.0,
        "driver_email": "driver1@example.test",
        "driver_pseudo": "abc",
    }
    row |= changes
    return tuple(row[c] for c in RAW_TRIPS.names)


@pytest.fixture
def trips(spark):
    return lambda *rows: spark.createDataFrame(list(rows), RAW_TRIPS)


@pytest.fixture
def zones(spark):
    rows = [(1, "Manhattan", "Alpha", None), (2, "Queens", "Beta", None), (3, "Queens", None, None)]
    return spark.createDataFrame(rows, RAW_ZONES)


@pytest.fixture
def weather(spark):
    return spark.createDataFrame([("2024-01-08", 3.0, 5.0, 1.5)], RAW_WEATHER)


def kept(trips, column, values):
    rows = clean_trips(trips(*[trip(**{column: v}) for v in values])).select(column).collect()
    return sorted(r[0] for r in rows)


def test_cleaning_edges(trips):
    assert kept(trips, "trip_distance", [0.0, 0.01, 199.99, 200.0, None]) == [0.01, 199.99]
    assert kept(trips, "passenger_count", [None, 0.0, 1.0, 8.0, 9.0, 0.6, 8.4]) == [1.0, 8.0]
    assert kept(trips, "fare_amount", [-0.01, 0.0, None]) == [0.0]
    assert kept(trips, "total_amount", [-5.0, 0.0, None]) == [0.0]
    assert kept(trips, "tpep_pickup_datetime", [None, START]) == [START]
    ends = [START + timedelta(minutes=m) for m in (0, 1, 240, 241)] + [START - timedelta(minutes=5)]
    assert kept(trips, "tpep_dropoff_datetime", ends) == ends[1:3]


def test_duration_mode_decides_at_the_edge(trips):
    late = START + timedelta(seconds=59)
    rows = trips(trip(tpep_pickup_datetime=late, tpep_dropoff_datetime=late + timedelta(seconds=2)))
    assert clean_trips(rows).count() == 1
    assert clean_trips(rows, "elapsed").count() == 0


def test_rejected_rows_counts_every_broken_rule(trips):
    rows = trips(trip(), trip(trip_distance=None), trip(trip_distance=0.0, fare_amount=-1.0))
    counts = {r["rule"]: r["rejected"] for r in rejected_rows(rows).collect()}
    assert counts["distance_above_0"] == 2
    assert counts["distance_below_200"] == 1
    assert counts["fare_not_negative"] == 1
    assert counts["pickup_present"] == 0
    assert len(counts) == 8


def test_silver_row(trips, zones, weather):
    silver = build_silver(trips(trip(passenger_count=2.5)), zones, weather)
    assert silver.columns == SILVER_TRIPS.names
    row = silver.first()
    assert (row.pu_borough, row.pu_zone, row.do_borough, row.do_zone) == (
        "Manhattan", "Alpha", "Queens", "Beta",
    )
    assert (row.pickup_hour, row.pickup_dow_iso, row.is_weekend, row.is_rush_hour) == (8, 1, False, True)
    assert (row.passenger_count, row.trip_duration_min, row.tip_pct) == (2, 10, 20.0)
    assert (row.temp_mean_c, row.temp_max_c, row.precip_mm) == (3.0, 5.0, 1.5)
    assert "driver_email" not in silver.columns


def test_unmatched_trips_stay_in_silver_and_leave_the_marts(trips, zones, weather):
    later = datetime(2024, 2, 1, 9, 0)
    lost = trip(
        pulocationid=99, tpep_pickup_datetime=later, tpep_dropoff_datetime=later + timedelta(minutes=5)
    )
    silver = build_silver(trips(*[lost] * 6), zones, weather)
    assert silver.count() == 6
    assert silver.filter("pu_borough IS NULL AND precip_mm IS NULL").count() == 6
    assert demand_by_zone_hour(silver).count() == 0
    assert tips_analysis(silver).count() == 0


def test_marts_hide_small_groups_and_keep_nameless_zones(trips, zones, weather):
    rows = [trip()] * 4 + [trip(pulocationid=2)] * 5 + [trip(pulocationid=3)] * 5
    silver = build_silver(trips(*rows), zones, weather)
    demand = demand_by_zone_hour(silver)
    assert sorted((r.pu_zone or "", r.trips) for r in demand.collect()) == [("", 5), ("Beta", 5)]
    assert {r.pu_zone for r in reads.top_zones(demand).collect()} == {None, "Beta"}
    assert [r.pu_zone for r in reads.dashboard_top_zones(demand).collect()] == ["Beta"]
    hidden = suppressed_groups(silver, ["pu_borough", "pu_zone"]).first()
    assert tuple(hidden) == (3, 1, 4)
    (tips,) = tips_analysis(silver).collect()
    assert (tips.pu_borough, tips.is_rainy, tips.trips, tips.avg_tip_pct) == ("Queens", True, 10, 20.0)


def test_zero_fare_is_kept_without_tip_percentage(trips, zones, weather):
    silver = build_silver(trips(*[trip(fare_amount=0.0, tip_amount=3.0)] * 5), zones, weather)
    assert {r.tip_pct for r in silver.collect()} == {None}
    assert demand_by_zone_hour(silver).count() == 1
    assert tips_analysis(silver).count() == 0


def test_joins_give_the_same_rows_without_broadcast(spark, trips, zones, weather):
    """A hot location, an unmatched one and nulls, joined by shuffle."""
    rows = [trip()] * 50 + [trip(pulocationid=99)] * 5 + [trip(dolocationid=None)] * 5
    broadcast = build_silver(trips(*rows), zones, weather).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = build_silver(trips(*rows), zones, weather)
        assert sorted(map(str, shuffled.collect())) == sorted(map(str, broadcast))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicate_dimension_key_is_refused(spark, zones):
    assert assert_unique_key(zones, "location_id") is zones
    with pytest.raises(DuplicateKeyError):
        assert_unique_key(zones.union(zones), "location_id")
    nulls = spark.createDataFrame([(None,), (None,)], "location_id bigint")
    assert_unique_key(nulls, "location_id")


def test_with_zone_takes_int_and_bigint_keys(spark, zones):
    trips = spark.createDataFrame([(1,), (9,), (None,)], "loc int")
    rows = with_zone(trips, zones, "loc", "pu").collect()
    assert sorted((r.loc or 0, r.pu_zone or "") for r in rows) == [(0, ""), (1, "Alpha"), (9, "")]


def test_k_floor_is_a_parameter(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "g string")
    assert [tuple(r) for r in k_anonymous(df, ["g"], {}, k=3).collect()] == [("a", 3)]


def test_top_k_is_total(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "k string, v double")
    assert [r.k for r in top_k(df, "v", 4, ["k"]).collect()] == ["d", "a", "b", "c"]


def test_demand_filters(spark):
    rows = [("Queens", "Z", 0, 1, 9, 1.0, 1.0, 1.0, 1.0), ("Bronx", "Y", 5, 1, 7, 1.0, 1.0, 1.0, 1.0)]
    from martkit.sources.schemas import DEMAND

    demand = spark.createDataFrame(rows, DEMAND)
    assert reads.demand_filtered(demand).count() == 2
    assert reads.demand_filtered(demand, borough="").count() == 2
    assert [r.pu_zone for r in reads.demand_filtered(demand, hour=0).collect()] == ["Z"]
    assert reads.demand_filtered(demand, borough="O'Hara").count() == 0
    matrix = {r.jour: r for r in reads.heat_matrix(demand).collect()}
    assert list(matrix) == ["Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim"]
    assert (matrix["Lun"].h00, matrix["Lun"].h05, matrix["Lun"].h06, matrix["Dim"].h00) == (9, 7, None, None)


@pytest.mark.parametrize(
    ("name", "good", "bad"),
    [
        ("top_zones.limit", (1, 100), (0, 101, 1.5, True)),
        ("demand.limit", (1, 500), (0, 501)),
        ("demand.hour", (0, 23), (-1, 24)),
        ("predictions.limit", (1, 1000), (0, 1001)),
    ],
)
def test_bounds(name, good, bad):
    for value in good:
        assert reads.check_bounds(name, value) == value
    for value in bad:
        with pytest.raises(ValueError):
            reads.check_bounds(name, value)


def test_prediction_reads(spark):
    from martkit.sources.schemas import PREDICTIONS

    rows = [("2024-01-01", "Z", "B", float(i), 1.0, float(i % 3), i % 2) for i in range(6)]
    preds = spark.createDataFrame(rows, PREDICTIONS)
    top = reads.top_errors(preds, 3)
    assert [r.abs_error for r in top.collect()] == [2.0, 2.0, 1.0]
    assert {r.is_anomaly for r in reads.top_errors(preds, 10, anomalies_only=True).collect()} == {1}
    points = reads.actual_vs_predicted(preds)
    assert points.columns == ["actual_total", "predicted_total", "is_anomaly", "diagonal_end"]
    assert {r.diagonal_end for r in points.collect()} == {5.0}


def test_cost_and_year(spark):
    from martkit.operators.cost import TOTAL, annualize, cost_report, price_table

    # The published assumptions: a third of a GB stored, 8 rebuilds of 0.12 GB, 100 reads of 0.01 GB.
    usage = [("run", "storage", "s3_gb_month", 0.3)]
    usage += [("run", "rebuild", "athena_tb_scanned", 0.12)] * 8
    usage += [("run", "explore", "athena_tb_scanned", 0.01)] * 100
    usage += [("dev", "uploads", "s3_put_per_1k", 200.0)]
    log = spark.createDataFrame(usage, "scenario string, item string, meter string, quantity double")
    rows = {(r.scenario, r.item): r.cost for r in cost_report(log, price_table(spark)).collect()}
    assert rows == {
        ("run", "storage"): 0.0069,
        ("run", "rebuild"): 0.0047,
        ("run", "explore"): 0.0049,
        ("run", TOTAL): 0.0165,
        ("dev", "uploads"): 0.001,
        ("dev", TOTAL): 0.001,
    }
    exact = cost_report(log, price_table(spark), decimals=None).filter(f"item = '{TOTAL}'")
    year = {r.scenario: r.y for r in exact.select("scenario", annualize("cost").alias("y")).collect()}
    assert year == {"run": 0.2, "dev": 0.01}


def test_meter_without_price_gives_no_total(spark):
    from martkit.operators.cost import cost_report, price_table

    log = spark.createDataFrame(
        [("run", "a", "s3_gb_month", 1.0), ("run", "b", "unknown", 1.0)],
        "scenario string, item string, meter string, quantity double",
    )
    rows = {r.item: r.cost for r in cost_report(log, price_table(spark)).collect()}
    assert rows == {"a": 0.023, "b": None, "TOTAL": None}
