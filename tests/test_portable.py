"""Edge rows of the portable expressions, and random values against the oracle engine."""

import math

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martkit.functions.labels import PAYMENT_DEFAULT, PAYMENT_LABELS, WEEKDAY_LABELS, label_codes
from martkit.functions.portable import (
    exact_sum,
    iso_dow,
    minutes_between,
    nan_to_null,
    round_to_int,
    scale_round,
    stable_avg,
    stable_sum,
)
from martkit.functions.privacy import protect, pseudonymize, synthetic_subject
from martkit.plans.silver import is_rainy, is_rush_hour, is_weekend, tip_pct

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def one(df):
    return [r[0] for r in df.collect()]


def test_minutes(spark):
    pairs = [
        ("2024-01-01 10:00:59", "2024-01-01 10:01:01", 1, 0),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0, 0),
        ("2024-01-01 23:59:30", "2024-01-02 00:00:30", 1, 1),
        ("2024-01-01 10:01:01", "2024-01-01 10:00:59", -1, 0),
        ("1950-06-01 10:00:59", "1950-06-01 10:01:01", 1, 0),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _, _ in pairs], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b")
    )
    rows = df.select(minutes_between("a", "b"), minutes_between("a", "b", "elapsed")).collect()
    assert [tuple(r) for r in rows] == [(m, e) for _, _, m, e in pairs]
    with pytest.raises(ValueError):
        minutes_between("a", "b", "other")


def test_minutes_do_not_depend_on_the_session_zone(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-03-10 01:30:59' AS a, TIMESTAMP_NTZ'2024-03-10 03:31:00' AS b"
    ).select(minutes_between("a", "b"), minutes_between("a", "b", "elapsed"), F.hour("b"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(df.first()) == (121, 120, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_weekday_and_flags(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-07', date'2024-01-08')) AS d")
    rows = days.select(iso_dow("d"), is_weekend(iso_dow("d"))).collect()
    assert [tuple(r) for r in rows] == [(7, True), (1, False)]
    hours = spark.createDataFrame([(h,) for h in (6, 7, 9, 10, 15, 16, 19, 20)], "h int")
    assert one(hours.select(is_rush_hour(F.col("h")))) == [
        False, True, True, False, False, True, True, False,
    ]


def test_rounding_to_int(spark):
    df = spark.createDataFrame([(x,) for x in (2.5, 3.5, 1.7, -2.5, None)], "x double")
    assert one(df.select(round_to_int("x"))) == [2, 4, 2, -2, None]


def test_rounding_by_scaling(spark):
    values = [1.005, 2.675, 0.5, 1.5, 2.5, -0.5, -2.5, 0.49999999999999994, 1e300, None]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    con = duckdb.connect()
    for n in (0, 1, 2):
        wanted = [con.execute(f"SELECT ROUND(CAST(? AS DOUBLE), {n})", [x]).fetchone()[0] for x in values]
        assert one(df.select(scale_round("x", n))) == wanted


@QUICK
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=1, max_size=200), st.integers(0, 4))
def test_rounding_equals_the_oracle_engine(spark, values, n):
    con = duckdb.connect()
    wanted = [con.execute(f"SELECT ROUND(CAST(? AS DOUBLE), {n})", [x]).fetchone()[0] for x in values]
    df = spark.createDataFrame([(float(x),) for x in values], "x double").coalesce(1)
    assert one(df.select(scale_round("x", n))) == wanted


@QUICK
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=100), st.integers(1, 6))
def test_sums_are_exact_in_any_partitioning(spark, cents, parts):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(parts)
    total, mean = df.select(stable_sum("x", 2).alias("s"), stable_avg("x").alias("m")).first()
    assert total == sum(cents) / 100
    assert math.isclose(mean, sum(cents) / 100 / len(cents), rel_tol=1e-15)


def test_exact_sum_ignores_null_and_is_null_for_nothing(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    assert one(df.select(exact_sum("x"))) == [0.3]
    assert tuple(df.filter("x > 9").select(exact_sum("x"), stable_avg("x")).first()) == (None, None)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, "a"), (2.0, None, "b")], "x double, y double, z string")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, 1.0, "a"), (2.0, None, "b")]
    assert math.isnan(nan_to_null(df, ["y"]).first()["x"])


def test_tip_percentage(spark):
    df = spark.createDataFrame([(3.0, 0.0), (3.0, -1.0), (1.0, 3.0), (None, 3.0)], "tip double, fare double")
    assert one(df.select(tip_pct("tip", "fare"))) == [None, None, 33.33, None]


def test_rain(spark):
    df = spark.createDataFrame([(None,), (0.0,), (0.1,)], "p double")
    assert one(df.select(is_rainy("p"))) == [False, False, True]


def test_no_plan_shows_the_salt(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,)], "e string")
    made = protect(df.withColumn("f", F.col("e")), {"e": "p", "f": "q"}, "hushhush")
    made.write.parquet(f"{tmp_path}/out")
    for found in (made, made.filter("p > '0'"), made.groupBy("p").count()):
        found.collect()
        execution = found._jdf.queryExecution()
        for text in (execution.toString(), execution.executedPlan().treeString(), execution.simpleString()):
            assert "hushhush" not in text
        for mode in ("simple", "extended", "codegen", "formatted"):
            explained = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
            assert "hushhush" not in execution.explainString(explained)


def test_pseudonym(spark):
    import hashlib

    df = spark.createDataFrame([("driver1@example.test",), (None,)], "e string")
    wanted = hashlib.sha256(b"saltdriver1@example.test").hexdigest()[:16]
    assert one(df.select(pseudonymize("e", "salt"))) == [wanted, None]
    shielded = protect(df, {"e": "p"}, "salt")
    assert shielded.columns == ["p"] and shielded.first()[0] == wanted


def test_synthetic_subject(spark):
    keys = [0, 1, 2, 4999, 123_456_789, 2**62]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    wanted = [f"driver{k * 2654435761 % 5000}@x.test" for k in keys]
    assert one(df.select(synthetic_subject("k", "x.test"))) == wanted


def test_labels(spark):
    df = spark.createDataFrame([(1,), (5,), (6,), (0,), (None,)], "c bigint")
    assert one(df.select(label_codes("c", PAYMENT_LABELS, PAYMENT_DEFAULT))) == [
        "Carte", "Inconnu", "Autre", "Autre", "Autre",
    ]
    assert one(df.select(label_codes("c", WEEKDAY_LABELS))) == ["Lun", "Ven", "Sam", None, None]
