"""One failing table per check, edge cases of empty and incomplete tables, and the gate."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martkit.operators.quality import QualityGateError, quality_gate, quality_report

SCHEMA = (
    "pickup_ts timestamp_ntz, total_amount double, pu_location_id int, trip_duration_min bigint, "
    "tip_pct double, pu_borough string, driver_pseudo string"
)
GOOD = {
    "pickup_ts": datetime(2024, 1, 1, 10, 0),
    "total_amount": 20.0,
    "pu_location_id": 100,
    "trip_duration_min": 12,
    "tip_pct": 15.0,
    "pu_borough": "Manhattan",
    "driver_pseudo": "abc123",
}


@pytest.fixture
def table(spark):
    def build(rows=10, **changes):
        return spark.createDataFrame([tuple((GOOD | changes).values())] * rows, SCHEMA)

    return build


def results(df):
    return {r["name"]: r for r in quality_report(df).collect()}


def failing(df):
    return {name for name, r in results(df).items() if not r["passed"]}


def test_clean_data_passes(table):
    report = results(table())
    assert len(report) == 9
    assert all(r["passed"] for r in report.values())
    assert report["volume_non_vide"]["detail"] == "10 lignes"
    assert report["tip_pct_borne_0_100"]["detail"] == "100.00% dans [0,100]"
    assert report["jointure_zones_ok"]["detail"] == "100.0% des courses ont un borough"


@pytest.mark.parametrize(
    ("changes", "failed"),
    [
        ({"total_amount": -5.0}, {"total_amount_positif"}),
        ({"total_amount": None}, {"non_null__total_amount", "total_amount_positif"}),
        ({"total_amount": float("nan")}, {"non_null__total_amount", "total_amount_positif"}),
        ({"pickup_ts": None}, {"non_null__pickup_ts"}),
        ({"pu_location_id": None}, {"non_null__pu_location_id"}),
        ({"trip_duration_min": 0}, {"duree_plausible_1_240min"}),
        ({"trip_duration_min": 241}, {"duree_plausible_1_240min"}),
        ({"trip_duration_min": None}, {"duree_plausible_1_240min"}),
        ({"tip_pct": 101.0}, {"tip_pct_borne_0_100"}),
        ({"tip_pct": None}, {"tip_pct_borne_0_100"}),
        ({"pu_borough": None}, {"jointure_zones_ok"}),
    ],
)
def test_each_check_fails_on_its_own(table, changes, failed):
    assert failing(table(**changes)) == failed


def test_limits_of_duration_pass(table):
    assert not failing(table(trip_duration_min=1)) and not failing(table(trip_duration_min=240))


def test_shares(table):
    mixed = table(990).union(table(10, tip_pct=200.0))
    assert "tip_pct_borne_0_100" in failing(mixed)  # exactly 99 % is not more than 99 %
    assert "tip_pct_borne_0_100" not in failing(table(991).union(table(9, tip_pct=200.0)))
    only_known_count = table(1000).union(table(500, tip_pct=None))
    assert "tip_pct_borne_0_100" not in failing(only_known_count)
    lost = results(table(95).union(table(5, pu_borough=None)))["jointure_zones_ok"]
    assert not lost["passed"] and lost["failed_rows"] == 5


def test_clear_identifier_fails(table):
    leaked = table().withColumn("driver_email", F.lit("driver1@example.test"))
    assert failing(leaked) == {"rgpd_pas_de_pii_claire"}


def test_empty_table(table):
    report = results(table(0))
    assert {n for n, r in report.items() if not r["passed"]} == {
        "volume_non_vide", "tip_pct_borne_0_100", "jointure_zones_ok",
    }
    assert report["tip_pct_borne_0_100"]["detail"] == "nan% dans [0,100]"
    missing = results(table(0).drop("pickup_ts"))
    assert missing["non_null__pickup_ts"]["passed"]


def test_missing_columns(table):
    bare = results(table().select("driver_pseudo"))
    assert set(bare) == {
        "volume_non_vide", "non_null__pickup_ts", "non_null__total_amount", "non_null__pu_location_id",
        "rgpd_pas_de_pii_claire",
    }
    assert not bare["non_null__pickup_ts"]["passed"]
    assert bare["non_null__pickup_ts"]["failed_rows"] == 10


def test_gate_stops_on_critical_only(table):
    assert len(quality_gate(quality_report(table(pu_borough=None)))) == 9
    with pytest.raises(QualityGateError, match="total_amount_positif"):
        quality_gate(quality_report(table(total_amount=-1.0)))


def test_report_is_one_pass(table):
    """One scan and one exchange of a single row per task."""
    plan = quality_report(table())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
