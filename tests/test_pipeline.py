"""The whole run on month files derived from the driver tables."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martkit.operators.quality import QualityGateError
from martkit.operators.reads import kpis, top_errors, top_zones
from martkit.operators.runmetrics import METRIC_SCHEMA
from martkit.plans.pipeline import PARTS, SILVER, Lake, Run, Sources, read_table, run_pipeline, score_months
from martkit.sources import schemas
from martkit.sources.documents import read_metrics
from martkit.sources.layers import read_layer
from martkit.testbed import adapters

MONTHS = ["1997-03", "1997-04"]


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """Month files as delivered: trips in Parquet, weather in JSON, zones in CSV."""
    folder = tmp_path_factory.mktemp("sources")
    sf_dir = "/root/testdata/sf0.01"
    trips = adapters.derive_trips(spark, sf_dir).drop("driver_email", "driver_pseudo", "trip_key")
    weather = adapters.derive_weather(spark, sf_dir)
    for month in MONTHS:
        year, number = month.split("-")
        rows = trips.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == month)
        rows.drop("year", "month").coalesce(1).write.parquet(f"{folder}/trips_{month}.parquet")
        days = weather.filter(F.col("weather_date").startswith(month)).orderBy("weather_date").collect()
        daily = {("time" if c == "weather_date" else c): [d[c] for d in days] for c in weather.columns}
        (folder / f"weather_{month}.json").write_text(json.dumps({"daily": daily}))
    zones = adapters.derive_zones(spark, sf_dir).collect()
    lines = ["LocationID,Borough,Zone,service_zone"]
    lines += [f"{z.location_id},{z.borough},{z.zone_name},N/A" for z in zones]
    (folder / "zones.csv").write_text("\n".join(lines) + "\n")
    return Sources(
        trips=f"{folder}/trips_{{month}}.parquet",
        weather=f"{folder}/weather_{{month}}.json",
        zones=f"{folder}/zones.csv",
    )


@pytest.fixture(scope="module")
def lake(spark, sources, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    report = run_pipeline(spark, root, sources, MONTHS, "salt", trees=5, depth=4, fit_rows=900)
    return Lake(root), report.first()


def test_report(lake):
    _, report = lake
    assert report.error_rate == "0/4"
    assert [(s.step, s.status) for s in report.steps] == [
        ("bronze", "OK"), ("silver_gold", "OK"), ("quality", "OK"), ("ml", "OK"),
    ]
    assert report.rows_per_layer["silver_trips"] > 900
    assert report.total_seconds > 0


def test_layers(spark, lake):
    place, report = lake
    silver = read_table(spark, place, "silver_trips")
    assert silver.columns == schemas.STORED_SILVER.names
    assert silver.select("year", "month", "_source_row").distinct().count() == silver.count()
    assert silver.count() == report.rows_per_layer["silver_trips"]
    trips = read_layer(spark, place.trips, schemas.LANDED_TRIPS)
    assert {(r.year, r.month) for r in trips.select("year", "month").distinct().collect()} == {
        (1997, "03"), (1997, "04"),
    }
    assert "driver_email" in trips.columns
    demand = read_table(spark, place, "demand_by_zone_hour")
    assert demand.count() == report.rows_per_layer["gold_demand_by_zone_hour"]
    tips = read_table(spark, place, "tips_analysis")
    assert tips.count() == report.rows_per_layer["gold_tips_analysis"] > 0
    assert tips.filter("trips < 5").count() == 0
    assert kpis(demand).count() == 1 and top_zones(demand).count() <= 10


def test_learning_outputs(spark, lake):
    place, _ = lake
    metrics = read_metrics(spark, place.metrics).first()
    assert metrics.n_train + metrics.n_test > 900
    predictions = read_table(spark, place, "ml_predictions")
    assert predictions.count() == metrics.n_test
    assert predictions.filter("is_anomaly = 1").count() == metrics.anomalies_detected
    assert top_errors(predictions, 5).count() == 5


def test_metrics_table_and_report_file(spark, lake):
    place, report = lake
    metrics = spark.read.schema(METRIC_SCHEMA).parquet(f"{place.root}/run_metrics").collect()
    by_name = {(m.name, m.tags.get("table") or m.tags.get("month")): m.value for m in metrics}
    assert by_name[("RowsProcessed", "trips")] == report.rows_per_layer["silver_trips"]
    assert by_name[("QualityFailedChecks", None)] == 0
    assert by_name[("RowsIngested", "1997-03")] > 0
    stored = json.loads(spark.read.text(f"{place.root}/pipeline_run_report").first().value)
    assert stored["error_rate"] == "0/4"


def test_running_again_gives_the_same(spark, sources, lake):
    """One month again: the other one's folders are not touched, and model, metrics and predictions come out equal."""
    place, report = lake
    before = read_metrics(spark, place.metrics).drop("run_id").collect()
    rows = sorted(map(str, read_table(spark, place, "ml_predictions").collect()))
    other = Path(place.versions(spark).folders(SILVER, ["1997-04"])[0])
    stamps = {p.name: p.stat().st_mtime_ns for p in other.glob("*.parquet")}
    again = run_pipeline(spark, place.root, sources, MONTHS[:1], "salt", trees=5, depth=4, fit_rows=900).first()
    assert again.rows_per_layer == report.rows_per_layer
    assert place.versions(spark).folders(SILVER, ["1997-04"]) == [str(other)]
    assert stamps and {p.name: p.stat().st_mtime_ns for p in other.glob("*.parquet")} == stamps
    assert read_metrics(spark, place.metrics).drop("run_id").collect() == before
    assert sorted(map(str, read_table(spark, place, "ml_predictions").collect())) == rows


def test_one_month_again_reads_one_month(spark, sources, tmp_path):
    """The other month's clean rows are gone, and nobody misses them: its parts and check counters are still there."""
    run = Run(spark, Lake(str(tmp_path)), sources, MONTHS, "salt")
    run.land()
    run.transform()
    run.check()
    tested = dict((n, v) for n, v, _ in run.recorded)["QualityRowsTested"]


    def marts():
        """Both marts without the floor, which hides all groups of the first at this size, and the second as stored."""
        versions = run.lake.versions(spark)
        found = [mart.merge(versions.read(place, schema), k=1) for place, _, mart, schema in PARTS]
        return [sorted(map(str, df.collect())) for df in [*found, read_table(spark, run.lake, "tips_analysis")]]

    before = marts()
    assert all(before)
    for file in Path(run.lake.versions(spark).folders(SILVER, MONTHS[1:])[0]).glob("*.parquet"):
        file.write_bytes(b"gone")
    again = Run(spark, run.lake, sources, MONTHS[:1], "salt")
    again.transform()
    again.check()
    assert dict((n, v) for n, v, _ in again.recorded)["QualityRowsTested"] == tested
    assert marts() == before


def test_a_later_month_is_predicted(spark, sources, tmp_path):
    """A month that came after the training is predicted with the stored model and joins the mart; a new model starts anew."""
    options = {"trees": 3, "depth": 3, "fit_rows": 400}
    root = str(tmp_path)
    run_pipeline(spark, root, sources, MONTHS[:1], "salt", **options)
    tested = read_table(spark, Lake(root), "ml_predictions").count()
    later = Run(spark, Lake(root), sources, MONTHS[1:], "salt")
    later.land()
    later.transform()
    silver = later.silver().filter("pickup_date >= '1997-04-01'")
    for _ in range(2):  # again: replaced, not added
        assert score_months(spark, root, MONTHS[1:]) == {MONTHS[1]: silver.count()}
        mart = read_table(spark, Lake(root), "ml_predictions")
        assert mart.count() == tested + silver.count() and mart.columns == schemas.PREDICTIONS.names
    totals = F.sum(F.round(100 * F.col("actual_total")).cast("long"))
    wanted = silver.select(F.sum(F.round(100 * F.col("total_amount")).cast("long"))).first()[0]
    assert mart.filter("pickup_date >= '1997-04-01'").select(totals).first()[0] == wanted
    run_pipeline(spark, root, sources, MONTHS[1:], "salt", **options)
    assert read_table(spark, Lake(root), "ml_predictions").count() == read_metrics(spark, Lake(root).metrics).first().n_test


def test_a_step_is_tried_again(spark, sources, tmp_path, monkeypatch):
    from martkit.plans import pipeline

    calls, real = [], pipeline.land_zones

    def late(*args):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("not there yet")
        return real(*args)

    monkeypatch.setattr(pipeline, "land_zones", late)
    options = {"trees": 2, "depth": 2, "fit_rows": 100, "delay": 0.0}
    report = run_pipeline(spark, str(tmp_path), sources, MONTHS[:1], "salt", **options).first()
    assert [(s.step, s.attempts) for s in report.steps][:2] == [("bronze", 2), ("silver_gold", 1)]
    metrics = spark.read.schema(METRIC_SCHEMA).parquet(f"{tmp_path}/run_metrics")
    assert metrics.filter("name = 'RowsIngested'").count() == 1


def test_a_failing_step_keeps_its_error(spark, sources, tmp_path, monkeypatch):
    from martkit.plans import pipeline

    def broken(*args):
        (tmp_path / "silver" / "trips").mkdir(parents=True, exist_ok=True)
        (tmp_path / "silver" / "trips" / "part-0.parquet").write_bytes(b"damaged")
        raise OSError("the step's own error")

    monkeypatch.setattr(pipeline, "land_zones", broken)
    with pytest.raises(OSError, match="own error"):
        run_pipeline(spark, str(tmp_path), sources, MONTHS[:1], "salt", attempts=2, delay=0.0)
    stored = json.loads(spark.read.text(f"{tmp_path}/pipeline_run_report").first().value)
    assert stored["steps"][0]["attempts"] == 2 and stored["rows_per_layer"]["silver_trips"] is None


def test_failing_check_stops_the_run(spark, sources, tmp_path, monkeypatch):
    from martkit.plans import pipeline

    real = pipeline.build_silver
    spoiled = F.when(F.col("pickup_hour") == 7, -1.0).otherwise(F.col("total_amount"))
    monkeypatch.setattr(
        pipeline, "build_silver", lambda *a: real(*a).withColumn("total_amount", spoiled)
    )
    with pytest.raises(QualityGateError, match="total_amount_positif"):
        run_pipeline(spark, str(tmp_path), sources, MONTHS[:1], "salt")
    stored = json.loads(spark.read.text(f"{tmp_path}/pipeline_run_report").first().value)
    assert stored["error_rate"] == "1/3"
    assert not (tmp_path / "gold" / "ml_metrics").exists()


def test_a_failed_run_goes_on_where_it_stopped(spark, sources, tmp_path, monkeypatch):
    from martkit.plans import ledger, pipeline

    def run(**more):
        options = {"trees": 2, "depth": 2, "fit_rows": 100, "delay": 0.0, "attempts": 1, **more}
        return run_pipeline(spark, str(tmp_path), sources, MONTHS[:1], "salt", **options).first()

    def statuses(report):
        return [s.status for s in report.steps]

    def broken(*args):
        raise OSError("no")

    real_gate, real_train = pipeline.quality_gate, pipeline.train_and_score
    monkeypatch.setattr(pipeline, "quality_gate", broken)
    with pytest.raises(OSError, match="no"):
        run()
    monkeypatch.setattr(pipeline, "quality_gate", real_gate)
    monkeypatch.setattr(pipeline, "train_and_score", broken)
    monkeypatch.setattr(pipeline, "land_trips", broken)  # would be called by a run that starts anew
    with pytest.raises(OSError, match="no"):
        run()
    monkeypatch.setattr(pipeline, "train_and_score", real_train)
    report = run()
    assert statuses(report) == ["SKIPPED", "SKIPPED", "SKIPPED", "OK"] and report.error_rate == "0/4"
    assert [s.attempts for s in report.steps] == [0, 0, 0, 1]
    entries = ledger.read_ledger(spark, str(tmp_path))
    assert entries.filter("status = 'OK'").groupBy("step").count().filter("count != 1").count() == 0
    for more in ({}, {"trees": 3}, {"resume": False}):  # the last run came to its end; other settings; on request
        with pytest.raises(OSError, match="no"):
            run(**more)


def test_another_delivery_is_not_skipped(spark, tmp_path):
    from martkit.plans import ledger

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1")
    steps, root = ["one", "two", "three"], str(tmp_path / "lake")

    def key(**settings):
        return ledger.delivery_key(spark, [str(tmp_path / "in")], settings, "salt")

    first = key(months="m")
    assert first == key(months="m") != key(months="n") and len(first) == 64
    assert ledger.delivery_key(spark, [str(tmp_path / "none")], {}, "salt") is None
    assert ledger.finished_steps(spark, root, first, steps, 0) == 0
    ledger.note(spark, root, "r1", first, 0, "one", ledger.OK, 0)
    ledger.note(spark, root, "r1", first, 1, "two", ledger.OK, 4)
    assert ledger.finished_steps(spark, root, first, steps, 4) == 2
    assert ledger.finished_steps(spark, root, first, steps, 5) == 0  # somebody else has committed
    assert ledger.finished_steps(spark, root, None, steps, 4) == 0
    (tmp_path / "in" / "b.csv").write_text("2")
    assert key(months="m") != first and ledger.finished_steps(spark, root, key(months="m"), steps, 4) == 0
    ledger.note(spark, root, "r2", key(months="m"), -1, "", ledger.STARTED, 4)
    assert ledger.finished_steps(spark, root, first, steps, 4) == 0  # that run is no longer the last one
