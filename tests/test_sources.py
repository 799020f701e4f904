"""Landing, partitioned layers, tables, documents: written and read back."""

import hashlib
import json
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException

from martkit.operators.runmetrics import METRIC_SCHEMA, append_metrics, observed
from martkit.sources import landing, layers
from martkit.sources.documents import NO_METRICS, read_metrics, to_json_rows, write_metrics
from martkit.sources.landing import (
    key_versions,
    land_trips,
    land_weather,
    land_zones,
    load_weather,
    load_zones,
    rekey_month,
    union_by_name,
    with_lineage,
)
from martkit.sources.schemas import LANDED_TRIPS, LANDED_WEATHER, ML_METRICS, RAW_ZONES
from martkit.testbed import adapters

MONTH_1 = """CAST(1 AS INT) AS VendorID, TIMESTAMP_NTZ'2024-01-05 10:00:00' AS tpep_pickup_datetime,
  TIMESTAMP_NTZ'2024-01-05 10:20:00' AS tpep_dropoff_datetime, 2.0D AS passenger_count,
  3.5D AS trip_distance, CAST(10 AS INT) AS PULocationID, CAST(20 AS INT) AS DOLocationID,
  CAST(1 AS BIGINT) AS payment_type, 12.5D AS fare_amount, CAST('NaN' AS DOUBLE) AS tip_amount,
  15.0D AS total_amount, 1.25D AS Airport_fee"""
# The next month delivers wider ids, whole passenger numbers, another letter case and a new column.
MONTH_2 = (
    MONTH_1.replace("CAST(1 AS INT) AS VendorID", "CAST(2 AS BIGINT) AS vendorid")
    .replace("CAST(10 AS INT)", "CAST(10 AS BIGINT)")
    .replace("2.0D AS passenger_count", "CAST(2 AS BIGINT) AS passenger_count")
    .replace("AS Airport_fee", "AS airport_fee, 0.75D AS cbd_fee")
    .replace("2024-01-05", "2024-02-05")
)


@pytest.fixture
def months(spark, tmp_path):
    paths = {}
    for month, columns in (("2024-01", MONTH_1), ("2024-02", MONTH_2)):
        paths[month] = f"{tmp_path}/trips_{month}.parquet"
        spark.sql(f"SELECT {columns} FROM range(0, 7, 1, 1)").write.parquet(paths[month])
    return paths


def test_land_months_with_drift(spark, months, tmp_path):
    root = f"{tmp_path}/bronze/trips"
    assert {m: land_trips(spark, p, root, m, "salt") for m, p in months.items()} == {
        "2024-01": 7, "2024-02": 7,
    }
    trips = layers.read_layer(spark, root, LANDED_TRIPS)
    assert trips.count() == 14
    row = trips.filter("month = '02'").first()
    assert (row.vendorid, row.pulocationid, row.passenger_count, row.airport_fee) == (2, 10, 2.0, 1.25)
    assert row.tip_amount is None and row.year == 2024 and row.congestion_surcharge is None
    wanted = {f"driver{k * 2654435761 % 5000}@example.test" for k in range(7)}
    assert {r.driver_email for r in trips.filter("month = '01'").collect()} == wanted
    for r in trips.collect():
        assert r.driver_pseudo == hashlib.sha256(f"salt{r.driver_email}".encode()).hexdigest()[:16]
        assert r._source_file.endswith(".parquet") and r._ingested_at is not None
    extra = layers.read_layer(spark, root).filter("month = 2")
    assert {r.cbd_fee for r in extra.collect()} == {0.75}


def test_landing_a_month_again_replaces_only_it(spark, months, tmp_path):
    root = f"{tmp_path}/bronze/trips"
    for month, path in months.items():
        land_trips(spark, path, root, month, "salt")
    one = spark.sql(f"SELECT {MONTH_2}")
    one.write.parquet(f"{tmp_path}/again.parquet")
    assert land_trips(spark, f"{tmp_path}/again.parquet", root, "2024-02", "salt") == 1
    landed = layers.read_layer(spark, root, LANDED_TRIPS).groupBy("month").count()
    counts = {r.month: r["count"] for r in landed.collect()}
    assert counts == {"01": 7, "02": 1}


def test_a_month_without_rows_replaces_the_old_one(spark, months, tmp_path):
    root = f"{tmp_path}/bronze/trips"
    for month, path in months.items():
        land_trips(spark, path, root, month, "salt")
    spark.sql(f"SELECT {MONTH_2}").limit(0).write.parquet(f"{tmp_path}/none.parquet")
    assert land_trips(spark, f"{tmp_path}/none.parquet", root, "2024-02", "salt") == 0
    landed = layers.read_layer(spark, root, LANDED_TRIPS).groupBy("month").count()
    assert {r.month: r["count"] for r in landed.collect()} == {"01": 7}


def test_rows_get_the_same_numbers_in_one_file_or_several(spark, tmp_path):
    rows = spark.sql(f"SELECT id, {MONTH_1} FROM range(0, 100, 1, 1)")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    rows.repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(f"{tmp_path}/four")
    found = []
    for layout in ("one", "four"):
        land_trips(spark, f"{tmp_path}/{layout}", f"{tmp_path}/to-{layout}", "2024-01", "salt")
        landed = spark.read.parquet(f"{tmp_path}/to-{layout}")
        found.append({(r.id, r._source_row, r.driver_email) for r in landed.collect()})
    assert found[0] == found[1] and {(i, n) for i, n, _ in found[0]} == {(i, i) for i in range(100)}


def test_files_of_a_month_may_differ_in_width(spark, tmp_path):
    for name, columns in (("a", MONTH_1), ("b", MONTH_2)):
        spark.sql(f"SELECT {columns}").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    (tmp_path / "month").mkdir()
    for name in ("a", "b"):
        [part] = (tmp_path / name).glob("*.parquet")
        part.rename(tmp_path / "month" / f"{name}.parquet")
    assert land_trips(spark, f"{tmp_path}/month", f"{tmp_path}/to", "2024-01", "salt") == 2
    landed = layers.read_layer(spark, f"{tmp_path}/to", LANDED_TRIPS).orderBy("_source_row").collect()
    assert [(r._source_file, r._source_row, r.vendorid, r.passenger_count) for r in landed] == [
        ("a.parquet", 0, 1, 2.0), ("b.parquet", 1, 2, 2.0),
    ]


def test_month_filter_prunes_folders(spark, months, tmp_path):
    root = f"{tmp_path}/bronze/trips"
    for month, path in months.items():
        land_trips(spark, path, root, month, "salt")
    chosen = layers.for_months(layers.read_layer(spark, root, LANDED_TRIPS), ["2024-02"])
    assert {r.month for r in chosen.collect()} == {"02"}
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_zones(spark, tmp_path):
    source = tmp_path / "zones.csv"
    source.write_text(
        'LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n264,Unknown,N/A,N/A\n265,,x,NaN\n'
    )
    rows = {r.location_id: tuple(r)[1:] for r in load_zones(spark, str(source)).collect()}
    assert rows == {
        1: ("EWR", "Newark, Airport", "EWR"),
        264: ("Unknown", None, None),
        265: (None, "x", None),
    }
    stored = f"{tmp_path}/bronze/zones"
    assert land_zones(spark, str(source), stored) == 3
    assert land_zones(spark, str(source), stored) == 3
    assert layers.read_layer(spark, stored, RAW_ZONES).count() == 3


def test_weather(spark, tmp_path):
    daily = {
        "time": ["2024-02-01", "2024-02-02"],
        "temperature_2m_mean": [1.5, None],
        "temperature_2m_max": [3.0, 4.0],
        "precipitation_sum": [0.0, 2.5],
    }
    source = tmp_path / "weather.json"
    source.write_text(json.dumps({"latitude": 1.0, "daily": daily}, indent=2))
    rows = [tuple(r) for r in load_weather(spark, str(source)).collect()]
    assert rows == [("2024-02-01", 1.5, 3.0, 0.0), ("2024-02-02", None, 4.0, 2.5)]
    assert land_weather(spark, str(source), f"{tmp_path}/w", "2024-02") == 2
    stored = layers.read_layer(spark, f"{tmp_path}/w", LANDED_WEATHER)
    assert {(r.year, r.month) for r in stored.collect()} == {(2024, "02")}


def test_lineage(spark, tmp_path):
    path = f"{tmp_path}/x"
    spark.range(2).coalesce(1).write.parquet(path)
    row = with_lineage(spark.read.parquet(path)).first()
    assert row._source_file.endswith(".parquet")
    assert with_lineage(spark.range(1), "given.parquet").first()._source_file == "given.parquet"


def test_union_by_name(spark):
    out = union_by_name([spark.sql("SELECT 1 AS a, 2 AS b"), spark.sql("SELECT 3 AS b, 4 AS c")])
    assert sorted(map(str, out.collect())) == ["Row(a=1, b=2, c=None)", "Row(a=None, b=3, c=4)"]


def test_read_folder_of_any_depth(spark, tmp_path):
    for part in ("a", "b/c"):
        spark.range(2).write.parquet(f"{tmp_path}/tree/{part}")
    schema = spark.range(1).schema
    assert layers.read_folder(spark, f"{tmp_path}/tree", schema).count() == 4


def test_clustered_write_opens_few_files(spark, tmp_path):
    df = spark.range(0, 8000, 1, 8).selectExpr("id", "2024 AS year", "1 + id % 4 AS month")
    layers.write_partitioned(df, f"{tmp_path}/t", cluster=True)
    assert len(list((tmp_path / "t").glob("year=2024/month=0*/*.parquet"))) <= 8
    assert spark.read.parquet(f"{tmp_path}/t").count() == 8000


def test_columns_can_be_derived_after_rows_are_brought_together(spark, tmp_path):
    df = spark.range(400).selectExpr("id", "CAST(2020 + id % 2 AS INT) AS year", "CAST(1 + id % 12 AS INT) AS month")
    shuffled = []

    def derive(rows):
        shuffled.append(rows)
        return rows.selectExpr("id", "sha2(CAST(id AS STRING), 512) AS wide", "year", "month")

    layers.write_partitioned(df, f"{tmp_path}/t", cluster=True, derive=derive)
    assert shuffled[0].columns == ["id", "year", "month"]
    assert "RebalancePartitions" in shuffled[0]._jdf.queryExecution().optimizedPlan().toString()
    written = layers.read_layer(spark, f"{tmp_path}/t", "id long, wide string, year int, month string")
    rows = written.selectExpr("id", "wide = sha2(CAST(id AS STRING), 512) AS same", "year", "month").collect()
    assert sorted(map(tuple, rows)) == [(i, True, 2020 + i % 2, f"{1 + i % 12:02d}") for i in range(400)]
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 24


def test_landing_shuffles_only_what_trips_are_made_of(spark, sf_dir, monkeypatch):
    made = []

    def watched(df, path, by=("year", "month"), cluster=False, derive=None):
        made.append((df, cluster))
        write(df, path, by, cluster, derive)

    write = layers.write_partitioned
    monkeypatch.setattr(adapters, "write_partitioned", watched)
    monkeypatch.setattr(adapters, "_landed", {})
    trips, derived = adapters.raw_trips(spark, sf_dir), adapters.derive_trips(spark, sf_dir)
    assert made[0][1] and not {"trip_key", "driver_email", "driver_pseudo"} & set(made[0][0].columns)
    assert trips.columns == derived.columns
    assert trips.exceptAll(derived).count() == derived.exceptAll(trips).count() == 0


def test_numbering_rows_never_shuffles_them(spark, tmp_path):
    path = f"{tmp_path}/in"
    spark.range(100).selectExpr("id AS vendorid", "1.0D AS fare_amount").repartitionByRange(5, "vendorid").write.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a delivery whose estimated size is beyond it
    try:
        trips = landing.read_trip_source(spark, path)
        assert "SortMergeJoin" not in trips._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, trips.select("vendorid", "_source_row").collect())) == [(i, i) for i in range(100)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_register_table(spark, tmp_path, name):
    path = f"{tmp_path}/ext"
    spark.range(3).selectExpr("id", "2024 AS year").write.partitionBy("year").parquet(path)
    schema = spark.range(1).selectExpr("id", "CAST(2024 AS INT) AS year").schema
    layers.register_table(spark, f"db_{name}.ext", schema, path, partitioned_by=["year"])
    assert spark.table(f"db_{name}.ext").count() == 3
    spark.sql(f"DROP DATABASE db_{name} CASCADE")


def test_build_table_and_rebuild(spark, tmp_path, name):
    path = f"{tmp_path}/built"
    assert layers.build_table(spark, name, spark.range(3), path).count() == 3
    with pytest.raises(AnalysisException):
        layers.build_table(spark, name, spark.range(1), path, replace=False)
    assert layers.build_table(spark, name, spark.range(5), path).count() == 5
    assert spark.read.parquet(path).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_views(spark, name):
    layers.register_views(spark, {name: spark.range(4)})
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 4


def test_months(spark):
    assert layers.parse_months(" 2024-01, ,2024-02,") == ["2024-01", "2024-02"]
    lists = spark.createDataFrame([("2023-12, 2024-02",), ("",)], "months string")
    rows = [tuple(r) for r in layers.month_spans(lists).orderBy("month").collect()]
    assert rows == [
        ("2023-12", date(2023, 12, 1), date(2023, 12, 31)),
        ("2024-02", date(2024, 2, 1), date(2024, 2, 29)),
    ]


def test_layer_counts(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/here")
    counts = layers.layer_counts(spark, {"here": f"{tmp_path}/here", "gone": f"{tmp_path}/gone"})
    assert {r.layer: r.row_count for r in counts.collect()} == {"here": 5, "gone": None}
    (tmp_path / "damaged").mkdir()
    (tmp_path / "damaged" / "part-0.parquet").write_bytes(b"not a table")
    assert layers.layer_counts(spark, {"damaged": f"{tmp_path}/damaged"}).first().row_count is None


def test_json_rows(spark, tmp_path):
    df = spark.createDataFrame([("é", None, 1.5), ("b", 2, None)], "s string, n bigint, x double")
    texts = [json.loads(r.value) for r in to_json_rows(df, f"{tmp_path}/j").collect()]
    assert texts == [{"s": "é", "n": None, "x": 1.5}, {"s": "b", "n": 2, "x": None}]
    assert sorted(map(str, spark.read.schema(df.schema).json(f"{tmp_path}/j").collect())) == sorted(
        map(str, df.collect())
    )


def test_metrics_document(spark, tmp_path):
    path = f"{tmp_path}/m"
    assert read_metrics(spark, path).first().asDict() == {"error": NO_METRICS}
    (tmp_path / "empty").mkdir()
    assert read_metrics(spark, f"{tmp_path}/empty").first().asDict() == {"error": NO_METRICS}
    row = ("r", "M", 8, 2, (1.0, 2.0), (0.5, 1.0, 0.9), 50.0, {"a": 0.75, "b": 0.25}, 1)
    write_metrics(spark.createDataFrame([row], ML_METRICS), path)
    back = read_metrics(spark, path).first()
    assert back.feature_importance == {"a": 0.75, "b": 0.25}
    assert (back.baseline.mae, back.model_metrics.r2, back.anomalies_detected) == (1.0, 0.9, 1)


def test_observed_rows_and_metrics_table(spark, tmp_path):
    watched = observed(spark.range(10), "numbers", layer="bronze")
    watched.df.write.parquet(f"{tmp_path}/n")
    assert watched.rows == 10
    for value in (10, 20):
        append_metrics(spark, f"{tmp_path}/metrics", [("RowsIngested", value, watched.tags)])
    table = spark.read.schema(METRIC_SCHEMA).parquet(f"{tmp_path}/metrics")
    rows = {(r.name, r.value, r.tags["layer"]) for r in table.collect()}
    assert rows == {("RowsIngested", 10.0, "bronze"), ("RowsIngested", 20.0, "bronze")}
    assert isinstance(table.first().recorded_at, datetime)


def test_a_month_gets_another_salt(spark, tmp_path):
    root = f"{tmp_path}/trips"
    rows = spark.range(40).selectExpr("id AS VendorID", "double(id) AS fare_amount", "'x' AS surplus")
    rows.coalesce(1).write.parquet(f"{tmp_path}/source.parquet")
    for month, version in (("2024-01", 1), ("2024-02", 1), ("2024-03", None)):
        assert land_trips(spark, f"{tmp_path}/source.parquet", root, month, "old", key_version=version) == 40
    before = spark.read.parquet(f"{root}/year=2024/month=02").drop("driver_pseudo", "_key_version").collect()
    assert rekey_month(spark, root, "2024-02", "new", 2) == 40
    after = spark.read.parquet(f"{root}/year=2024/month=02")
    assert sorted(map(str, after.drop("driver_pseudo", "_key_version").collect())) == sorted(map(str, before))
    assert {(r.year, int(r.month), r.key_version, r.rows) for r in key_versions(spark, root).collect()} == {
        (2024, 1, 1, 40), (2024, 2, 2, 40), (2024, 3, None, 40),
    }
    for month, salt in ((1, "old"), (2, "new"), (3, "old")):
        for r in spark.read.parquet(f"{root}/year=2024/month={month:02d}").collect():
            assert r.driver_pseudo == hashlib.sha256(f"{salt}{r.driver_email}".encode()).hexdigest()[:16]
    rekey_month(spark, root, "2024-02", "old", 3)  # back again: the same pseudonyms as ever
    assert {r.driver_pseudo for r in spark.read.parquet(f"{root}/year=2024/month=02").collect()} == {
        r.driver_pseudo for r in spark.read.parquet(f"{root}/year=2024/month=01").collect()
    }


@pytest.mark.parametrize("opened", [True, False])
def test_many_files_in_two_widths(spark, tmp_path, monkeypatch, opened):
    """The number of jobs doesn't grow with the files, unless workers can't open them; what is landed is the same."""
    def unopened(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"path": batch.column("path"), "mark": pa.nulls(batch.num_rows, pa.string())})

    files = 400 if opened else 6
    for i in range(files):
        wide = pa.int64() if i % 2 else pa.float64()
        names = ("VendorID", "passenger_count") if i % 3 else ("vendorid", "Passenger_Count")
        columns = [pa.array([i, i + 1], pa.int64()), pa.array([1, None], wide)]
        (tmp_path / "in").mkdir(exist_ok=True)
        pq.write_table(pa.table(columns, names=list(names)), f"{tmp_path}/in/part-{i:05d}.parquet")
    if not opened:
        monkeypatch.setattr(landing, "_footer_marks", unopened)
    group = f"landing-{opened}"
    spark.sparkContext.setJobGroup(group, "landing")
    try:
        rows = land_trips(spark, f"{tmp_path}/in", f"{tmp_path}/out", "2024-01", "salt")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows == 2 * files
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert 0 < jobs < 60
    landed = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.vendorid for r in landed.collect()) == sorted([*range(files), *range(1, files + 1)])
    numbers = sorted((r._source_row, r._source_file) for r in landed.collect())
    assert numbers == [(i, f"part-{i // 2:05d}.parquet") for i in range(2 * files)]
    assert landed.filter("passenger_count = 1").count() == files
