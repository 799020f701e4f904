"""Preparation, baseline, forest, outliers and the documents around them."""

import math
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit.operators import learning
from martkit.operators.isoforest import IsolationForest, average_path
from martkit.sources import models
from martkit.sources.schemas import ML_METRICS, PREDICTIONS
from martkit.sources.versions import Versions
from martkit.testbed import registry


@pytest.fixture(scope="module")
def silver(spark):
    """Trips whose total follows the distance, with weather gaps and a few absurd totals."""
    return spark.range(3_000).selectExpr(
        "id AS key",
        "DATE'2024-01-01' + CAST(id % 28 AS INT) AS pickup_date",
        "concat('Z', id % 5) AS pu_zone",
        "'B' AS pu_borough",
        "1D + (id * 7919 % 1000) / 100D AS trip_distance",
        "CAST(1 + id % 4 AS INT) AS passenger_count",
        "CAST(id % 24 AS INT) AS pickup_hour",
        "CAST(1 + id % 7 AS INT) AS pickup_dow_iso",
        "id % 7 >= 5 AS is_weekend",
        "id % 24 BETWEEN 7 AND 9 AS is_rush_hour",
        "CAST(id % 30 AS INT) AS pu_location_id",
        "CAST(id % 29 AS INT) AS do_location_id",
        "IF(id % 10 = 0, NULL, CAST(id % 20 AS DOUBLE)) AS temp_mean_c",
        "IF(id % 10 = 1, CAST('NaN' AS DOUBLE), CAST(id % 3 AS DOUBLE)) AS precip_mm",
        "CAST(10 + id % 30 AS BIGINT) AS trip_duration_min",
        "1D AS tip_amount",
        "IF(id % 600 = 5, 900D, 3D + 2.5D * (1D + (id * 7919 % 1000) / 100D)) AS total_amount",
    )


def test_imputation_and_complete_rows(silver):
    filled = learning.impute_median(silver)
    assert filled.filter("temp_mean_c IS NULL OR isnan(precip_mm) OR precip_mm IS NULL").count() == 0
    gap = filled.filter("key = 10").first()
    known = [i % 20 for i in range(3000) if i % 10]
    assert gap.temp_mean_c == float(np.median(known))
    assert learning.complete_rows(silver).count() == 3000 - 300 - 300
    assert learning.prepare(silver).schema["is_weekend"].dataType.typeName() == "integer"


def test_metrics_equal_definition(spark):
    y, p = [1.0, 2.0, 4.0, 8.0], [1.5, 2.0, 3.0, 9.0]
    row = learning.regression_metrics(
        spark.createDataFrame(list(zip(y, p, strict=True)), "y double, p double"), "y", "p"
    ).first()
    e = np.array(y) - np.array(p)
    assert math.isclose(row.mae, np.abs(e).mean())
    assert math.isclose(row.rmse, math.sqrt((e**2).mean()))
    assert math.isclose(row.r2, 1 - (e**2).sum() / ((np.array(y) - np.mean(y)) ** 2).sum())
    gain = spark.range(1).select(learning.improvement_pct(F.lit(1.0), F.lit(4.0))).first()[0]
    assert gain == 75.0


def test_train_and_score(spark, silver, tmp_path):
    result = learning.train_and_score(silver, "key", trees=10, depth=6)
    metrics = result["metrics"].first()
    assert result["metrics"].schema.names == ML_METRICS.names
    assert (metrics.n_train, metrics.n_test) == (2400, 600)
    assert metrics.improvement_mae_pct > 30
    assert metrics.model_metrics.mae < metrics.baseline.mae
    assert abs(sum(metrics.feature_importance.values()) - 1) < 0.01
    assert metrics.anomalies_detected <= 12
    predictions = result["predictions"]
    assert predictions.schema.names == PREDICTIONS.names
    assert predictions.count() == 600
    assert predictions.filter("abs(abs_error - abs(actual_total - predicted_total)) > 0.006").count() == 0
    ranked = learning.importance_rows(result["metrics"]).collect()
    assert ranked[0].variable == "trip_distance"
    assert [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)

    again = learning.train_and_score(silver.repartition(7), "key", trees=10, depth=6)
    assert again["metrics"].drop("run_id").first() == result["metrics"].drop("run_id").first()


def test_published_models(spark, silver, tmp_path):
    """What is loaded predicts as what was fitted; an older run can still be loaded by its id."""
    versions, rows = Versions(spark, str(tmp_path)), silver.filter("total_amount > 20")
    with pytest.raises(LookupError):
        models.load_model(versions, "models")
    wanted = {}
    for run_id, trees in (("20240101T000000Z", 3), ("20240201T000000Z", 5)):
        fitted = learning.train_and_score(silver, "key", trees=trees, depth=4, run_id=run_id)["fitted"]
        versions.commit({"models": models.stage_model(versions, "models", fitted)})
        wanted[run_id] = sorted(map(str, learning.predict(fitted, rows).collect()))
    assert len(wanted[run_id]) == rows.count() and wanted["20240101T000000Z"] != wanted[run_id]
    assert list(models.published_runs(versions.latest(), "models")) == sorted(wanted)
    latest = models.load_model(versions, "models")
    assert latest.run_id == run_id and latest.model.getNumTrees == 5
    assert sorted(map(str, learning.predict(latest, rows).collect())) == wanted[run_id]
    first = models.load_model(versions, "models", "20240101T000000Z")
    assert sorted(map(str, learning.predict(first, rows).collect())) == wanted["20240101T000000Z"]


def test_later_rows_are_filled_with_the_training_median(spark, silver):
    fitted = learning.train_and_score(silver, "key", trees=2, depth=3)["fitted"]
    gaps = silver.limit(50).withColumn("temp_mean_c", F.lit(None).cast("double"))
    filled = silver.limit(50).withColumn("temp_mean_c", F.lit(fitted.medians["temp_mean_c"]))
    found, wanted = (sorted(map(str, learning.predict(fitted, d).collect())) for d in (gaps, filled))
    assert found == wanted and len(found) == 50
    assert learning.predict(fitted, silver.limit(0)).count() == 0


def test_mart_has_all_rows_unless_limited(spark, silver):
    scored = silver.withColumns({"prediction": F.lit(1.0), "is_anomaly": F.lit(1)})
    assert learning.prediction_mart(scored, "key", limit=100).count() == 100
    many = scored.crossJoin(spark.range(5)).withColumn("key", F.concat_ws("-", "key", "id"))
    assert learning.prediction_mart(many, "key").count() == 15_000


def test_only_the_fit_is_bounded(silver):
    result = learning.train_and_score(silver, "key", trees=2, depth=3, fit_rows=200)
    metrics = result["metrics"].first()
    assert (metrics.n_train, metrics.n_test) == (2400, 600)
    assert result["predictions"].count() == 600


def test_average_path():
    assert average_path(1) == 0 and average_path(2) == 1
    assert math.isclose(average_path(256), 10.2448, abs_tol=0.03)


def grown(x, seed, tree, height):
    """A tree by its definition: {node: (feature, cut)} and {leaf: rows}."""
    inner, leaves, waiting = {}, {}, [(0, 0, x)]
    while waiting:
        node, depth, rows = waiting.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        votes = [(md5(f"{seed}:{tree}:{node}:{i}".encode()).hexdigest(), i) for i in np.flatnonzero(low < high)]
        if depth == height or len(rows) == 1 or not votes:
            leaves[node] = len(rows)
            continue
        i = min(votes)[1]
        cut = low[i] + int(md5(f"{seed}:{tree}:{node}:cut".encode()).hexdigest()[:13], 16) / 2**52 * (high[i] - low[i])
        cut = cut if cut < high[i] else low[i]
        inner[node] = (i, cut)
        waiting += [(2 * node + 1, depth + 1, rows[rows[:, i] <= cut]), (2 * node + 2, depth + 1, rows[rows[:, i] > cut])]
    return inner, leaves


def test_trees_follow_their_definition(spark):
    data = spark.range(500).selectExpr("id", "sin(id) AS a", "IF(id % 3 = 0, NULL, cos(id)) AS b", "4D AS c", "double(id % 2) AS d")
    forest = IsolationForest(columns=["a", "b", "c", "d"], key="id", trees=6, max_samples=32)
    drawn, size = forest._draws(data)
    rows = {t: [] for t in range(6)}
    for r in drawn.collect():
        rows[r.tree].append([r.a, r.b, r.c, r.d])
    found = {(n.tree, n.node): n for n in forest.nodes(data)[0].collect()}
    wanted = 0
    for tree, x in rows.items():
        inner, leaves = grown(np.array(x), 42, tree, 5)
        wanted += len(inner) + len(leaves)
        assert {n: (found[tree, n].feature, found[tree, n].cut) for n in inner} == inner
        for n, k in leaves.items():
            assert found[tree, n].feature == -1 and math.isclose(found[tree, n].length, int(math.log2(n + 1)) + average_path(k), abs_tol=1e-8)
    assert wanted == len(found) and size == 32


def test_equal_rows_are_one_leaf(spark):
    data = spark.range(20).selectExpr("id", "1D AS a", "2D AS b")
    forest = IsolationForest(columns=["a", "b"], key="id", trees=3, max_samples=16)
    assert {(n.node, n.feature, round(n.length, 6)) for n in forest.nodes(data)[0].collect()} == {(0, -1, round(average_path(16), 6))}
    assert forest.fit_flag(data).filter("is_anomaly = 1").count() == 0


@pytest.mark.parametrize("rows", [3_000, 40])
def test_isolation_forest(spark, rows):
    cloud = spark.range(rows).selectExpr(
        "id", "sin(id) + 0.3D * cos(id * 1.7D) AS a", "cos(id * 2.3D) AS b", "IF(id = 9, NULL, 0D) AS c"
    )
    planted = spark.createDataFrame([(10**6 + i, 40.0 + i, -35.0, 9.0) for i in range(3)], cloud.schema)
    forest = IsolationForest(columns=["a", "b", "c"], key="id")
    data = cloud.union(planted)
    flagged = forest.fit_flag(data)
    total = rows + 3
    count = flagged.filter("is_anomaly = 1").count()
    assert abs(count - 0.02 * total) <= 1
    top = [r.id for r in flagged.orderBy(F.desc("anomaly_score")).limit(3).collect()]
    if rows == 3_000:
        assert set(top) == {10**6, 10**6 + 1, 10**6 + 2}
    again = forest.fit_flag(data.repartition(5))
    assert {(r.id, r.anomaly_score) for r in again.collect()} == {
        (r.id, r.anomaly_score) for r in flagged.collect()
    }


def test_scores_equal_a_walk_of_the_node_table(spark):
    """Brute force: follow every tree row by row through the stored nodes."""
    data = spark.range(60).selectExpr("id", "sin(id) AS a", "IF(id % 9 = 0, 5D, cos(id)) AS b")
    forest = IsolationForest(columns=["a", "b"], key="id", trees=7, max_samples=16)
    table, size = forest.nodes(data)
    nodes = {(n.tree, n.node): n for n in table.collect()}
    found = {r.id: r.anomaly_score for r in forest.score(data, forest.fit(data)).collect()}
    for row in data.collect():
        lengths = []
        for tree in range(7):
            node = nodes[tree, 0]
            while node.feature >= 0:
                goes_left = (row.a, row.b)[node.feature] <= node.cut
                node = nodes[tree, node.left if goes_left else node.right]
            lengths.append(node.length)
        wanted = 2 ** (-np.mean(lengths) / average_path(size))
        assert math.isclose(found[row.id], wanted, rel_tol=1e-9)


def test_trees_draw_from_all_rows(spark):
    """Beyond any pool: each tree's draw is spread over the whole table."""
    data = spark.range(200_000).selectExpr("id", "id * 1.0 AS a")
    drawn, size = IsolationForest(columns=["a"], key="id")._draws(data)
    rows = drawn.collect()
    assert size == 256 and len(rows) == 100 * 256
    values = [r.a for r in rows]
    assert len(set(values)) > 20_000
    tenths = np.bincount((np.array(values) / 20_000).astype(int), minlength=10)
    assert tenths.min() > 0.9 * len(rows) / 10


def test_draws_have_one_size(spark):
    data = spark.range(5_000).selectExpr("id", "id % 97 * 1.0 AS a")
    forest = IsolationForest(columns=["a"], key="id", trees=5, max_samples=16)
    drawn, size = forest._draws(data)
    sizes = {r["tree"]: r["count"] for r in drawn.groupBy("tree").count().collect()}
    assert size == 16 and sizes == dict.fromkeys(range(5), 16)
    assert forest.fit(data).feature.shape[0] == 5


def test_root_split(spark):
    """The split of one tree over all values is the one a plain search finds; a constant target has none."""
    rows = [(i % 17, (i * 7) % 5, 3.0 * (i % 17 > 11) + (i * 31 % 10) / 10) for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b int, y double")
    fit = {"trees": 1, "depth": 1, "columns": ("a", "b"), "target": "y", "bins": 64, "bootstrap": False}
    found = learning.root_split(learning.fit_price_model(df, **fit), ("a", "b"))
    left = [y for a, _, y in rows if a <= 11]
    right = [y for a, _, y in rows if a > 11]
    assert (found.variable, found.threshold) == ("a", 11.5)
    assert abs(found.left - sum(left) / len(left)) < 1e-9 and abs(found.right - sum(right) / len(right)) < 1e-9
    flat = df.selectExpr("a", "b", "1.0D AS y")
    assert learning.root_split(learning.fit_price_model(flat, **fit), ("a", "b")) is None


def test_groups_of_nodes_are_small_and_do_not_change_the_trees(silver, monkeypatch):
    rows = learning.prepare(silver)
    found = []
    for megabytes in (1, learning.NODE_STATISTICS_MB):
        monkeypatch.setattr(learning, "NODE_STATISTICS_MB", megabytes)
        model = learning.fit_price_model(rows, trees=3, depth=10, key="key", parts=2)
        assert model.getMaxMemoryInMB() == megabytes <= 256  # each core of an executor holds as much
        found.append(model.toDebugString.partition("\n")[2])
    assert found[0] == found[1]


def test_a_later_month_reads_its_own_rows_only(spark, sf_dir, monkeypatch):
    class Seen(Exception):
        pass

    def seen(fitted, rows):
        files = {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}
        months = {r[0] for r in rows.select(F.date_format("pickup_date", "'year='yyyy'/month='MM")).distinct().collect()}
        assert len(months) == 1 and all(next(iter(months)) in f for f in files)
        assert "PartitionFilters: []" not in rows._jdf.queryExecution().executedPlan().toString()
        raise Seen

    monkeypatch.setattr(learning, "predict", seen)
    with pytest.raises(Seen):
        registry.later_months(spark, sf_dir)


def test_the_price_model_is_fitted_on_all_training_rows(silver, spark, monkeypatch):
    class Seen(Exception):
        pass

    def seen(train, *args, **options):
        raise Seen(train.count())

    monkeypatch.setattr(learning, "fit_price_model", seen)
    many = silver.crossJoin(spark.range(90).select(F.col("id").alias("copy"))).withColumn("key", F.concat_ws("-", "key", "copy"))
    with pytest.raises(Seen) as found:
        learning.train_and_score(many, "key")
    assert found.value.args == (216_000,)  # four fifths of the rows


def test_thresholds_come_from_all_rows(spark):
    """One row of 60,000 decides, which a sample of rows for the thresholds would miss."""
    df = spark.range(60_000).selectExpr("int(id = 31) AS a", "id % 50 AS b", "IF(id = 31, 9000D, id % 50 / 100D) AS y")
    fit = {"trees": 1, "depth": 1, "columns": ("a", "b"), "target": "y", "bootstrap": False}
    found = learning.root_split(learning.fit_price_model(df, **fit), ("a", "b"))
    assert (found.variable, found.threshold, round(found.right, 6)) == ("a", 0.5, 9000.0)


def test_trees_grow_in_lots(spark, silver, monkeypatch):
    """With many rows a forest is put together from lots: trees of their own, each with the thresholds of the features."""
    rows = learning.prepare(silver)
    fit = {"depth": 4, "key": "key", "parts": 2}
    first = learning.fit_price_model(rows, trees=2, **fit)
    monkeypatch.setattr(learning, "FITTED_AT_ONCE", 2 * rows.count())
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = learning.fit_price_model(rows, trees=5, **fit)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    trees = [t.toDebugString.partition("\n")[2] for t in model.trees]
    assert model.getNumTrees == 5 and len(set(trees)) == 5
    assert trees[:2] == [t.toDebugString.partition("\n")[2] for t in first.trees]
    assert math.isclose(model.featureImportances.toArray().sum(), 1.0)
    row = learning.features(rows).first()
    assert math.isclose(model.predict(row.features), np.mean([t.predict(row.features) for t in model.trees]))
    assert abs(row.total_amount - model.predict(row.features)) < 10
