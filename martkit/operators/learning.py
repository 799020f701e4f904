"""Price regression on the clean layer: preparation, baseline, forest, metrics, exposed predictions."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce
from typing import TYPE_CHECKING, NamedTuple

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.portable import known, nan_to_null, scale_round
from martkit.operators.selection import exact_quantiles, sample_n, split, split_points
from martkit.session import scratch_path
from martkit.sources.layers import stored
from martkit.sources.schemas import ML_METRICS

if TYPE_CHECKING:
    from martkit.operators.isoforest import IsolationForest, Outliers

# Features in order, target, columns filled by their median, outlier features, sizes.
FEATURES = (
    "trip_distance",
    "passenger_count",
    "pickup_hour",
    "pickup_dow_iso",
    "is_weekend",
    "is_rush_hour",
    "pu_location_id",
    "do_location_id",
    "temp_mean_c",
    "precip_mm",
)
TARGET = "total_amount"
FLAGS = ("is_weekend", "is_rush_hour")
IMPUTED = ("temp_mean_c", "precip_mm")
OUTLIER_FEATURES = ("trip_distance", "trip_duration_min", "total_amount", "tip_amount")
TEST_SHARE = 0.2
SEED = 42
TREES = 60
DEPTH = 14
BINS = 32
ROWS_PER_PARTITION = 25_000
#: Without a sample. A task sends statistics of all nodes, however few rows it has: few large tasks send less.
TRAINING_ROWS_PER_PARTITION = 1 << 18
LEAST_PARTITIONS = 8
#: MLlib squares this number in 32 bits.
MOST_BINS = 46_340
#: Training rows times trees that grow at once, and how far apart the seeds of two lots of trees are: further than partitions.
FITTED_AT_ONCE = 25_000_000
SEED_STEP = 1_000_003
#: Memory of a task for the statistics of nodes. Every core of an executor runs such a task, and sends what it holds.
NODE_STATISTICS_MB = 128
MODEL_NAME = "RandomForestRegressor"


def impute_median(df: DataFrame, columns: Sequence[str] = IMPUTED) -> DataFrame:
    """Fill missing values of each column with its exact median; an empty column stays as it is."""
    return fill(df, medians(df, columns))


def medians(df: DataFrame, columns: Sequence[str] = IMPUTED) -> dict[str, float | None]:
    """Exact median of each column; None for an empty one."""
    return exact_quantiles(df, dict.fromkeys(columns, 0.5))


def fill(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Put a value in the place of what is missing in each column; None leaves a column as it is."""
    return df.withColumns({c: F.coalesce(known(c), F.lit(v).cast("double")) for c, v in values.items()})


def complete_rows(df: DataFrame, columns: Sequence[str] = (*FEATURES, TARGET)) -> DataFrame:
    """Drop rows that miss a feature or the target."""
    return nan_to_null(df).dropna(subset=list(columns))


def prepare(silver: DataFrame, imputed: Sequence[str] = IMPUTED) -> DataFrame:
    """Flags to numbers, weather gaps to medians, incomplete rows out."""
    return complete_rows(impute_median(numbers(silver), imputed))


def numbers(silver: DataFrame) -> DataFrame:
    """Flags to numbers."""
    return silver.withColumns({c: F.col(c).cast("int") for c in FLAGS})


def features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Add the feature vector."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def regression_metrics(df: DataFrame, y: str | Column, yhat: str | Column, **more: Column) -> DataFrame:
    """One row with mae, rmse and r2, and further aggregates of df by name, in one pass.

    The spread of the target is taken from its central moment, which Spark merges task by task.
    """
    pair = df.select(
        (F.col(y) if isinstance(y, str) else y).cast("double").alias("y"),
        (F.col(yhat) if isinstance(yhat, str) else yhat).cast("double").alias("p"),
        *(df.columns if more else []),
    )
    error = F.col("y") - F.col("p")
    spread = F.var_pop("y") * F.count("y")
    sums = pair.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sum(error * error).alias("sse"),
        spread.alias("sst"),
        *[expr.alias(name) for name, expr in more.items()],
    )
    return sums.select(
        "mae",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.col("sse") / F.when(F.col("sst") > 0, F.col("sst"))).alias("r2"),
        *more,
    )


def mean_baseline(train: DataFrame, test: DataFrame, y: str = TARGET) -> DataFrame:
    """Errors on the test rows when the training mean is predicted for all of them."""
    mean = train.agg(F.avg(y)).scalar()
    return regression_metrics(test.withColumn("_mean", mean), y, "_mean").select("mae", "rmse")


def improvement_pct(mae: Column, base_mae: Column) -> Column:
    """Gain over the baseline in percent; null for a perfect baseline."""
    return (F.lit(1.0) - mae / F.when(base_mae != 0, base_mae)) * F.lit(100.0)


def fit_price_model(
    train: DataFrame,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    columns: Sequence[str] = FEATURES,
    target: str = TARGET,
    key: str | None = None,
    parts: int = 8,
    bins: int = BINS,
    bootstrap: bool = True,
) -> RandomForestRegressionModel:
    """Random forest that considers every feature at every split, ``bins`` - 1 thresholds of it.

    Without ``bootstrap`` each tree is fitted on all rows as they are.
    Thresholds come from all rows. MLlib would take them from the square of ``maxBins`` rows, drawn at random, so it gets numbers
    of bins, which have few values, and a ``maxBins`` whose square is no less than the rows (2.1 billion at most).
    Nodes are divided in groups whose statistics fit NODE_STATISTICS_MB; the groups don't change the trees. Remembering
    which node each row has reached spares walking all trees again for every group. What is remembered, and drawn, is a number
    per row and tree, so the more rows there are, the fewer trees grow at once; each lot draws with a seed of its own.
    """
    total, points = split_points(train, columns, bins)
    rows = train.select(*dict.fromkeys([*([key] if key else []), *columns, target]))
    if key:
        rows = rows.repartition(parts, key).sortWithinPartitions(key)
    rows, names = bin_numbers(rows, points)
    rows, spark = rows.select(*names, target), train.sparkSession
    lots = min(trees, -(-trees * total // FITTED_AT_ONCE) or 1)
    if lots > 1:
        rows = rows.persist()
    lot, paths = -(-trees // lots), []
    for first in range(0, trees, lot):
        forest = RandomForestRegressor(
            featuresCol="features",
            labelCol=target,
            predictionCol="prediction",
            numTrees=min(lot, trees - first),
            maxDepth=depth,
            seed=seed + first * SEED_STEP,
            featureSubsetStrategy="all",
            maxMemoryInMB=NODE_STATISTICS_MB,
            cacheNodeIds=True,
            maxBins=max(bins, min(MOST_BINS, math.isqrt(total) + 1)),
            bootstrap=bootstrap,
        )
        paths.append(scratch_path(spark, "trees"))
        forest.fit(features(rows, names)).write().save(paths[-1])
    rows.unpersist()
    return joined(spark, paths, points)


def bin_numbers(df: DataFrame, points: Mapping[str, Sequence[float]]) -> tuple[DataFrame, list[str]]:
    """Add the number of each column's bin, from 1, a value at a threshold being in the bin below; and the names of these numbers."""
    names = {c: f"_bin_{i}" for i, c in enumerate(points)}
    edges = {c: [-math.inf, *[math.nextafter(t, math.inf) for t in cuts], math.inf] for c, cuts in points.items() if cuts}
    if edges:
        cutter = Bucketizer(splitsArray=list(edges.values()), inputCols=list(edges), outputCols=[names[c] for c in edges])
        df = cutter.transform(df)
    numbers = {name: (F.col(name) + 1 if c in edges else F.lit(1)).cast("int") for c, name in names.items()}
    return df.withColumns(numbers), list(names.values())


def joined(spark: SparkSession, paths: Sequence[str], points: Mapping[str, Sequence[float]]) -> RandomForestRegressionModel:
    """One forest of all trees of forests that were saved after they were fitted on numbers of bins.

    It takes the features themselves: the split after bin k is at threshold k. Trees are put together as MLlib writes them.
    """
    path = scratch_path(spark, "forest")
    documents = [json.loads(spark.read.text(f"{p}/metadata").first()[0]) for p in paths]
    counts = [d["numTrees"] for d in documents]
    document = documents[0] | {"numTrees": sum(counts), "paramMap": documents[0]["paramMap"] | {"numTrees": sum(counts)}}
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(f"{path}/metadata")

    def read(part: str) -> DataFrame:
        lots = [spark.read.parquet(f"{p}/{part}") for p in paths]
        tree = lots[0].columns[0]
        return reduce(DataFrame.union, [lot.withColumn(tree, F.col(tree) + sum(counts[:i])) for i, lot in enumerate(lots)])

    read("treesMetadata").write.parquet(f"{path}/treesMetadata")
    cuts = [(i, k, t) for i, column in enumerate(points.values()) for k, t in enumerate(column, 1)]
    found = spark.createDataFrame(cuts, "feature int, bin bigint, threshold double")
    nodes, place = read("data"), F.col("nodeData.split.leftCategoriesOrThreshold")
    same = (F.col("nodeData.split.featureIndex") == F.col("feature")) & (F.floor(F.get(place, F.lit(0))) == F.col("bin"))
    # A leaf has no split, so it has no threshold either.
    threshold = F.when(F.col("threshold").isNull(), place).otherwise(F.array("threshold"))
    node = F.col("nodeData").withField("split.leftCategoriesOrThreshold", threshold)
    nodes.join(found, same, "left").select("treeID", node.alias("nodeData")).write.parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


class RootSplit(NamedTuple):
    """The first decision of a tree of depth 1: rows with variable <= threshold get ``left``, others ``right``."""

    variable: str
    threshold: float
    left: float
    right: float


def root_split(model: RandomForestRegressionModel, columns: Sequence[str] = FEATURES) -> RootSplit | None:
    """Of the first tree of a forest of depth 1; None if that tree has no split."""
    if model.trees[0].depth != 1:
        return None
    text = model.trees[0].toDebugString
    [(feature, threshold)] = re.findall(r"If \(feature (\d+) <= (\S+)\)", text)
    left, right = re.findall(r"Predict: (\S+)", text)
    return RootSplit(columns[int(feature)], float(threshold), float(left), float(right))


def score(model: RandomForestRegressionModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``."""
    return model.transform(features(df)).drop("features")


def abs_error(actual: Column, predicted: Column) -> Column:
    """Distance of the rounded prediction, rounded to cents."""
    return scale_round(F.abs(actual - predicted), 2)


def prediction_mart(scored: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """All scored test rows (``prediction`` and ``is_anomaly`` present), or a sample of ``limit`` rows."""
    exposed = scored if limit is None else sample_n(scored, limit, key, f"{SEED}:exposed")
    predicted = scale_round("prediction", 2)
    return exposed.select(
        F.col("pickup_date").cast("string").alias("pickup_date"),
        "pu_zone",
        "pu_borough",
        F.col(TARGET).alias("actual_total"),
        predicted.alias("predicted_total"),
        abs_error(F.col(TARGET), predicted).alias("abs_error"),
        F.col("is_anomaly").cast("bigint").alias("is_anomaly"),
    )


def importances(
    model: RandomForestRegressionModel, columns: Sequence[str] = FEATURES
) -> dict[str, float]:
    """Feature to importance, four decimals, largest first."""
    pairs = zip(columns, model.featureImportances.toArray(), strict=True)
    return {name: round(float(v), 4) for name, v in sorted(pairs, key=lambda p: -p[1])}


def importance_rows(metrics: DataFrame) -> DataFrame:
    """The importance map of a metrics document as rows, largest first."""
    rows = metrics.select(F.explode("feature_importance").alias("variable", "importance"))
    return rows.orderBy(F.desc_nulls_last("importance"), "variable")


def ml_metrics(
    baseline: DataFrame,
    model_metrics: DataFrame,
    importance: dict[str, float],
    n_train: int,
    n_test: int,
    anomalies: int,
    run_id: str,
) -> DataFrame:
    """The metrics document, one nested row. ``anomalies`` counts all test rows, exposed or not."""
    base = baseline.first()
    model = model_metrics.withColumn("gain", F.round(improvement_pct(F.col("mae"), F.lit(base["mae"])), 2)).first()

    def r4(v: float | None) -> float | None:
        return None if v is None else round(v, 4)

    row = (
        run_id,
        MODEL_NAME,
        n_train,
        n_test,
        (r4(base["mae"]), r4(base["rmse"])),
        (r4(model["mae"]), r4(model["rmse"]), r4(model["r2"])),
        model["gain"],
        importance,
        anomalies,
    )
    return baseline.sparkSession.createDataFrame([row], schema=T.StructType(ML_METRICS.fields))


def new_run_id() -> str:
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")


@dataclass(frozen=True)
class Fitted:
    """All that later rows need to be predicted as the test rows were."""

    run_id: str
    model: RandomForestRegressionModel
    medians: dict[str, float | None]
    outliers: Outliers


def predict(fitted: Fitted, silver: DataFrame) -> DataFrame:
    """Rows of the predictions mart for complete rows of silver, with medians, model and outlier threshold as fitted."""
    ready = complete_rows(fill(numbers(silver), fitted.medians))
    return prediction_mart(fitted.outliers.flag(score(fitted.model, ready)), "")


def train_and_score(
    silver: DataFrame,
    key: str,
    fit_rows: int | None = None,
    trees: int = TREES,
    depth: int = DEPTH,
    detector: IsolationForest | None = None,
    run_id: str | None = None,
) -> dict:
    """Prepare and split all rows, fit both models, score and measure all test rows.

    ``key`` names a unique column of silver. The price model is fitted on all training rows, unless ``fit_rows`` asks for a
    sample of them. The needed columns and the scored rows are stored in the shared folder: each is read many times, and a
    lost executor must not mean cleaning or scoring again. A sample is brought into few files first, as it comes in a
    few rows from each task of a huge table.
    Returns the predictions mart, the metrics document, the model, and what predicts later rows.
    """
    from martkit.operators.isoforest import IsolationForest

    run_id = run_id or new_run_id()
    needed = {key, TARGET, "pickup_date", "pu_zone", "pu_borough", *FEATURES, *OUTLIER_FEATURES}
    rows = numbers(stored(silver.select(*sorted(needed)), "learning-rows"))
    gaps = medians(rows)
    ready = complete_rows(fill(rows, gaps))
    parts = split(ready, key, TEST_SHARE, f"{SEED}:split")
    if fit_rows is None:
        fitting, dealt = parts.train, max(LEAST_PARTITIONS, -(-parts.n_train // TRAINING_ROWS_PER_PARTITION))
    else:
        dealt = max(1, -(-fit_rows // ROWS_PER_PARTITION))
        fitting = stored(sample_n(parts.train, fit_rows, key, SEED).repartition(dealt, key), "fit-rows")
    model = fit_price_model(fitting, trees, depth, key=key, parts=dealt)
    forest = detector or IsolationForest(columns=OUTLIER_FEATURES, key=key)
    outliers, scored = forest.fitted(score(model, parts.test))  # stored there
    metrics = ml_metrics(
        mean_baseline(parts.train, scored),
        regression_metrics(scored, TARGET, "prediction"),
        importances(model),
        parts.n_train,
        parts.n_test,
        scored.filter("is_anomaly = 1").count(),
        run_id,
    )
    return {
        "run_id": run_id,
        "model": model,
        "fitted": Fitted(run_id, model, gaps, outliers),
        "predictions": prediction_mart(scored, key),
        "metrics": metrics,
    }
