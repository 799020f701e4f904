"""Published price models: versions that never change, and a manifest entry that says which one counts.

A version is a folder with the forest as Spark writes it, the outlier forest as a table of a row per tree, and one row of
facts (run id, medians, threshold). It is published by a commit, together with whatever else changes with it, and found
again by that entry or by its run id.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from martkit.operators.isoforest import Forest, Outliers
from martkit.operators.learning import Fitted
from martkit.sources.versions import WHOLE, Manifest, Versions

TREE = "tree int, feature array<int>, cut array<double>, children array<int>, length array<double>"
FACTS = "run_id string, medians map<string,double>, columns array<string>, threshold double, height int, normal double"


def stage_model(versions: Versions, table: str, fitted: Fitted) -> dict[str, str]:
    """Write a model to a new version; returns what to commit: the entry for readers, and one under its run id."""
    version, spark = f"{fitted.run_id}-{uuid.uuid4().hex}", versions.spark
    place, forest = f"{versions.root}/{table}/version={version}", fitted.outliers.forest
    fitted.model.write().save(f"{place}/forest")
    parts = (forest.feature, forest.cut, forest.children, forest.length)
    trees = [(i, *[part[i].tolist() for part in parts]) for i in range(len(forest.feature))]
    spark.createDataFrame(trees, TREE).coalesce(1).write.parquet(f"{place}/outliers")
    facts = (
        fitted.run_id, fitted.medians, list(fitted.outliers.columns), fitted.outliers.threshold,
        int(forest.height), float(forest.normal),
    )
    spark.createDataFrame([facts], FACTS).coalesce(1).write.parquet(f"{place}/facts")
    return {WHOLE: version, fitted.run_id: version}


def published_runs(manifest: Manifest, table: str) -> Sequence[str]:
    """Run ids whose models can be loaded, oldest first."""
    return [run for run, version in sorted(manifest.tables.get(table, {}).items()) if run != WHOLE and version]


def load_model(versions: Versions, table: str, run_id: str = WHOLE, manifest: Manifest | None = None) -> Fitted:
    """The published model, or that of a run."""
    version = (manifest or versions.latest()).tables.get(table, {}).get(run_id)
    if version is None:
        raise LookupError(f"{table}: no model {'published' if run_id == WHOLE else run_id}")
    spark, place = versions.spark, f"{versions.root}/{table}/version={version}"
    facts = spark.read.schema(FACTS).parquet(f"{place}/facts").first()
    trees = spark.read.schema(TREE).parquet(f"{place}/outliers").orderBy(F.col("tree")).collect()  # a row per tree
    parts = [np.array([t[name] for t in trees]) for name in ("feature", "cut", "children", "length")]
    outliers = Outliers(tuple(facts["columns"]), Forest(*parts, facts["height"], facts["normal"]), facts["threshold"])
    return Fitted(facts["run_id"], RandomForestRegressionModel.load(f"{place}/forest"), facts["medians"], outliers)
