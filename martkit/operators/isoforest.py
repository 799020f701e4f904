"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Each tree draws at most ``max_samples`` rows from the whole table and all trees grow together, level by level: a level
finds the range of every feature in every node, picks a feature that varies and a cut within its range, and sends the
rows on. What is drawn and picked follows from hashes of the seed, the tree and the row or node, so the forest is a
function of the rows alone, whatever their order and partitioning, and can be stated in SQL.

The forest is a node table of at most ``trees * (2 * max_samples - 1)`` rows, so its size is known before it is shipped to
the tasks that score. Path lengths are whole units of 1e-8, so their sums are exact.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.functions.portable import known
from martkit.operators.selection import exact_quantile
from martkit.sources.layers import stored

# Send this module's functions to the Python workers themselves, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER_GAMMA = 0.5772156649015329
#: Marks of draws are below this prime, so that products of two of them are bigints.
PRIME = (1 << 31) - 1
UNITS = 100_000_000  # of path length


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _average_path(n: Column) -> Column:
    more = F.lit(2.0) * (F.log(F.greatest(n - 1, F.lit(1)).cast("double")) + EULER_GAMMA) - F.lit(2.0) * (n - 1) / n
    return F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(more)


def _hex_number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of a text's hash as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def _height(size: int) -> int:
    return max(1, math.ceil(math.log2(max(size, 2))))


class Forest(NamedTuple):
    """A fitted forest: one row per tree, one column per node.

    ``children`` holds two entries per node, right child then left child; a leaf has itself twice.
    """

    feature: np.ndarray
    cut: np.ndarray
    children: np.ndarray
    length: np.ndarray
    height: int
    normal: float


def forest_scores(forest: tuple, x: np.ndarray) -> np.ndarray:
    """Score of each row in (0, 1); close to 1 means easy to isolate."""
    features, cuts, families, lengths, height, normal = forest
    n, k = x.shape
    values, start = np.ascontiguousarray(x).ravel(), np.arange(n, dtype=np.int64) * k
    units, total = np.rint(lengths * UNITS).astype(np.int64), np.zeros(n, dtype=np.int64)
    for feature, cut, children, length in zip(features, cuts, families, units, strict=True):
        node = np.zeros(n, dtype=np.int64)
        for _ in range(height):
            goes_left = values.take(start + feature.take(node)) <= cut.take(node)
            node = children.take(2 * node + goes_left)
        total += length.take(node)
    mean = total / UNITS / len(features)
    return np.exp2(-mean / normal) if normal > 0 else np.full(n, 0.5)


@dataclass(frozen=True)
class IsolationForest:
    """Settings. ``key`` is a unique column; missing feature values count as 0."""

    columns: Sequence[str]
    key: str
    contamination: float = 0.02
    trees: int = 100
    max_samples: int = 256
    seed: int = 42

    def _draws(self, df: DataFrame) -> tuple[DataFrame, int]:
        """Rows of each tree: ``tree``, ``rank`` within it, and the features; and the sample size."""
        n = df.count()
        size = min(self.max_samples, n)
        # Twice the rows a tree needs pass the draw on average, so it falls short only if the table is
        # smaller than that, and then every row passes.
        limit = math.ceil(min(1.0, 2.0 * size / max(n, 1)) * PRIME)

        def constant(kind: str, tree: int) -> int:
            return int(hashlib.md5(f"{self.seed}:{kind}:{tree}".encode()).hexdigest()[:8], 16)

        factors = F.array(*[F.lit(constant("factor", t) % (PRIME - 1) + 1).cast("bigint") for t in range(self.trees)])
        shifts = F.array(*[F.lit(constant("shift", t) % PRIME).cast("bigint") for t in range(self.trees)])
        place = _hex_number(F.concat_ws(":", F.lit(str(self.seed)), "_key"), 8) % PRIME

        def mark(tree: Column) -> Column:
            return (F.col("_place") * F.get(factors, tree) + F.get(shifts, tree)) % PRIME

        # The trees that draw a row are found before rows multiply: nearly all rows of a large table have none.
        trees = F.filter(F.sequence(F.lit(0), F.lit(self.trees - 1)), lambda t: mark(t) < limit)
        drawn = (
            df.select(F.col(self.key).cast("string").alias("_key"), *self._values())
            .withColumn("_place", place)
            .withColumn("tree", F.explode(trees))
            .withColumn("mark", mark(F.col("tree")))
        )
        order = Window.partitionBy("tree").orderBy("mark", "_key")
        ranked = drawn.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
        return ranked.select("tree", "rank", *self.columns), size

    def _values(self):
        return _known_values(self.columns)

    def _level(self, rows: DataFrame) -> DataFrame:
        """Send the rows of every node that can be divided to its children; ``path`` notes the feature and the cut."""
        group, columns = Window.partitionBy("tree", "node"), list(self.columns)
        rows = rows.withColumns(
            {
                "_n": F.count(F.lit(1)).over(group),
                "_low": F.array(*[F.min(c).over(group) for c in columns]),
                "_high": F.array(*[F.max(c).over(group) for c in columns]),
            }
        )
        node = [F.lit(str(self.seed)), F.col("tree"), F.col("node")]
        votes = [
            F.when(F.get("_low", F.lit(i)) < F.get("_high", F.lit(i)), F.concat(F.md5(F.concat_ws(":", *node, F.lit(str(i)))), F.lit(f":{i}")))
            for i in range(len(columns))
        ]
        rows = rows.withColumn("_feature", F.when(F.col("_n") > 1, F.substring_index(F.array_min(F.array(*votes)), ":", -1).cast("int")))
        share = _hex_number(F.concat_ws(":", *node, F.lit("cut")), 13).cast("double") / float(1 << 52)
        low, high = F.get("_low", F.col("_feature")), F.get("_high", F.col("_feature"))
        rows = rows.withColumn("_cut", low + share * (high - low))
        rows = rows.withColumn("_cut", F.when(F.col("_cut") < high, F.col("_cut")).otherwise(low))  # the cut may round up
        left = F.get(F.array(*columns), F.col("_feature")) <= F.col("_cut")
        step = F.struct(F.col("node"), F.col("_feature").alias("feature"), F.col("_cut").alias("cut"))
        divided = F.col("_feature").isNotNull()
        return rows.select(
            "tree", *columns,
            F.when(divided, 2 * F.col("node") + F.when(left, 1).otherwise(2)).otherwise(F.col("node")).cast("int").alias("node"),
            F.when(divided, F.array_append("path", step)).otherwise(F.col("path")).alias("path"),
        )

    def nodes(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The node table (tree, node, feature, cut, left, right, length) and the number of rows per tree.

        A tree's root is node 0, the children of node i are 2 i + 1 and 2 i + 2; a leaf has feature -1 and itself twice.
        """
        drawn, size = self._draws(df)
        path = F.array().cast("array<struct<node:int,feature:int,cut:double>>")
        rows = drawn.select("tree", *self.columns, F.lit(0).alias("node"), path.alias("path")).repartition("tree")
        for _ in range(_height(size)):
            rows = self._level(rows)
        rows = stored(rows.select("tree", "node", "path"), "grown")  # a row per drawn row
        depth = F.length(F.bin(F.col("node") + 1)) - 1
        leaves = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n")).select(
            "tree", "node", F.lit(-1).alias("feature"), F.lit(0.0).alias("cut"), F.col("node").alias("left"), F.col("node").alias("right"),
            (F.rint((depth + _average_path(F.col("n"))) * float(UNITS)) / float(UNITS)).alias("length"),
        )
        inner = rows.select("tree", F.inline("path")).distinct().select(
            "tree", "node", "feature", "cut", (2 * F.col("node") + 1).alias("left"), (2 * F.col("node") + 2).alias("right"), F.lit(0.0).alias("length")
        )
        return leaves.unionByName(inner), size

    def fit(self, df: DataFrame) -> Forest:
        """Grow the trees and load the node table (at most 511 rows per tree by default)."""
        table, size = self.nodes(df)
        rows = table.toPandas()
        width = int(rows["node"].max()) + 1 if len(rows) else 1
        count = max(1, rows["tree"].nunique())
        tree = rows["tree"].rank(method="dense").astype(int).to_numpy() - 1
        node = rows["node"].to_numpy()
        feature, cut, length = np.zeros((count, width), int), np.zeros((count, width)), np.zeros((count, width))
        children = np.zeros((count, width, 2), int)
        feature[tree, node] = np.maximum(rows["feature"], 0)
        cut[tree, node] = rows["cut"]
        length[tree, node] = rows["length"]
        children[tree, node, 0] = rows["right"]
        children[tree, node, 1] = rows["left"]
        return Forest(feature, cut, children.reshape(count, 2 * width), length, _height(size), average_path(size))

    def score(self, df: DataFrame, forest: Forest) -> DataFrame:
        """Add ``anomaly_score``."""
        return _scored(df, forest, self.columns)

    def fitted(self, df: DataFrame) -> tuple[Outliers, DataFrame]:
        """Fit on df; returns what flags further rows, and df scored and flagged.

        ``is_anomaly`` is 1 strictly above the contamination quantile of df. Every row is scored once: the scored
        rows are stored, and both the threshold and the result are read from there.
        """
        forest = self.fit(df)
        scored = stored(self.score(df, forest), "scored")
        threshold = exact_quantile(scored, "anomaly_score", 1.0 - self.contamination)
        return Outliers(tuple(self.columns), forest, threshold), _flagged(scored, threshold)

    def fit_flag(self, df: DataFrame) -> DataFrame:
        """Fit on df, score it and set ``is_anomaly``."""
        return self.fitted(df)[1]


@dataclass(frozen=True)
class Outliers:
    """A fitted forest and the score above which a row counts as an outlier; None: no row does."""

    columns: tuple[str, ...]
    forest: Forest
    threshold: float | None

    def flag(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` and ``is_anomaly`` to rows that the forest need not know."""
        return _flagged(_scored(df, self.forest, self.columns), self.threshold)


def _known_values(columns: Sequence[str]) -> list:
    return [F.coalesce(known(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in columns]


def _scored(df: DataFrame, forest: Forest, columns: Sequence[str]) -> DataFrame:
    """Add ``anomaly_score``; the forest goes to each executor once."""
    shipped = df.sparkSession.sparkContext.broadcast(tuple(forest))

    def score_batch(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(forest_scores(shipped.value, np.column_stack(batch)))

    scorer = F.pandas_udf(score_batch, "double")
    return df.withColumn("anomaly_score", scorer(*_known_values(columns)))


def _flagged(scored: DataFrame, threshold: float | None) -> DataFrame:
    flag = F.col("anomaly_score") > F.lit(threshold).cast("double")
    return scored.withColumn("is_anomaly", F.coalesce(flag, F.lit(False)).cast("int"))
