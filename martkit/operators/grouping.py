"""Grouped aggregation with a size floor, and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: smallest group a mart may show.
K_MIN = 5


def k_anonymous(
    df: DataFrame, keys: Sequence[str | Column], aggs: Mapping[str, Column], k: int = K_MIN
) -> DataFrame:
    """Group, count as ``trips``, aggregate, and hide groups of fewer than k rows.

    Rows are combined before the shuffle, so what moves is one row per group and task, however hot a
    key is.
    """
    columns = [expr.alias(name) for name, expr in aggs.items()]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"), *columns)
    return grouped.filter(F.col("trips") >= k)


def suppressed_groups(df: DataFrame, keys: Sequence[str | Column], k: int = K_MIN) -> DataFrame:
    """How many groups, and rows in them, the floor hides. Says nothing about which."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hidden = F.col("n") < k
    return sizes.agg(
        F.count(F.lit(1)).alias("all_groups"),
        F.count_if(hidden).alias("hidden_groups"),
        F.coalesce(F.sum(F.when(hidden, F.col("n"))), F.lit(0)).alias("hidden_rows"),
    )


def ranked(df: DataFrame, by: str, ties: Sequence[str]) -> DataFrame:
    """All rows, largest measure first, missing measures last; ties in key order."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in ties])


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest measure. Every task keeps k rows; no full sort takes place."""
    return ranked(df, by, ties).limit(k)
