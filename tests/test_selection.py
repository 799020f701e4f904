"""Samples, splits and quantiles: exact sizes, independent of partitioning, equal to a plain sort."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martkit.operators import selection
from martkit.operators.selection import exact_quantile, exact_quantiles, sample_n, split, split_points

QUICK = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def by_hash(keys, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), str(k)))


def keys_of(df):
    return {r["id"] for r in df.collect()}


@QUICK
@given(st.integers(0, 400), st.integers(0, 450), st.integers(1, 7), st.sampled_from([2, 5, 5000]))
def test_sample_is_the_head_of_hash_order(spark, rows, n, parts, small):
    df = spark.range(rows).repartition(parts)
    old, selection.SMALL = selection.SMALL, small
    try:
        assert keys_of(sample_n(df, n, "id", 7)) == set(by_hash(range(rows), 7)[:n])
    finally:
        selection.SMALL = old


@QUICK
@given(st.integers(1, 300), st.integers(1, 5), st.floats(0.0, 1.0))
def test_split_sizes(spark, rows, parts, share):
    result = split(spark.range(rows).repartition(parts), "id", share, "s")
    want = math.ceil(share * rows)
    train, test = keys_of(result.train), keys_of(result.test)
    assert (len(test), result.n_test, len(train), result.n_train) == (want, want, rows - want, rows - want)
    assert train | test == set(range(rows)) and not train & test


def test_repeated_key_is_refused(spark):
    same = spark.range(100).selectExpr("'x' AS id")
    with pytest.raises(ValueError, match="not unique"):
        sample_n(same, 10, "id")
    old, selection.SMALL = selection.SMALL, 10
    try:
        with pytest.raises(ValueError, match="not unique"):
            sample_n(same, 10, "id")
    finally:
        selection.SMALL = old


def test_deeper_levels(spark):
    """A bucket that is still too full is divided again."""
    old, selection.SMALL = selection.SMALL, 1
    try:
        assert keys_of(sample_n(spark.range(20_000), 777, "id", 1)) == set(by_hash(range(20_000), 1)[:777])
    finally:
        selection.SMALL = old


@QUICK
@given(
    st.lists(
        st.one_of(st.floats(-1e6, 1e6, allow_nan=False), st.sampled_from([0.0, 1.5, 1e-300])),
        min_size=1,
        max_size=300,
    ),
    st.floats(0, 1),
    st.sampled_from([1, 20, 5000]),
)
def test_quantile_equals_numpy(spark, values, q, small):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    old, selection.SMALL = selection.SMALL, small
    try:
        found = exact_quantile(df, "x", q)
    finally:
        selection.SMALL = old
    assert math.isclose(found, float(np.quantile(values, q)), rel_tol=1e-9, abs_tol=1e-9)


def test_quantiles_of_several_columns_share_passes(spark):
    df = spark.range(10_001).selectExpr("id * 1.0 AS a", "id % 3 AS b", "CAST(NULL AS DOUBLE) AS c")
    assert exact_quantiles(df, {"a": 0.5, "b": 0.5, "c": 0.5}) == {"a": 5000.0, "b": 1.0, "c": None}


def test_hot_value(spark):
    """Two thirds of the rows hold one value."""
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, id / 7.0, 1234.5) AS x")
    assert exact_quantile(df, "x", 0.5) == 1234.5


@pytest.mark.parametrize("ends", [(float("-inf"),), (float("inf"), float("-inf")), (-1.7e308, 1.7e308)])
def test_quantile_of_endless_ranges(spark, ends):
    """Infinite or very far values cost a few passes, not one per value."""
    values = [i / 7 for i in range(400)] + list(ends)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    old, selection.SMALL = selection.SMALL, 5
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    try:
        found = exact_quantile(df, "x", 0.5)
    finally:
        selection.SMALL = old
    assert found == float(np.quantile(values, 0.5))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before < 60


def test_null_key_is_refused(spark):
    keys = spark.range(100).selectExpr("IF(id = 5, NULL, id) AS id")
    with pytest.raises(ValueError, match="nulls"):
        sample_n(keys, 10, "id")
    with pytest.raises(ValueError, match="nulls"):
        split(keys, "id")


def test_sample_scans_twice(spark, tmp_path):
    """One count and one pass that keeps about twice the rows wanted; later passes read only these."""
    spark.range(50_000).write.parquet(f"{tmp_path}/ids")
    df = spark.read.parquet(f"{tmp_path}/ids")
    plan = sample_n(df, 500, "id", 3)._jdf.queryExecution().optimizedPlan().toString()
    assert keys_of(sample_n(df, 500, "id", 3)) == set(by_hash(range(50_000), 3)[:500])
    assert f"{tmp_path}/ids" not in plan


def counted(df):
    """The same rows, and a counter of how often each row was read."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


@pytest.mark.parametrize("small", [100, 5000])
def test_two_scans(spark, monkeypatch, small):
    """A split, a sample and several quantiles read the table twice each, also where windows are stored."""
    monkeypatch.setattr(selection, "SMALL", small)
    rows = 60_000
    df, read = counted(spark.range(rows).selectExpr("id", "pmod(id * 7919, 60000) / 3 AS x", "pmod(id * 31, 60000) * 1.0 AS y"))
    found = exact_quantiles(df, {"x": 0.5, "y": 0.9})
    assert found == pytest.approx({"x": 29_999.5 / 3, "y": 53_999.1})
    assert read.value == 2 * rows
    cut = selection.hash_cut(df, "id", "s", lambda n: n // 5)
    assert read.value == 4 * rows
    first = by_hash(range(rows), "s")[: rows // 5]
    assert cut.key == str(first[-1])
    sampled = sample_n(df, 500, "id", 3)
    assert read.value == 6 * rows
    assert keys_of(sampled) == set(by_hash(range(rows), 3)[:500]) and read.value == 6 * rows


def test_bracket_that_misses(spark, monkeypatch):
    """Brackets too narrow for the rank are noticed by the counts, and the result is the same."""
    monkeypatch.setattr(selection, "SMALL", 50)
    monkeypatch.setattr(selection, "ACCURACY", 20)
    values = [((i * 7919) % 20_000) ** 2 / 3 for i in range(20_000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, x double").repartition(7)
    for q in (0.0, 0.013, 0.5, 0.98, 1.0):
        assert math.isclose(exact_quantile(df, "x", q), float(np.quantile(values, q)), rel_tol=1e-9)
    monkeypatch.setattr(selection, "DEVIATIONS", 0)
    assert keys_of(split(df, "id", 0.3, "s").test) == set(by_hash(range(20_000), "s")[:6_000])


def cut_plainly(values, bins):
    """Thresholds by the rule as MLlib states it, one value after the other."""
    counts = sorted(Counter(values).items())
    if len(counts) <= bins:
        return [(a + b) / 2 for (a, _), (b, _) in zip(counts, counts[1:], strict=False)]
    stride, found, upto = len(values) / bins, [], counts[0][1]
    target = stride
    for (a, _), (b, n) in zip(counts, counts[1:], strict=False):
        if abs(upto - target) < abs(upto + n - target):
            found.append((a + b) / 2)
            target += stride
        upto += n
    return found


@pytest.mark.parametrize("bins", [4, 32])
def test_split_points(spark, bins):
    """Few values, one value, a value that most rows hold, at either end, and values in many parts."""
    rows = [(i % 7, 3, 0 if i % 5 else i, 9_999 if i % 3 else -i, math.sin(i), i * i % 97 - 40) for i in range(4_000)]
    names = ["few", "one", "low", "high", "many", "some"]
    df = spark.createDataFrame(rows, "few int, one int, low int, high int, many double, some int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that parts stay small
    try:
        total, found = split_points(df, names, bins)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert total == 4_000 and list(found) == names
    assert found == {c: cut_plainly([float(r[i]) for r in rows], bins) for i, c in enumerate(names)}
    assert split_points(df.limit(0), names, bins) == (0, {c: [] for c in names})
    assert split_points(df.limit(1), names, bins) == (1, {c: [] for c in names})
