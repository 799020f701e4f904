"""Every registered query against its oracle SQL; those without one by their shape."""

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as contract
from martkit.testbed import oracle, registry

QUERIES, ORACLE = registry.all_queries(), oracle.all_oracles()
LEARNED = {
    "price_model",
    "ml_metrics",
    "feature_importance",
    "prediction_mart",
    "top_errors",
    "top_anomalies",
    "actual_vs_predicted",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_only_learned_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLE) == LEARNED
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("query", sorted(ORACLE))
def test_equal_to_oracle(spark, sf_dir, con, query):
    assert difference(QUERIES[query](spark, sf_dir), con, ORACLE[query]) is None


def test_all_are_offered():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_learned_queries_agree(spark, sf_dir):
    """What the reads over one trained model say of each other (sizes and rows have oracles of their own)."""
    got = {q: QUERIES[q](spark, sf_dir).collect() for q in sorted(LEARNED)}
    [facts], [document] = got["price_model"], got["ml_metrics"]
    assert (facts.n_train, facts.n_test) == (document.n_train, document.n_test)
    assert abs(facts.mae - document.baseline.mae) < 1e-9 and facts.model_mae == document.model_metrics.mae
    shares = {r.variable: r.importance for r in got["feature_importance"]}
    assert shares == document.feature_importance and abs(sum(shares.values()) - 1) < 0.01
    mart = got["prediction_mart"]
    assert len(mart) == facts.n_test == len(got["actual_vs_predicted"])
    mae = sum(abs(r.actual_total - r.predicted_total) for r in mart) / len(mart)
    assert abs(mae - facts.model_mae) < 0.01
    errors = sorted((r.abs_error for r in mart), reverse=True)
    assert [r.abs_error for r in got["top_errors"]] == errors[:100]
    flagged = sorted((r.abs_error for r in mart if r.is_anomaly), reverse=True)
    assert len(flagged) == document.anomalies_detected
    assert [r.abs_error for r in got["top_anomalies"]] == flagged[:20]


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows
    assert [r["revenue_total"] for r in rows] == sorted((r["revenue_total"] for r in rows), reverse=True)


def test_marts_agree_with_plain_sums(spark, sf_dir, con):
    """The marts as plain double sums and averages would give them, but for the last cent."""
    from martkit.testbed import adapters, oracle

    plain = oracle.silver(
        """SELECT pu_borough, pu_zone, pickup_hour, pickup_dow_iso, COUNT(*) AS trips,
        SUM(total_amount), AVG(total_amount), AVG(trip_distance), AVG(trip_duration_min)
        FROM sv WHERE pu_borough IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 5"""
    )
    wanted = {row[:4]: row[4:] for row in con.execute(plain).fetchall()}
    found = {tuple(r)[:4]: tuple(r)[4:] for r in adapters.demand(spark, sf_dir).collect()}
    assert found.keys() == wanted.keys()
    for key, (trips, revenue, ticket, distance, minutes) in found.items():
        assert trips == wanted[key][0]
        for value, plain_value, half in zip(
            (revenue, ticket, distance, minutes), wanted[key][1:], (0.005, 0.005, 0.005, 0.05), strict=True
        ):
            assert abs(value - plain_value) <= half * 1.000001
