"""Reads over the marts: rankings, filtered listings, key figures and chart data sets.

The marts are small (their keys are zones, hours, weekdays and codes), and every grouping here combines
rows before it shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.labels import PAYMENT_DEFAULT, PAYMENT_LABELS, WEEKDAY_LABELS, label_codes
from martkit.functions.portable import exact_sum, stable_avg, stable_sum
from martkit.operators.grouping import ranked, top_k
from martkit.plans.marts import DEMAND_KEYS, TIPS_KEYS

# Accepted range of each argument.
BOUNDS = {
    "top_zones.limit": (1, 100),
    "demand.limit": (1, 500),
    "demand.hour": (0, 23),
    "predictions.limit": (1, 1000),
}
PREDICTION_COLUMNS = (
    "pickup_date",
    "pu_borough",
    "pu_zone",
    "actual_total",
    "predicted_total",
    "abs_error",
    "is_anomaly",
)


def check_bounds(name: str, value: int) -> int:
    """Return the argument as int if it lies in its range, else raise before a plan is built."""
    low, high = BOUNDS[name]
    if isinstance(value, bool) or int(value) != value or not low <= value <= high:
        raise ValueError(f"{name} must be a whole number from {low} to {high}, not {value!r}")
    return int(value)


def top_zones(demand: DataFrame, limit: int = 10, decimals: int = 2) -> DataFrame:
    """Pickup zones by total revenue; a zone without a name is one of them."""
    limit = check_bounds("top_zones.limit", limit)
    zones = demand.groupBy("pu_borough", "pu_zone").agg(
        F.sum("trips").alias("trips"),
        stable_sum("revenue_total", decimals).alias("revenue_total"),
    )
    return top_k(zones, "revenue_total", limit, ["pu_borough", "pu_zone"])


def busiest_hours(demand: DataFrame, limit: int = 5) -> DataFrame:
    """Hours of the day by trips."""
    hours = demand.groupBy("pickup_hour").agg(F.sum("trips").alias("trips"))
    return top_k(hours, "trips", limit, ["pickup_hour"])


def tips_by_payment(tips: DataFrame) -> DataFrame:
    """Per payment type the plain mean of its segments' tip percentages, and its trips."""
    by_type = tips.groupBy("payment_type").agg(
        stable_avg("avg_tip_pct", 1).alias("avg_tip_pct"), F.sum("trips").alias("trips")
    )
    return ranked(by_type, "trips", ["payment_type"])


def demand_filtered(
    demand: DataFrame, borough: str | None = None, hour: int | None = None, limit: int = 50
) -> DataFrame:
    """Segments by trips, optionally of one borough or hour. An empty borough is no filter, hour 0 is."""
    limit = check_bounds("demand.limit", limit)
    rows = demand
    if borough:
        rows = rows.filter(F.col("pu_borough") == F.lit(borough))
    if hour is not None:
        rows = rows.filter(F.col("pickup_hour") == F.lit(check_bounds("demand.hour", hour)))
    return top_k(rows, "trips", limit, DEMAND_KEYS)


def tips_ranked(tips: DataFrame) -> DataFrame:
    """All tip segments by tip percentage."""
    return ranked(tips, "avg_tip_pct", TIPS_KEYS)


def kpis(demand: DataFrame) -> DataFrame:
    """One row of key figures; the ticket is the plain mean of the segments' tickets."""
    return demand.agg(
        F.sum("trips").alias("trips"),
        exact_sum("revenue_total").alias("revenue_total"),
        stable_avg("avg_ticket").alias("avg_ticket"),
        F.count_distinct("pu_zone").alias("zones"),
    )


def dashboard_top_zones(demand: DataFrame, limit: int = 15) -> DataFrame:
    """Chart data: named zones by revenue, not rounded."""
    named = demand.dropna(subset=["pu_borough", "pu_zone"])
    zones = named.groupBy("pu_borough", "pu_zone").agg(
        exact_sum("revenue_total").alias("revenue_total")
    )
    return top_k(zones, "revenue_total", limit, ["pu_borough", "pu_zone"])


def demand_heat(demand: DataFrame) -> DataFrame:
    """Trips per weekday and hour, with the weekday's short name."""
    cells = demand.dropna(subset=["pickup_dow_iso", "pickup_hour"])
    return (
        cells.groupBy("pickup_dow_iso", "pickup_hour")
        .agg(F.sum("trips").alias("trips"))
        .withColumn("jour", label_codes("pickup_dow_iso", WEEKDAY_LABELS))
    )


def heat_matrix(demand: DataFrame) -> DataFrame:
    """Weekday by hour: always seven rows, Monday first, and the columns h00 to h23."""
    hours = list(range(24))
    cells = (
        demand.groupBy(F.col("pickup_dow_iso").alias("_dow"))
        .pivot("pickup_hour", hours)
        .agg(F.sum("trips"))
        .withColumnsRenamed({str(h): f"h{h:02d}" for h in hours})
    )
    days = demand.sparkSession.range(1, 8).select(F.col("id").cast("int").alias("pickup_dow_iso"))
    return (
        days.join(cells, F.col("pickup_dow_iso") == F.col("_dow"), "left")
        .orderBy("pickup_dow_iso")
        .select(
            "pickup_dow_iso",
            label_codes("pickup_dow_iso", WEEKDAY_LABELS).alias("jour"),
            *[f"h{h:02d}" for h in hours],
        )
    )


def labelled_tips(tips: DataFrame) -> DataFrame:
    """Tip segments with the name of the payment type."""
    return tips.withColumn("paiement", label_codes("payment_type", PAYMENT_LABELS, PAYMENT_DEFAULT))


def top_errors(predictions: DataFrame, limit: int = 100, anomalies_only: bool = False) -> DataFrame:
    """Predictions by error, optionally only those flagged."""
    limit = check_bounds("predictions.limit", limit)
    rows = predictions.filter(F.col("is_anomaly") == 1) if anomalies_only else predictions
    ties = [c for c in PREDICTION_COLUMNS if c != "abs_error"]
    return top_k(rows.select(*PREDICTION_COLUMNS), "abs_error", limit, ties)


def actual_vs_predicted(predictions: DataFrame) -> DataFrame:
    """Scatter data, each point with the end of the diagonal (the largest actual value)."""
    end = predictions.agg(F.max("actual_total")).scalar()
    points = predictions.select("actual_total", "predicted_total", "is_anomaly")
    return points.withColumn("diagonal_end", end)
