"""Cost of metered usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.portable import exact_sum, scale_round

# Meter, quantity one price covers, price in USD (a scanned TB is 1024 GB).
PRICES = (
    ("s3_gb_month", 1.0, 0.023),
    ("athena_tb_scanned", 1024.0, 5.0),
    ("s3_put_per_1k", 1000.0, 0.005),
)
TOTAL = "TOTAL"
MONTHS = 12


def price_table(spark: SparkSession, prices=PRICES) -> DataFrame:
    return spark.createDataFrame(list(prices), "meter string, unit_size double, unit_price double")


def cost_report(usage: DataFrame, prices: DataFrame, decimals: int | None = 4) -> DataFrame:
    """Cost per scenario and item with a total row per scenario.

    ``usage`` is a log of any size with scenario, item, meter and quantity. Quantities are added up per
    group first, so prices meet a handful of rows. A meter without a price raises no silent zero: its
    cost, and the total, are null.
    """
    used = usage.groupBy("scenario", "item", "meter").agg(exact_sum("quantity").alias("quantity"))
    priced = used.join(prices, "meter", "left").withColumn(
        "cost", F.col("quantity") / F.col("unit_size") * F.col("unit_price")
    )
    total = F.when(F.count("cost") == F.count(F.lit(1)), exact_sum("cost"))
    cost = total if decimals is None else scale_round(total, decimals)
    grouped = priced.groupingSets(
        [["scenario", "item"], ["scenario"]], "scenario", "item"
    ).agg(cost.alias("cost"), F.grouping("item").alias("_total"))
    label = F.when(F.col("_total") == 1, F.lit(TOTAL)).otherwise(F.col("item"))
    return grouped.select("scenario", label.alias("item"), "cost")


def annualize(cost: str | Column, decimals: int | None = 2) -> Column:
    """Monthly cost to a year of such months."""
    yearly = (F.col(cost) if isinstance(cost, str) else cost) * F.lit(float(MONTHS))
    return yearly if decimals is None else scale_round(yearly, decimals)
