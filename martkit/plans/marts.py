"""The two marts: each one grouped pass over the clean layer, or merged from the parts that its months keep.

A part holds, for one month and group, the number of rows and for every measured column both halves of its exact sum and
the number of its values. Parts are added up when the mart is read, the floor on small groups comes after that, so a mart
of merged parts equals the mart of all rows whatever the months, and a month that is built again costs one month.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.portable import exact_halves, from_halves, scale_round
from martkit.operators.grouping import K_MIN, k_anonymous
from martkit.plans.silver import is_rainy

DEMAND_KEYS = ("pu_borough", "pu_zone", "pickup_hour", "pickup_dow_iso")
TIPS_KEYS = ("pu_borough", "payment_type", "is_rush_hour", "is_rainy")


def demand_source(silver: DataFrame) -> DataFrame:
    """The rows the demand mart counts: a pickup borough must be known, the zone need not."""
    return silver.filter(F.col("pu_borough").isNotNull())


def tips_source(silver: DataFrame) -> DataFrame:
    """The rows the tips mart counts: borough and tip percentage known; rain flag added."""
    known = F.col("pu_borough").isNotNull() & F.col("tip_pct").isNotNull()
    return silver.filter(known).withColumn("is_rainy", is_rainy("precip_mm"))


@dataclass(frozen=True)
class Measure:
    """The sum or the mean of a column, rounded."""

    name: str
    column: str
    decimals: int
    mean: bool = True

    def of(self, high: Column, low: Column, n: Column) -> Column:
        total = from_halves(high, low)
        return scale_round(total / F.when(n > 0, n.cast("double")) if self.mean else total, self.decimals)


@dataclass(frozen=True)
class Mart:
    """What a mart counts, by what, and its measures."""

    source: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    measures: Sequence[Measure]

    @property
    def columns(self) -> list[str]:
        return sorted({m.column for m in self.measures})

    def build(self, silver: DataFrame, k: int = K_MIN) -> DataFrame:
        """The mart of all given rows."""
        measures = {m.name: m.of(*exact_halves(m.column), F.count(m.column)) for m in self.measures}
        return k_anonymous(self.source(silver), self.keys, measures, k)

    def parts(self, silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """One row per group (and month, if ``by`` names its columns), small groups included."""
        sums: list[Column] = [F.count(F.lit(1)).alias("trips")]
        for c in self.columns:
            high, low = exact_halves(c)
            sums += [high.alias(f"{c}__high"), low.alias(f"{c}__low"), F.count(c).alias(f"{c}__n")]
        return self.source(silver).groupBy(*by, *self.keys).agg(*sums)

    def parts_schema(self, silver: T.StructType) -> T.StructType:
        """The columns of parts of rows with this schema."""
        known = {f.name: f.dataType for f in silver.fields} | {"is_rainy": T.BooleanType()}
        sums = ["trips", *(f"{c}__{half}" for c in self.columns for half in ("high", "low", "n"))]
        return T.StructType([T.StructField(c, known[c]) for c in self.keys] + [T.StructField(c, T.LongType()) for c in sums])

    def merge(self, parts: DataFrame, k: int = K_MIN) -> DataFrame:
        """The mart of all rows that the parts were made from."""
        sums = [F.sum(c).alias(c) for c in parts.columns if c == "trips" or "__" in c]
        whole = parts.groupBy(*self.keys).agg(*sums).filter(F.col("trips") >= k)
        found = [m.of(*(F.col(f"{m.column}__{half}") for half in ("high", "low", "n"))).alias(m.name) for m in self.measures]
        return whole.select(*self.keys, "trips", *found)


DEMAND = Mart(
    demand_source,
    DEMAND_KEYS,
    (
        Measure("revenue_total", "total_amount", 2, mean=False),
        Measure("avg_ticket", "total_amount", 2),
        Measure("avg_distance_mi", "trip_distance", 2),
        Measure("avg_duration_min", "trip_duration_min", 1),
    ),
)
TIPS = Mart(
    tips_source,
    TIPS_KEYS,
    (
        Measure("avg_tip_pct", "tip_pct", 2),
        Measure("avg_tip_amount", "tip_amount", 2),
        Measure("avg_ticket", "total_amount", 2),
    ),
)


def demand_by_zone_hour(silver: DataFrame, k: int = K_MIN) -> DataFrame:
    """Demand and revenue per pickup zone, hour and weekday."""
    return DEMAND.build(silver, k)


def tips_analysis(silver: DataFrame, k: int = K_MIN) -> DataFrame:
    """Tips per pickup borough, payment type, rush hour and rain."""
    return TIPS.build(silver, k)
