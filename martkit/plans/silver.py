"""The clean layer: one row per plausible trip, enriched and without clear identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.portable import Name, as_col, iso_dow, minutes_between, round_to_int, scale_round
from martkit.operators.cleaning import clean_trips
from martkit.operators.dimensions import enrich


def is_weekend(dow: Column) -> Column:
    return dow >= 6


def is_rush_hour(hour: Column) -> Column:
    return hour.between(7, 9) | hour.between(16, 19)


def is_rainy(precipitation: Name) -> Column:
    """True for any rain; a day without a reading counts as dry."""
    return F.coalesce(as_col(precipitation) > 0, F.lit(False))


def tip_pct(tip: Name, fare: Name) -> Column:
    """Tip in percent of the fare, null unless the fare is above 0."""
    fare = as_col(fare)
    # The divisor is null where the guard fails, so ANSI mode has nothing to raise on.
    return scale_round(F.lit(100.0) * as_col(tip) / F.when(fare > 0, fare), 2)


def time_columns(pickup: Column) -> dict[str, Column]:
    """Calendar columns of a pickup time."""
    hour, dow = F.hour(pickup), iso_dow(pickup)
    return {
        "pickup_date": F.to_date(pickup),
        "pickup_hour": hour,
        "pickup_dow_iso": dow,
        "is_weekend": is_weekend(dow),
        "is_rush_hour": is_rush_hour(hour),
    }


def silver_projection(
    enriched: DataFrame, keep: Sequence[str] = (), minutes: str = "boundary"
) -> DataFrame:
    """The 26 columns of the clean layer; ``keep`` carries further columns along behind them."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    columns = {
        "vendor_id": F.col("vendorid"),
        "pickup_ts": pickup,
        "dropoff_ts": dropoff,
        **time_columns(pickup),
        "passenger_count": round_to_int("passenger_count"),
        "trip_distance": F.col("trip_distance"),
        "trip_duration_min": minutes_between(pickup, dropoff, minutes),
        "pu_location_id": F.col("pulocationid"),
        "do_location_id": F.col("dolocationid"),
        "pu_borough": F.col("pu_borough"),
        "pu_zone": F.col("pu_zone"),
        "do_borough": F.col("do_borough"),
        "do_zone": F.col("do_zone"),
        "payment_type": F.col("payment_type").cast("int"),
        "fare_amount": F.col("fare_amount"),
        "tip_amount": F.col("tip_amount"),
        "total_amount": F.col("total_amount"),
        "tip_pct": tip_pct("tip_amount", "fare_amount"),
        "temp_mean_c": F.col("temperature_2m_mean"),
        "temp_max_c": F.col("temperature_2m_max"),
        "precip_mm": F.col("precipitation_sum"),
        "driver_pseudo": F.col("driver_pseudo"),
    }
    return enriched.select(*[expr.alias(name) for name, expr in columns.items()], *keep)


def build_silver(
    trips: DataFrame,
    zones: DataFrame,
    weather: DataFrame,
    keep: Sequence[str] = (),
    minutes: str = "boundary",
) -> DataFrame:
    """Clean, enrich and project the raw trips: a scan with up to three map-side joins, no shuffle."""
    return silver_projection(enrich(clean_trips(trips, minutes), zones, weather), keep, minutes)
