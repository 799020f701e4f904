"""Expressions that give one answer whatever the partitioning, the session zone or the SQL dialect.

All of them are built-in Catalyst expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Name = str | Column


def as_col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time ------------------------------------------------------------------------------------------


def _minute_number(ts: Column) -> Column:
    # Day, hour and minute of a local time need no time zone; the seconds fall away.
    local = ts.cast("timestamp_ntz")
    day = F.unix_date(F.to_date(local)).cast("bigint")
    return day * 1440 + F.hour(local) * 60 + F.minute(local)


def minutes_between(start: Name, end: Name, mode: str = "boundary") -> Column:
    """Minutes from start to end.

    ``boundary`` counts the minute marks passed (10:00:59 to 10:01:01 is 1), ``elapsed`` the full
    minutes gone by (0 for the same pair).
    """
    a, b = as_col(start), as_col(end)
    if mode == "boundary":
        return _minute_number(b) - _minute_number(a)
    if mode == "elapsed":
        return (b.cast("timestamp_ntz") - a.cast("timestamp_ntz")).cast("interval minute").cast("bigint")
    raise ValueError(f"mode must be 'boundary' or 'elapsed', not {mode!r}")


def iso_dow(ts: Name) -> Column:
    """Day of week, Monday 1 to Sunday 7."""
    return F.weekday(as_col(ts)) + F.lit(1)


# --- rounding --------------------------------------------------------------------------------------


def round_to_int(c: Name) -> Column:
    """Number to int, halves to the even neighbour (2.5 -> 2, 3.5 -> 4)."""
    return F.rint(as_col(c).cast("double")).cast("int")


def _nearest(v: Column) -> Column:
    even = F.rint(v)
    return F.when(F.abs(v - even) == F.lit(0.5), v + F.signum(v) * F.lit(0.5)).otherwise(even)


def scale_round(c: Name, n: int = 0) -> Column:
    """Round a double to n decimals by scaling, rounding halves away from zero and scaling back.

    ``F.round`` goes through decimal text and disagrees on values like 1.005; it also leaves primitive
    arithmetic. This form is plain floating-point code.
    """
    v = as_col(c).cast("double")
    if n == 0:
        return _nearest(v)
    factor = F.lit(float(10**n))
    return _nearest(v * factor) / factor


# --- sums that do not depend on the order of the rows ----------------------------------------------

EXACT_DECIMALS = 8
_SPLIT = 10_000


def exact_halves(c: Name) -> tuple[Column, Column]:
    """The two bigint sums that make up ``exact_sum``. Halves of parts of a table add up to those of the whole."""
    units = F.rint(as_col(c).cast("double") * F.lit(float(10**EXACT_DECIMALS))).cast("bigint")
    high = F.sum(F.call_function("div", units, F.lit(_SPLIT).cast("bigint")))
    return high, F.sum(units % F.lit(_SPLIT).cast("bigint"))


def from_halves(high: Column, low: Column) -> Column:
    total = high.cast("decimal(20,0)") * F.lit(_SPLIT).cast("decimal(6,0)") + low.cast("decimal(20,0)")
    return total.cast("double") / F.lit(float(10**EXACT_DECIMALS))


def exact_sum(c: Name) -> Column:
    """Order-independent sum of doubles that carry at most ``EXACT_DECIMALS`` decimals.

    Each value becomes a count of 1e-8 units, added in two bigint halves, so the map-side partial sum is
    primitive arithmetic (about the speed of a double sum and eight times that of a decimal sum). The
    high half holds totals up to 9.2e14, the low half 9e14 rows; a single value beyond 9.2e10 raises.
    """
    return from_halves(*exact_halves(c))


def stable_sum(c: Name, n: int | None = None) -> Column:
    total = exact_sum(c)
    return total if n is None else scale_round(total, n)


def stable_avg(c: Name, n: int | None = None) -> Column:
    """Mean of the non-null values from the exact sum; null for an empty group."""
    count = F.count(as_col(c))
    mean = exact_sum(c) / F.when(count > 0, count.cast("double"))
    return mean if n is None else scale_round(mean, n)


# --- missing values --------------------------------------------------------------------------------


def known(c: Name) -> Column:
    """The value, with NaN turned into null."""
    col = as_col(c)
    return F.when(~F.isnan(col), col)


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN into null in the float columns, in one projection."""
    floats = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (columns is None or f.name in columns)
    }
    return df.select(*[known(c).alias(c) if c in floats else F.col(c) for c in df.columns])


# --- reproducible order ----------------------------------------------------------------------------


def hash_hex(key: Name, seed: int | str) -> Column:
    """A pseudo-random but repeatable position for a key, as 32 hexadecimal digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_col(key).cast("string")))
