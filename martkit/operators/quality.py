"""Data-quality checks of the clean layer in one pass, and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from martkit.functions.portable import known

# Names of the checks, their severities and the columns that must be complete.
CRITICAL, WARNING = "critical", "warning"
COMPLETE_COLUMNS = ("pickup_ts", "total_amount", "pu_location_id")
CLEAR_IDENTIFIER = "driver_email"
REPORT_COLUMNS = ("name", "passed", "severity", "failed_rows", "total_rows", "detail")


class QualityGateError(RuntimeError):
    """At least one critical check failed."""


def _present(df: DataFrame, name: str) -> Column:
    """Not missing: neither null nor, in a float column, NaN."""
    is_float = df.schema[name].dataType.typeName() in ("double", "float")
    return (known(name) if is_float else F.col(name)).isNotNull()


def _share_text(share: Column, digits: int, after: str) -> Column:
    """Share as percent text; the share of nothing prints as nan."""
    percent = F.when(share.isNotNull(), F.format_string(f"%.{digits}f", share * 100)).otherwise("nan")
    return F.concat(percent, F.lit(f"% {after}"))


#: What a check state holds: counters, which add up, and which columns some rows had, which hold if any state has them.
COUNTERS = (
    "n", *(f"missing_{c}" for c in COMPLETE_COLUMNS), "bad_total", "bad_duration", "tips", "good_tips", "unmatched", "leaked",
)
PRESENT = ("has_total", "has_duration", "has_tips", "has_borough")
STATE_SCHEMA = ", ".join([*(f"{c} bigint" for c in COUNTERS), *(f"{c} boolean" for c in (*PRESENT, "has_identifier"))])


def check_state(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counters of all checks, one row (or one per group of ``by``, as a month's state): a single aggregate.

    Rows without a column miss its value; rows that carry a clear identifier have leaked.
    """
    have = set(df.columns)
    n = F.count(F.lit(1))

    def breaks(column: str, ok: Callable[[], Column]) -> Column:
        return F.count_if(~F.coalesce(ok(), F.lit(False))) if column in have else n

    tip = known(F.col("tip_pct").cast("double")) if "tip_pct" in have else F.lit(None).cast("double")
    counters = {
        "n": n,
        **{f"missing_{c}": breaks(c, lambda c=c: _present(df, c)) for c in COMPLETE_COLUMNS},
        "bad_total": breaks("total_amount", lambda: known(F.col("total_amount").cast("double")) >= 0),
        "bad_duration": breaks("trip_duration_min", lambda: F.col("trip_duration_min").between(1, 240)),
        "tips": F.count(tip),
        "good_tips": F.count_if(tip.between(0, 100)),
        "unmatched": breaks("pu_borough", lambda: F.col("pu_borough").isNotNull()),
        "leaked": n if CLEAR_IDENTIFIER in have else n - n,
    }
    columns = ("total_amount", "trip_duration_min", "tip_pct", "pu_borough")
    present = [F.lit(c in have).alias(name) for name, c in zip(PRESENT, columns, strict=True)]
    totals = df.groupBy(*by).agg(*[expr.alias(name) for name, expr in counters.items()])
    # A table with a clear identifier fails that check also when it has no row, so the column itself is noted.
    return totals.select(*by, *COUNTERS, *present, F.lit(CLEAR_IDENTIFIER in have).alias("has_identifier"))


def merge_states(states: DataFrame) -> DataFrame:
    """One state of the rows that all states were made of; of no state, that of an empty table with all columns."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]
    flags = [F.coalesce(F.bool_or(c), F.lit(True)).alias(c) for c in PRESENT]
    return states.agg(*sums, *flags, F.coalesce(F.bool_or("has_identifier"), F.lit(False)).alias("has_identifier"))


def report_of(state: DataFrame) -> DataFrame:
    """The checks of one state, one row each: name, passed, severity, failed_rows, total_rows, detail."""
    n, no_text, always = F.col("n"), F.lit(""), F.lit(True)
    leak = F.col("has_identifier")
    tips, good = F.col("tips"), F.col("good_tips")
    tip_share = good / F.when(tips > 0, tips)
    borough_share = (n - F.col("unmatched")) / F.when(n > 0, n)
    rows = [
        ("volume_non_vide", n > 0, CRITICAL, F.when(n > 0, 0).otherwise(1), n, F.concat(n.cast("string"), F.lit(" lignes")), always),
        *(
            (f"non_null__{c}", (missing := F.col(f"missing_{c}")) == 0, CRITICAL, missing, n, F.concat(missing.cast("string"), F.lit(" nulls")), always)
            for c in COMPLETE_COLUMNS
        ),
        ("total_amount_positif", F.col("bad_total") == 0, CRITICAL, F.col("bad_total"), n, no_text, F.col("has_total")),
        ("duree_plausible_1_240min", F.col("bad_duration") == 0, CRITICAL, F.col("bad_duration"), n, no_text, F.col("has_duration")),
        (
            "tip_pct_borne_0_100", F.coalesce(tip_share > 0.99, F.lit(False)), WARNING, tips - good, tips,
            _share_text(tip_share, 2, "dans [0,100]"), F.col("has_tips"),
        ),
        (
            "jointure_zones_ok", F.coalesce(borough_share > 0.95, F.lit(False)), WARNING, F.col("unmatched"), n,
            _share_text(borough_share, 1, "des courses ont un borough"), F.col("has_borough"),
        ),
        (
            "rgpd_pas_de_pii_claire", ~leak, CRITICAL, F.col("leaked"), n,
            F.when(leak, "FUITE: driver_email présent !").otherwise("driver_email absent de silver"), always,
        ),
    ]
    structs = [
        F.when(
            applies,
            F.struct(
                F.lit(name).alias("name"), passed.alias("passed"), F.lit(severity).alias("severity"),
                failed.cast("bigint").alias("failed_rows"), total.cast("bigint").alias("total_rows"), detail.alias("detail"),
            ),
        )
        for name, passed, severity, failed, total, detail, applies in rows
    ]
    return state.select(F.inline(F.filter(F.array(*structs), lambda row: row.isNotNull())))


def quality_report(df: DataFrame) -> DataFrame:
    """One row per check: name, passed, severity, failed_rows, total_rows, detail.

    All checks are read off a single global aggregate, so each task sends one row. A missing
    column fails its completeness check and drops its range check.
    """
    return report_of(check_state(df))


def quality_gate(report: DataFrame | Sequence[Row]) -> list[dict]:
    """Return the rows of a report (nine at most), or raise if a critical check failed."""
    rows = [row.asDict() for row in (report.collect() if isinstance(report, DataFrame) else report)]
    failed = [r["name"] for r in rows if not r["passed"] and r["severity"] == CRITICAL]
    if failed:
        raise QualityGateError(f"{len(failed)} critical check(s) failed: {', '.join(failed)}")
    return rows
