"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the data folder (default sf0.1), BENCH_CPUS the local cores. Each query is built and run
once in full (every column of every row is produced) in one session, in the order listed; ``land_raw`` is
the landing of the raw layer that the others read, ``full_pipeline`` the whole run from source files. The model of
the learning queries is trained once, in ``price_model``; ``prediction_mart`` and ``top_errors`` read its results.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martkit.plans.pipeline import run_pipeline  # noqa: E402
from martkit.session import local_session, scratch_path  # noqa: E402
from martkit.testbed import adapters, registry  # noqa: E402

HEADLINE = [
    "silver_trips",
    "clean_rows",
    "rejected_by_rule",
    "star_enrich",
    "pseudonyms",
    "demand_by_zone_hour",
    "tips_analysis",
    "k_suppressed_groups",
    "top_zones",
    "busiest_hours",
    "tips_by_payment",
    "kpis",
    "dashboard_top_zones",
    "heat_matrix",
    "demand_filtered",
    "tips_ranked",
    "labelled_tips",
    "quality_report",
    "demand_from_months",
    "quality_from_months",
    "partitioned_layer",
    "month_selection",
    "sampled_trips",
    "impute_median",
    "split_rows",
    "mean_baseline",
    "regression_metrics",
    "isolation_forest",
    "price_model",
    "prediction_mart",
    "top_errors",
    "cost_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()  # the session itself is up before the clock starts

    seconds: dict[str, float] = {}
    began = time.perf_counter()
    adapters.land_raw(spark, sf_dir)
    seconds["land_raw"] = round(time.perf_counter() - began, 3)
    queries = registry.all_queries()
    for name in chosen:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        # The whole run with its default model: land, clean, marts, checks, 60 trees of depth 14, report.
        sources = adapters.deliver(spark, sf_dir)
        began = time.perf_counter()
        report = run_pipeline(spark, scratch_path(spark, "lake"), sources, ["2024-01"], "bench-salt").first()
        seconds["full_pipeline"] = round(time.perf_counter() - began, 3)
        for step in report["steps"]:
            print(f"  {step['step']}: {step['seconds']}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
