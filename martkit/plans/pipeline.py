"""The whole run: land, clean, build marts, check, learn, report."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.operators.dimensions import assert_unique_key
from martkit.operators.learning import DEPTH, TREES, predict, train_and_score
from martkit.operators.quality import (
    CRITICAL,
    STATE_SCHEMA,
    QualityGateError,
    check_state,
    merge_states,
    quality_gate,
    report_of,
)
from martkit.operators.runmetrics import STEP_SCHEMA, append_metrics, observed, run_report
from martkit.plans import ledger, marts
from martkit.plans.silver import build_silver
from martkit.sources import schemas
from martkit.sources.documents import to_json_rows, write_metrics
from martkit.sources.landing import land_trips, land_weather, land_zones
from martkit.sources.layers import for_months, layer_counts, read_layer
from martkit.sources.models import load_model, stage_model
from martkit.sources.versions import WHOLE, Manifest, Versions


#: Carried behind the 26 columns of the clean layer: where a row comes from.
ROW_KEY = ("_source_file", "_source_row")


# Tables of the lake that are kept in versions: place below the root, and columns.
SILVER, DEMAND, TIPS, PREDICTIONS = "silver/trips", "gold/demand_by_zone_hour", "gold/tips_analysis", "gold/ml_predictions"
# Predictions for months that the published model has not been trained on, and the models.
LATER, MODELS = "gold/ml_later_predictions", "models/price"
DEMAND_PARTS, TIPS_PARTS, CHECKS = "gold/demand_parts", "gold/tips_parts", "gold/check_states"
PARTS = (
    (DEMAND_PARTS, DEMAND, marts.DEMAND, marts.DEMAND.parts_schema(schemas.SILVER_TRIPS)),
    (TIPS_PARTS, TIPS, marts.TIPS, marts.TIPS.parts_schema(schemas.SILVER_TRIPS)),
)
TABLES = {
    "silver_trips": (SILVER, schemas.STORED_SILVER),
    "demand_by_zone_hour": (DEMAND, schemas.DEMAND),
    "tips_analysis": (TIPS, schemas.TIPS),
    "ml_predictions": (PREDICTIONS, schemas.PREDICTIONS),
}


@dataclass(frozen=True)
class Lake:
    """Where each layer lives below one root, on any file system Spark can reach."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def trips(self) -> str:
        return self.path("bronze", "trips")

    @property
    def zones(self) -> str:
        return self.path("bronze", "zones")

    @property
    def weather(self) -> str:
        return self.path("bronze", "weather")

    @property
    def silver(self) -> str:
        return self.path("silver", "trips")

    @property
    def demand(self) -> str:
        return self.path("gold", "demand_by_zone_hour")

    @property
    def tips(self) -> str:
        return self.path("gold", "tips_analysis")

    @property
    def predictions(self) -> str:
        return self.path("gold", "ml_predictions")

    @property
    def metrics(self) -> str:
        return self.path("gold", "ml_metrics")

    def versions(self, spark: SparkSession) -> Versions:
        """The clean layer, the marts and what they are made of: months and tables that are replaced at once."""
        return Versions(spark, self.root)

    def counted(self, spark: SparkSession) -> dict[str, Callable[[], DataFrame | None]]:
        """Readers of the layers whose rows are reported; None for one that nobody has built."""

        def reader(table: str) -> Callable[[], DataFrame | None]:
            name, schema = TABLES[table]

            def read() -> DataFrame | None:
                versions = self.versions(spark)
                manifest = versions.latest()
                return versions.read(name, schema, manifest=manifest) if name in manifest.tables else None

            return read

        return {
            "silver_trips": reader("silver_trips"),
            "gold_demand_by_zone_hour": reader("demand_by_zone_hour"),
            "gold_tips_analysis": reader("tips_analysis"),
        }


@dataclass(frozen=True)
class Sources:
    """Source paths; ``{month}`` in a path stands for the month being landed."""

    trips: str
    weather: str
    zones: str


@dataclass
class Run:
    """One run over some months."""

    spark: SparkSession
    lake: Lake
    sources: Sources
    months: Sequence[str]
    salt: str
    domain: str = "example.test"
    key_version: int | None = None
    fit_rows: int | None = None
    trees: int = TREES
    depth: int = DEPTH
    recorded: list[tuple[str, float, dict]] = field(default_factory=list)

    def record(self, name: str, value: float, **tags: str) -> None:
        self.recorded.append((name, value, tags))

    def land(self) -> None:
        for month in self.months:
            rows = land_trips(
                self.spark,
                self.sources.trips.format(month=month),
                self.lake.trips,
                month,
                self.salt,
                self.domain,
                self.key_version,
            )
            self.record("RowsIngested", rows, layer="bronze", month=month)
            land_weather(
                self.spark, self.sources.weather.format(month=month), self.lake.weather, month
            )
        land_zones(self.spark, self.sources.zones, self.lake.zones)

    def transform(self) -> None:
        trips = read_layer(self.spark, self.lake.trips, schemas.LANDED_TRIPS)
        zones = read_layer(self.spark, self.lake.zones, schemas.RAW_ZONES)
        weather = read_layer(self.spark, self.lake.weather, schemas.LANDED_WEATHER)
        assert_unique_key(zones, "location_id")
        assert_unique_key(weather.select(F.col("weather_date").cast("date")), "weather_date")
        versions = self.lake.versions(self.spark)
        before = versions.latest()
        changes: dict[str, dict[str, str | None]] = {t: {} for t in (SILVER, DEMAND_PARTS, TIPS_PARTS, CHECKS, DEMAND, TIPS)}
        rows = 0
        for month in self.months:  # the other months of the clean layer, and of what is made of it, stay as they are
            cleaned = build_silver(for_months(trips, [month]), zones, weather, ROW_KEY)
            watched = observed(cleaned, f"silver_trips_{month}")
            changes[SILVER] |= (held := versions.stage(SILVER, watched.df, month))
            rows += watched.rows
            silver = versions.staged(SILVER, held, schemas.SILVER_TRIPS)
            for place, _, mart, _ in PARTS:
                changes[place] |= versions.stage(place, mart.parts(silver), month)
            # Read with the schema of the files themselves: a column that should not be there must show.
            files = self.spark.read.parquet(*versions.folders(SILVER, manifest=Manifest(0, {SILVER: held})))
            changes[CHECKS] |= versions.stage(CHECKS, check_state(files), month)
        self.record("RowsProcessed", rows, layer="silver", table="trips")
        after = before.changed(changes, before.number)
        for place, table, mart, schema in PARTS:
            watched = observed(mart.merge(versions.read(place, schema, manifest=after)), table.replace("/", "_"))
            changes[table] |= versions.stage(table, watched.df)
            self.record("RowsProcessed", watched.rows, layer="gold", table=table.split("/")[1])
        versions.commit(changes, before)

    def check(self) -> None:
        states = self.lake.versions(self.spark).read(CHECKS, STATE_SCHEMA)
        report = report_of(merge_states(states)).collect()
        failed = sum(1 for r in report if not r["passed"] and r["severity"] == CRITICAL)
        self.record("QualityFailedChecks", failed)
        self.record("QualityRowsTested", report[0]["total_rows"])
        quality_gate(report)

    def learn(self) -> None:
        versions = self.lake.versions(self.spark)
        before = versions.latest()
        # A row is named by its month and its number in what was delivered, however often layers are rebuilt.
        place = F.concat_ws(":", "year", "month", "_source_row")
        silver = self._stored_silver().withColumn("row_place", place)
        result = train_and_score(silver, "row_place", self.fit_rows, self.trees, self.depth)
        # Model and predictions count together; months predicted with the last model are in the new split.
        changes = {
            MODELS: stage_model(versions, MODELS, result["fitted"]),
            PREDICTIONS: versions.stage(PREDICTIONS, result["predictions"]),
            LATER: dict.fromkeys(before.months(LATER)),
        }
        versions.commit(changes, before)
        write_metrics(result["metrics"], self.lake.metrics)
        metrics = result["metrics"].first()
        self.record("MLModelMAE", metrics["model_metrics"]["mae"])
        self.record("MLImprovementPct", metrics["improvement_mae_pct"] or 0.0)

    def _stored_silver(self) -> DataFrame:
        return read_table(self.spark, self.lake, "silver_trips")

    def silver(self) -> DataFrame:
        """The 26 columns of the clean layer, all months."""
        return self._stored_silver().select(schemas.SILVER_TRIPS.names)

    def key(self) -> str | None:
        """What tells this run from others: what is delivered, and all settings."""
        by_month = [path.format(month=m) for m in self.months for path in (self.sources.trips, self.sources.weather)]
        settings = {n: getattr(self, n) for n in ("months", "domain", "key_version", "fit_rows", "trees", "depth")}
        return ledger.delivery_key(self.spark, [*by_month, self.sources.zones], settings, self.salt)

    def steps(self) -> list[tuple[str, Callable[[], None]]]:
        return [
            ("bronze", self.land),
            ("silver_gold", self.transform),
            ("quality", self.check),
            ("ml", self.learn),
        ]


def _attempted(step: Callable[[], None], attempts: int, delay: float) -> tuple[int, Exception | None]:
    """Try a step up to ``attempts`` times; a failed check is final. Returns the tries and the last error."""
    for tried in range(1, attempts + 1):
        try:
            step()
            return tried, None
        except QualityGateError as error:
            return tried, error
        except Exception as error:  # reported, then raised again by the caller
            if tried == attempts:
                return tried, error
            time.sleep(delay)
    raise ValueError("a step needs at least one attempt")


def run_pipeline(
    spark: SparkSession,
    root: str,
    sources: Sources,
    months: Sequence[str],
    salt: str,
    attempts: int = 3,
    delay: float = 5.0,
    resume: bool = True,
    **options,
) -> DataFrame:
    """Run all steps in order over some months and return the run report; also written below root.

    Only the given months of the raw and the clean layer are written, and read, again. Each keeps its part of the marts and
    of the checks; both are put together from all parts. Rows, parts and marts change in one commit. A failing
    step is tried again after ``delay`` seconds (commits, listings and late files are not covered by Spark's own
    retry of tasks). The first step that stays failed ends the run: its report is written and its error raised.
    The next run over the same delivery with the same settings goes on at that step (``resume=False``: starts anew).
    """
    run = Run(spark, Lake(root.rstrip("/")), sources, months, salt, **options)
    done: list[tuple[str, str, int, float]] = []
    error: Exception | None = None
    root, mark, key = run.lake.root, uuid.uuid4().hex, run.key()
    names = [name for name, _ in run.steps()]
    skipped = ledger.finished_steps(spark, root, key, names, run.lake.versions(spark).latest().number) if resume else 0
    ledger.note(spark, root, mark, key, -1, "", ledger.STARTED, run.lake.versions(spark).latest().number)
    for place, (name, step) in enumerate(run.steps()):
        if place < skipped:
            done.append((name, ledger.SKIPPED, 0, 0.0))
            ledger.note(spark, root, mark, key, place, name, ledger.SKIPPED, run.lake.versions(spark).latest().number)
            continue
        began, before = time.monotonic(), len(run.recorded)

        def again(step=step, before=before) -> None:
            del run.recorded[before:]  # what a failed try has recorded
            step()

        tried, error = _attempted(again, attempts, delay)
        status = ledger.FAILED if error else ledger.OK
        done.append((name, status, tried, round(time.monotonic() - began, 1)))
        if error:
            break
        ledger.note(spark, root, mark, key, place, name, status, run.lake.versions(spark).latest().number)
    try:
        if run.recorded:
            append_metrics(spark, f"{run.lake.root}/run_metrics", run.recorded)
        counts = layer_counts(spark, run.lake.counted(spark))
        report = run_report(spark.createDataFrame(done, STEP_SCHEMA), counts)
        to_json_rows(report, f"{run.lake.root}/pipeline_run_report")
    except Exception as unwritten:
        if error:
            raise error from unwritten  # the step's own error matters more than the report
        raise
    if error:
        raise error
    return report


def score_months(spark: SparkSession, root: str, months: Sequence[str]) -> dict[str, int]:
    """Predict months of the clean layer with the published model, for the predictions mart; returns rows per month.

    A month predicted before is replaced, one without rows becomes empty. For months that came after the training: those
    the model was trained on have their test rows in the mart already. All months change in one commit; if another
    model is published in the meantime, nothing does, and CommitConflict is raised.
    """
    lake = Lake(root.rstrip("/"))
    versions = lake.versions(spark)
    before = versions.latest()
    fitted = load_model(versions, MODELS, manifest=before)
    held: dict[str, str | None] = {}
    rows: dict[str, int] = {}
    for month in months:
        silver = versions.read(SILVER, schemas.STORED_SILVER, [month], before)
        watched = observed(predict(fitted, silver), f"predicted_{month}")
        held |= versions.stage(LATER, watched.df, month)
        rows[month] = watched.rows
    same_model = {WHOLE: before.tables[MODELS][WHOLE]}
    versions.commit({LATER: held, MODELS: same_model}, before)
    return rows


def read_table(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The clean layer or a mart by name, for the reads: what the last commit left."""
    place, schema = TABLES[table]
    versions = lake.versions(spark)
    manifest = versions.latest()
    found = versions.read(place, schema, manifest=manifest)
    if place == PREDICTIONS:  # test rows, and the months predicted since
        found = found.unionByName(versions.read(LATER, schema, manifest=manifest))
    return found
