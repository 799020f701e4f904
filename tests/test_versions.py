"""Months that are replaced at once: readers, writers that die, writers that meet, and what is merged from months."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martkit.operators import quality
from martkit.sources.versions import CommitConflict, Manifest, Versions

SCHEMA = "id bigint, x string, year int, month string"


@pytest.fixture
def versions(spark, tmp_path):
    return Versions(spark, str(tmp_path))


def rows(spark, x, *ids):
    return spark.createDataFrame([(i, x) for i in ids], "id bigint, x string")


def content(versions, table="t", months=None):
    return sorted(tuple(r) for r in versions.read(table, SCHEMA, months).collect())


def test_replacing_a_month(spark, versions):
    assert content(versions) == []
    versions.replace("t", rows(spark, "a", 1, 2), "2024-01")
    versions.replace("t", rows(spark, "a", 3), "2024-02")
    versions.replace("t", rows(spark, "b", 4), "2024-01")
    assert content(versions) == [(3, "a", 2024, "02"), (4, "b", 2024, "01")]
    assert content(versions, months=["2024-02", "2025-01"]) == [(3, "a", 2024, "02")]
    versions.replace("t", rows(spark, "b").limit(0), "2024-01")  # a month without rows
    assert content(versions) == [(3, "a", 2024, "02")] and versions.latest().months("t") == ["2024-01", "2024-02"]


def test_a_writer_that_dies_between_its_steps(spark, versions, monkeypatch):
    """Rows are written, the commit never happens: the old month is still there, and the remains can be removed."""
    versions.replace("t", rows(spark, "old", 1), "2024-01")

    def killed(manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_put_manifest", killed)
        with pytest.raises(KeyboardInterrupt):
            versions.replace("t", rows(spark, "new", 1), "2024-01")
    assert content(versions) == [(1, "old", 2024, "01")]
    assert versions.collect_old(older_than=3600.0) == 0  # somebody might be about to commit it
    assert versions.collect_old(older_than=-5.0) == 1
    assert content(versions) == [(1, "old", 2024, "01")]


def test_a_writer_that_dies_while_writing_rows(spark, versions):
    versions.replace("t", rows(spark, "old", 1), "2024-01")
    bad = rows(spark, "new", 1, 2).withColumn("id", F.when(F.col("id") == 2, F.raise_error("lost")).otherwise(F.col("id")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        versions.replace("t", bad, "2024-01")
    assert content(versions) == [(1, "old", 2024, "01")]


def test_a_draft_manifest_is_not_read(spark, versions, tmp_path):
    versions.replace("t", rows(spark, "old", 1), "2024-01")
    (tmp_path / "_manifests" / ".half").write_text('{"t": {"2024')
    assert content(versions) == [(1, "old", 2024, "01")]


def test_readers_keep_what_they_began_with(spark, versions):
    versions.replace("t", rows(spark, "a", 1), "2024-01")
    began = versions.read("t", SCHEMA)
    versions.replace("t", rows(spark, "b", 2), "2024-01")
    versions.collect_old(keep=2, older_than=-5.0)
    assert [r.x for r in began.collect()] == ["a"]
    assert versions.collect_old(keep=1, older_than=-5.0) == 1
    assert content(versions) == [(2, "b", 2024, "01")]


def test_two_writers(spark, versions):
    """Different months both get in; the same month is an error for the later one, and nothing changes."""
    before = versions.latest()
    one, two = versions.stage("t", rows(spark, "one", 1), "2024-01"), versions.stage("t", rows(spark, "two", 2), "2024-02")
    versions.commit({"t": one}, before)
    versions.commit({"t": two}, before)
    assert [r[0] for r in content(versions)] == [1, 2]
    late = versions.stage("t", rows(spark, "late", 3), "2024-01")
    with pytest.raises(CommitConflict, match="2024-01"):
        versions.commit({"t": late}, before)
    assert [r[0] for r in content(versions)] == [1, 2]


def test_the_same_number_is_taken_once(versions):
    assert versions._put_manifest(Manifest(7, {"t": {"2024-01": "a"}}))
    assert not versions._put_manifest(Manifest(7, {"t": {"2024-01": "b"}}))
    assert versions.latest().tables == {"t": {"2024-01": "a"}}
    assert [p.name for p in Path(versions.root, "_manifests").glob("*.json")] == ["000000000007.json"]


def test_tables_change_together(spark, versions, monkeypatch):
    """A commit of two tables is seen whole or not at all."""
    versions.commit({"t": versions.stage("t", rows(spark, "a", 1), "2024-01"), "u": versions.stage("u", rows(spark, "a", 1))})
    changes = {"t": versions.stage("t", rows(spark, "b", 2), "2024-01"), "u": versions.stage("u", rows(spark, "b", 2))}
    whole = "id bigint, x string"
    assert [r[1] for r in content(versions)] == ["a"] and [r.x for r in versions.read("u", whole).collect()] == ["a"]
    versions.commit(changes)
    assert [r[1] for r in content(versions)] == ["b"] and [r.x for r in versions.read("u", whole).collect()] == ["b"]


def test_many_months_in_one_write(spark, versions):
    df = spark.createDataFrame([(1, "a", 2024, 1), (2, "a", 2024, 12), (3, "a", 2025, 1)], "id bigint, x string, year int, month int")
    held = versions.stage_months("t", df, ["2024-01", "2024-02"])
    assert sorted(held) == ["2024-01", "2024-02", "2024-12", "2025-01"] and held["2024-02"] is None
    versions.commit({"t": held})
    assert content(versions) == [(1, "a", 2024, "01"), (2, "a", 2024, "12"), (3, "a", 2025, "01")]
    versions.replace("t", rows(spark, "b", 9), "2024-02")
    assert content(versions, months=["2024-02"]) == [(9, "b", 2024, "02")]


def good(spark, **changed):
    row = {
        "pickup_ts": "2024-01-01 10:00:00", "total_amount": 20.0, "pu_location_id": 100, "trip_duration_min": 12, "tip_pct": 15.0,
        "pu_borough": "Manhattan", "driver_pseudo": "abc123",
    }
    row = {k: v for k, v in (row | changed).items() if v != "absent"}
    return spark.createDataFrame([row] * 10)


def merged(spark, *frames):
    states = [quality.check_state(f) for f in frames]
    union = states[0]
    for s in states[1:]:
        union = union.unionByName(s)
    return {r["name"]: r for r in quality.report_of(quality.merge_states(union)).collect()}


def test_merged_check_states(spark):
    """Clean months pass; one bad month fails its check for all of them; counts add up."""
    clean = merged(spark, good(spark), good(spark))
    assert all(r["passed"] for r in clean.values() if r["severity"] == quality.CRITICAL) and clean["volume_non_vide"]["total_rows"] == 20
    bad = merged(spark, good(spark), good(spark, total_amount=-5.0))
    assert not bad["total_amount_positif"]["passed"] and bad["total_amount_positif"]["failed_rows"] == 10
    leaked = merged(spark, good(spark), good(spark, driver_email="a@b"))["rgpd_pas_de_pii_claire"]
    assert not leaked["passed"] and (leaked["failed_rows"], leaked["total_rows"]) == (10, 20)


def test_a_month_without_a_column(spark):
    """Its rows miss the value; a check of a column that no month has is left out."""
    report = merged(spark, good(spark), good(spark, total_amount="absent"))
    assert report["non_null__total_amount"]["failed_rows"] == report["total_amount_positif"]["failed_rows"] == 10
    report = merged(spark, good(spark, total_amount="absent"), good(spark, total_amount="absent"))
    assert "total_amount_positif" not in report and report["non_null__total_amount"]["failed_rows"] == 20


def test_no_state(spark):
    report = merged(spark, good(spark).limit(0))
    assert not report["volume_non_vide"]["passed"] and report["total_amount_positif"]["passed"]
    empty = spark.createDataFrame([], quality.STATE_SCHEMA)
    assert len(quality.report_of(quality.merge_states(empty)).collect()) == 9
