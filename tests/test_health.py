"""Health checks."""

import os
from datetime import timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F

from strandline.contracts import ACTIVITY_WINDOW_SECONDS, STAGES
from strandline.functions import instant
from strandline.operators import health
from strandline.plans import check_files
from strandline.sources import scan_topics


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture
def log(envelope_of):
    return envelope_of([("a", 0, "Published x"), ("a", 10, "other"), ("b", 5, "other"), ("c", 10, "Published")])


def test_presence_and_missing_j1_a7(log):
    rows = by(health.topic_presence(log, ["a", "b", "zz"]), "topic")
    assert (rows["a"]["found"], rows["a"]["n_rows"]) == (True, 2)
    assert (rows["zz"]["found"], rows["zz"]["n_rows"]) == (False, 0)
    assert "c" not in rows
    assert [r[0] for r in health.missing_topics(log, ["a", "zz"]).collect()] == ["zz"]


def test_labels_j2(log):
    assert {r["label"] for r in health.labelled(log, "topic", {"a": "A"}).collect()} == {"A"}


def test_recent_activity_a6_c3_p12(log):
    at_10 = F.lit(at(10))
    everything = by(health.recent_activity(log, ["a", "b", "zz"], at_10, 10), "topic")
    assert [everything[t]["n_recent"] for t in ("a", "b", "zz")] == [2, 1, 0]
    marked = by(health.recent_activity(log, ["a", "b", "c"], at_10, 10, marker="Published"), "topic")
    assert [marked[t]["ok"] for t in ("a", "b", "c")] == [True, False, True]
    # The bounds belong to the window, and what comes after the as-of time does not count.
    assert by(health.recent_activity(log, ["a"], F.lit(at(9)), 9, marker="Published"), "topic")["a"]["ok"]
    assert not by(health.recent_activity(log, ["a"], F.lit(at(9)), 8), "topic")["a"]["ok"]
    checks = health.activity_checks(health.recent_activity(log, ["a"], at_10), ACTIVITY_WINDOW_SECONDS)
    assert checks.first()["detail"] == "2 records in the last 1800 s"


def test_topic_checks_c4_p15(spark):
    log = spark.createDataFrame([("a", 0, 4), ("a", 1, 0)], "topic STRING, partition INT, offset BIGINT")
    rows = by(health.topic_checks(log, ["a", "b"]), "check")
    assert rows["a"]["ok"] and rows["a"]["detail"] == "end offsets sum to 6"
    assert not rows["b"]["ok"] and rows["b"]["detail"] == "no such topic"


@pytest.mark.parametrize(("age", "ok"), [(0, True), (1800, True), (1800.000001, False), (1801, False)])
def test_freshness_limit_is_inclusive_to_the_microsecond_p14(spark, envelope_of, age, ok):
    df = envelope_of([("a", 0, "x")])
    fresh = health.freshness(health.latest_by(df, "topic", "timestamp"), ["a"], instant(at(age)), group="topic")
    assert fresh.first()["ok"] is ok


def test_nothing_there_fails_and_is_not_dropped_a7(envelope_of):
    latest = health.latest_by(envelope_of([("a", 0, "x")]), "topic", "timestamp")
    rows = by(health.freshness_checks(health.freshness(latest, ["a", "b"], instant(at(5)), group="topic"), "bronze", "topic"), "check")
    assert rows["a"]["ok"] and "(5 s old)" in rows["a"]["detail"]
    assert not rows["b"]["ok"] and rows["b"]["detail"] == "nothing there"


def checks_of(spark, rows):
    return spark.createDataFrame([(s, c, ok, "") for s, c, ok in rows], health.RESULT)


def test_report_blocks_what_follows_c2(spark):
    checks = checks_of(spark, [("producers", "x", True), ("kafka", "x", True), ("kafka", "y", False), ("bronze", "x", True), ("silver", "x", False)])
    rows = health.stage_report(checks).orderBy("ord").collect()
    assert [r["stage"] for r in rows] == list(STAGES)
    assert [r["status"] for r in rows] == ["OK", "FAIL", "BLOCKED", "BLOCKED"]
    assert [r["n_failed"] for r in rows] == [0, 1, 0, 1]


def test_report_without_rows_for_a_stage_or_a_null_result(spark):
    checks = checks_of(spark, [("producers", "x", True), ("kafka", "x", None)])
    assert [r["status"] for r in health.stage_report(checks).orderBy("ord").collect()] == ["OK", "FAIL", "BLOCKED", "BLOCKED"]
    assert [r["status"] for r in health.stage_report(checks.limit(0)).orderBy("ord").collect()][0] == "FAIL"


def test_verdict_and_failures_c7_a5_p16(spark):
    checks = checks_of(spark, [("a", "x", True), ("a", "y", False), ("b", "z", None)])
    assert tuple(health.verdict(checks).first()) == (2, False)
    assert tuple(health.verdict(checks.filter("ok")).first()) == (0, True)
    assert sorted(r["check"] for r in health.failures(checks).collect()) == ["y", "z"]
    assert health.only_stage(checks, "b").count() == 1 and health.only_stage(checks, None).count() == 3


@pytest.mark.parametrize("holds", [True, False, None])
def test_guard_c9_p13(spark, holds):
    checks = checks_of(spark, [("bronze", "x", True)]).withColumn("running", F.lit(holds).cast("boolean"))
    row = health.guarded(checks, F.col("running"), "writer is down").first()
    assert row["ok"] is bool(holds)
    assert row["detail"] == ("" if holds else "writer is down")


def test_unreachable_source_gives_failed_rows_c8(spark):
    rows = health.reachable(
        spark, "kafka", ["a", "b"], lambda: health.topic_checks(scan_topics(spark, ["a", "b"], "nowhere:1"), ["a", "b"])
    ).collect()
    assert [(r["check"], r["ok"]) for r in rows] == [("a", False), ("b", False)]
    assert all(r["detail"].startswith("unreachable:") for r in rows)

    def broken():
        raise OSError("no route\nmore")

    assert health.reachable(spark, "s", ["x"], broken).first()["detail"] == "unreachable: no route"
    late = health.reachable(spark, "s", ["x"], lambda: checks_of(spark, [("s", "x", True)]).withColumn("ok", F.raise_error(F.lit("boom")).cast("boolean")))
    assert late.first()["ok"] is False
    fine = health.reachable(spark, "s", ["x"], lambda: checks_of(spark, [("s", "x", True)]))
    assert fine.first()["ok"]


def test_file_freshness_by_age_of_files_c5(spark, tmp_path):
    for name, age in (("new", 60), ("old", 7200), ("edge", 1800)):
        spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        for entry in os.scandir(f"{tmp_path}/{name}"):
            os.utime(entry.path, (at(-age).timestamp(),) * 2)
    os.makedirs(f"{tmp_path}/empty")
    (tmp_path / "empty" / "note.txt").write_text("not a table")
    names = ["new", "old", "edge", "empty", "none"]
    fresh = by(check_files(spark, [(n, f"{tmp_path}/{n}") for n in names], at(0)), "stage")
    assert {n: fresh[n]["ok"] for n in names} == {"new": True, "old": False, "edge": True, "empty": False, "none": False}
    assert {n: fresh[n]["age_seconds"] for n in names} == {"new": 60, "old": 7200, "edge": 1800, "empty": None, "none": None}
    assert by(check_files(spark, [("new", f"{tmp_path}/new")], at(0) + timedelta(days=1)), "stage")["new"]["ok"] is False


def test_a_misspelt_column_is_no_finding(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        health.reachable(spark, "s", ["x"], lambda: spark.range(1).select("no_such_column"))


def test_offsets_of_a_topic_whose_messages_are_gone(spark):
    offsets = spark.createDataFrame([("a", 0, 6), ("b", 0, 0)], "topic STRING, partition INT, end_offset BIGINT")
    rows = by(health.offset_checks(offsets, ["a", "b", "c"]), "check")
    assert [(rows[t]["ok"], rows[t]["detail"]) for t in "abc"] == [
        (True, "end offsets sum to 6"), (False, "end offsets sum to 0"), (False, "no such topic")]


def test_old_rows_are_read_for_silent_groups_only(spark, envelope_of):
    from conftest import at

    log = envelope_of([("a", 0, ""), ("a", 100, ""), ("b", -5_000, ""), ("z", 1, "")])
    latest = health.bounded_latest(log, "topic", "timestamp", ["a", "b", "c"], F.lit(at(200)), 1_000)
    assert {r["topic"]: r["latest"].timestamp() for r in latest.collect()} == {"a": at(100).timestamp(), "b": at(-5_000).timestamp()}


def test_lists_are_literal_rows_of_the_plan(spark):
    table = health.listed(spark, "name STRING, n BIGINT", [("a'b", 1), (None, None), ("c", 2**40)])
    assert sorted(map(tuple, table.collect()), key=repr) == sorted([("a'b", 1), (None, None), ("c", 2**40)], key=repr)
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()
    assert health.listed(spark, "name STRING", []).count() == 0
