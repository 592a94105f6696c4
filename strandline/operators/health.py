"""Did the data move? Checks over tables, as ``(stage, check, ok, detail)`` rows.

Every check judges by output that is there, never by what a checkpoint claims. Expected feeds, topics and
locations are short lists that the operator configures; they become literal tables, and the observed
tables are reduced to one row per list entry before they meet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.contracts import ACTIVITY_WINDOW_SECONDS, FRESHNESS_SECONDS, STAGES
from strandline.functions import age_seconds, iso_text, seconds, within
from strandline.operators.lists import expected_rows, listed
from strandline.sources.topics import end_offsets

RESULT = "stage STRING, check STRING, ok BOOLEAN, detail STRING"
OK, FAIL, BLOCKED = "OK", "FAIL", "BLOCKED"

# How far back a silent group is looked for, and how much further each step goes.
LOOK_BACK_SECONDS = 90 * 86_400
LOOK_BACK_FACTOR = 8

# What Spark says of a check that is itself wrong, as by a misspelt column.
FAULTY_CHECK = ("UNRESOLVED_", "DATATYPE_MISMATCH", "FIELD_NOT_FOUND", "AMBIGUOUS_")


def labelled(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Add ``label`` by looking ``column`` up in a configured list; unlisted rows go."""
    table = listed(df.sparkSession, f"{column} STRING, label STRING", list(labels.items()))
    return df.join(table, column, "inner")


def topic_presence(observed: DataFrame, expected: Sequence[str], column: str = "topic") -> DataFrame:
    """Each expected topic with ``found`` and its number of rows.

    The list filters the scan, so other topics are not even read.
    """
    spark = observed.sparkSession
    counts = observed.filter(F.col(column).isin(list(expected))).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return (
        expected_rows(spark, column, expected)
        .join(counts, column, "left")
        .select(
            column,
            F.col("n").isNotNull().alias("found"),
            F.coalesce("n", F.lit(0)).alias("n_rows"),
        )
    )


def missing_topics(observed: DataFrame, expected: Sequence[str], column: str = "topic") -> DataFrame:
    """Expected topics without a single row."""
    seen = observed.filter(F.col(column).isin(list(expected))).select(column).distinct()
    return expected_rows(observed.sparkSession, column, expected).join(seen, column, "left_anti")


def topic_totals(offsets: DataFrame) -> DataFrame:
    """Sum of end offsets per topic, from ``(topic, partition, end_offset)`` (A4)."""
    return offsets.groupBy("topic").agg(F.sum("end_offset").alias("total"))


def topic_checks(messages: DataFrame, expected: Sequence[str], stage: str = "kafka") -> DataFrame:
    """Topic exists and its offsets add up to more than zero (C4, A4, J1, P15), from its retained messages.

    It reads every message there is. :func:`offset_checks` takes offsets that somebody already knows.
    """
    return offset_checks(end_offsets(messages.filter(F.col("topic").isin(list(expected)))), expected, stage)


def offset_checks(offsets: DataFrame, expected: Sequence[str], stage: str = "kafka") -> DataFrame:
    """:func:`topic_checks` from ``(topic, partition, end_offset)``, as a broker or a query's progress reports them.

    A topic whose messages have all expired still has its end offsets, and passes.
    """
    totals = topic_totals(offsets.filter(F.col("topic").isin(list(expected))))
    return (
        expected_rows(offsets.sparkSession, "topic", expected)
        .join(totals, "topic", "left")
        .select(
            F.lit(stage).alias("stage"),
            F.col("topic").alias("check"),
            F.coalesce(F.col("total") > 0, F.lit(False)).alias("ok"),
            F.when(F.col("total").isNull(), "no such topic")
            .otherwise(F.format_string("end offsets sum to %d", "total"))
            .alias("detail"),
        )
    )


def recent_activity(
    log: DataFrame,
    expected: Sequence[str],
    as_of: Column,
    window_seconds: int = ACTIVITY_WINDOW_SECONDS,
    marker: str | None = None,
    feed: str = "topic",
    time: str = "timestamp",
    text: str = "json_str",
) -> DataFrame:
    """Expected feeds with the number of matching rows in ``[as_of - window, as_of]``.

    With ``marker`` only rows whose text contains it count. The time bounds reach the scan.
    """
    recent = log.filter(
        F.col(feed).isin(list(expected))
        & (F.col(time) >= as_of - seconds(window_seconds))
        & (F.col(time) <= as_of)
    )
    if marker is not None:
        recent = recent.filter(F.contains(F.col(text), F.lit(marker)))
    counts = recent.groupBy(feed).agg(F.count(F.lit(1)).alias("n"))
    return (
        expected_rows(log.sparkSession, feed, expected)
        .join(counts, feed, "left")
        .select(feed, F.coalesce("n", F.lit(0)).alias("n_recent"), F.col("n").isNotNull().alias("ok"))
    )


def activity_checks(
    activity: DataFrame, window_seconds: int, feed: str = "topic", stage: str = "producers"
) -> DataFrame:
    """:func:`recent_activity` as result rows."""
    return activity.select(
        F.lit(stage).alias("stage"),
        F.col(feed).alias("check"),
        "ok",
        F.format_string(f"%d records in the last {window_seconds} s", "n_recent").alias("detail"),
    )


def latest_by(df: DataFrame, group: str, time: str) -> DataFrame:
    """Latest time per group (A3)."""
    return df.groupBy(group).agg(F.max(time).alias("latest"))


def bounded_latest(
    df: DataFrame,
    group: str,
    time: str,
    expected: Sequence[str],
    as_of: Column,
    limit_seconds: int,
    look_back_seconds: int = LOOK_BACK_SECONDS,
) -> DataFrame:
    """Latest time of each expected group, reading old rows only where there is no recent one.

    A healthy group has a row within the limit, and the bounds on the time reach the scan. Groups without one are looked for
    further back, step by step, each step ``LOOK_BACK_FACTOR`` times as far and for what is still silent only, until
    ``look_back_seconds`` before ``as_of``. A group without any row in that time is not there, whatever the history before it holds, so
    a check never costs more than that. Rows later than ``as_of`` don't count: one with a wrong time must not keep its
    group fresh; :func:`future_checks` finds them. One row per expected group comes to the driver.
    """
    found: list[tuple[str, int]] = []
    silent, near, far = list(expected), 0, limit_seconds
    while silent:
        stretch = df.filter(F.col(group).isin(silent) & (F.col(time) >= as_of - seconds(far)))
        # What the steps before have read is not read again.
        stretch = stretch.filter(F.col(time) < as_of - seconds(near) if near else F.col(time) <= as_of)
        rows = latest_by(stretch, group, time).select(group, F.unix_micros("latest").alias("micros")).collect()
        found += [(row[0], row[1]) for row in rows]
        silent = [name for name in silent if name not in dict(found)]
        if far >= look_back_seconds:
            break
        near, far = far, min(far * LOOK_BACK_FACTOR, look_back_seconds)
    latest = listed(df.sparkSession, f"{group} STRING, micros BIGINT", found)
    return latest.select(group, F.timestamp_micros("micros").alias("latest"))


def future_checks(
    df: DataFrame,
    group: str,
    time: str,
    expected: Sequence[str],
    as_of: Column,
    stage: str,
    tolerance_seconds: int = 0,
) -> DataFrame:
    """Result rows: no expected group has rows more than ``tolerance_seconds`` later than ``as_of``.

    Only such rows are read; in a sound table there are none.
    """
    ahead = df.filter(F.col(group).isin(list(expected)) & (F.col(time) > as_of + seconds(tolerance_seconds)))
    counts = ahead.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max(time).alias("latest"))
    rows = expected_rows(df.sparkSession, group, expected).join(counts, group, "left")
    found = F.concat(F.format_string("%d rows are later than now, up to ", "n"), iso_text(F.col("latest")))
    return rows.select(
        F.lit(stage).alias("stage"),
        F.col(group).alias("check"),
        F.col("n").isNull().alias("ok"),
        F.when(F.col("n").isNull(), "no row is later than now").otherwise(found).alias("detail"),
    )


def freshness(
    latest: DataFrame,
    expected: Sequence[str],
    as_of: Column,
    limit_seconds: int = FRESHNESS_SECONDS,
    group: str = "stage",
) -> DataFrame:
    """Each expected group with its latest time, age and verdict; nothing there is not ok.

    The age is shown in whole seconds and judged to the microsecond.
    """
    joined = expected_rows(latest.sparkSession, group, expected).join(latest, group, "left")
    return joined.select(
        group,
        "latest",
        age_seconds(F.col("latest"), as_of).alias("age_seconds"),
        F.coalesce(within(F.col("latest"), as_of, limit_seconds), F.lit(False)).alias("ok"),
    )


def freshness_checks(fresh: DataFrame, stage: str, group: str = "stage") -> DataFrame:
    """:func:`freshness` as result rows."""
    age = F.format_string("(%d s old)", "age_seconds")
    found = F.concat_ws(" ", F.lit("latest"), iso_text(F.col("latest")), age)
    return fresh.select(
        F.lit(stage).alias("stage"),
        F.col(group).alias("check"),
        "ok",
        F.when(F.col("latest").isNull(), "nothing there").otherwise(found).alias("detail"),
    )


def guarded(checks: DataFrame, precondition: Column | bool, reason: str) -> DataFrame:
    """Fail all rows with ``reason`` unless the precondition holds."""
    holds = F.coalesce(precondition if isinstance(precondition, Column) else F.lit(precondition), F.lit(False))
    return checks.select(
        "stage",
        "check",
        F.when(holds, F.col("ok")).otherwise(F.lit(False)).alias("ok"),
        F.when(holds, F.col("detail")).otherwise(F.lit(reason)).alias("detail"),
    )


def reachable(
    spark: SparkSession, stage: str, expected: Sequence[str], checks: Callable[[], DataFrame]
) -> DataFrame:
    """Run checks now; if their source can not be read, one failed row per expected name.

    The result has one row per expected name, so taking it to the driver is safe. A check that names a column
    that is not there is wrong itself, and raises.
    """
    try:
        rows = checks().select("stage", "check", "ok", "detail").collect()
    except AnalysisException as error:
        condition = error.getCondition() or ""
        if condition.startswith(FAULTY_CHECK):
            raise
        reason = str(error).splitlines()[0] if condition.startswith("_LEGACY") or not condition else condition
        rows = [(stage, name, False, f"unreachable: {reason}") for name in expected]
    except Exception as error:  # whatever keeps the source from being read is a finding, not a crash
        reason = (str(error).splitlines() or [type(error).__name__])[0]
        rows = [(stage, name, False, f"unreachable: {reason}") for name in expected]
    return listed(spark, RESULT, rows)


def run_stages(parts: Mapping[str, Callable[[], DataFrame]], stage: str | None = None) -> DataFrame:
    """The checks of one stage, or of all in the order given (C1, C6). Nothing of another stage is computed."""
    if stage is not None and stage not in parts:
        raise ValueError(f"no stage {stage!r}, there are {list(parts)}")
    return all_checks(*(part() for name, part in parts.items() if stage in (None, name)))


def only_stage(checks: DataFrame, stage: str | None) -> DataFrame:
    """One stage, or all of them."""
    return checks if stage is None else checks.filter(F.col("stage") == stage)


def stage_report(checks: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """One row per stage in flow order: OK, FAIL, or BLOCKED by an earlier stage.

    A stage without any check row counts as failed (A7).
    """
    spark = checks.sparkSession
    order = listed(spark, "ord INT, stage STRING", list(enumerate(stages)))
    per_stage = checks.groupBy("stage").agg(
        F.bool_and(F.coalesce("ok", F.lit(False))).alias("ok"),
        F.count_if(~F.coalesce("ok", F.lit(False))).alias("n_failed"),
    )
    joined = order.join(per_stage, "stage", "left").select(
        "ord",
        "stage",
        F.coalesce("ok", F.lit(False)).alias("ok"),
        F.coalesce("n_failed", F.lit(0)).alias("n_failed"),
    )
    # Not partitioned, and it need not be: there is one row per configured stage.
    before = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    clear = F.coalesce(F.bool_and("ok").over(before), F.lit(True))
    return joined.select(
        "ord",
        "stage",
        F.when(~clear, BLOCKED).when(F.col("ok"), OK).otherwise(FAIL).alias("status"),
        "n_failed",
    )


def verdict(checks: DataFrame) -> DataFrame:
    """Number of failed checks and the overall verdict, in one row."""
    failed = ~F.coalesce("ok", F.lit(False))
    return checks.agg(
        F.count_if(failed).alias("n_failed"),
        F.coalesce(~F.bool_or(failed), F.lit(False)).alias("healthy"),
    )


def failures(checks: DataFrame) -> DataFrame:
    """The failed rows."""
    return checks.filter(~F.coalesce("ok", F.lit(False)))


def all_checks(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
