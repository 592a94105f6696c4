"""Places of the log as ranges: islands, gaps, handoff."""

import importlib
import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from strandline.operators.handoff import after_positions
from strandline.operators.intervals import (
    BLOCK,
    gap_checks,
    joined_ranges,
    offset_gaps,
    offset_ranges,
    outside_ranges,
)

LOG = "topic STRING, partition INT, offset BIGINT"


def log_of(spark, rows):
    return spark.createDataFrame(rows, LOG)


def islands(offsets):
    out = []
    for o in sorted(set(offsets)):
        if out and out[-1][1] == o - 1:
            out[-1] = (out[-1][0], o)
        else:
            out.append((o, o))
    return out


def ranges_of(df):
    return sorted(tuple(r) for r in df.select("topic", "partition", "first", "last").collect())


@pytest.mark.parametrize("seed", range(3))
def test_islands_as_in_plain_python(spark, seed):
    draw = random.Random(seed)
    rows = []
    for topic, partition in (("a", 0), ("a", 1), ("b", 0)):
        at = draw.choice([0, 5, BLOCK - 3])
        for _ in range(draw.randrange(1, 12)):
            length = draw.choice([1, 2, 30, BLOCK, 2 * BLOCK + 7]) if draw.random() < 0.3 else draw.randrange(1, 40)
            rows += [(topic, partition, at + k) for k in range(length)]
            at += length + draw.choice([0, 1, 2, BLOCK, BLOCK - 1])
    rows += rows[::7]
    want = sorted(
        (t, p, a, b)
        for t, p in {r[:2] for r in rows}
        for a, b in islands(o for topic, part, o in rows if (topic, part) == (t, p))
    )
    assert ranges_of(offset_ranges(log_of(spark, rows).repartition(5))) == want


def test_block_edges(spark):
    edges = [0, BLOCK - 1, BLOCK, 2 * BLOCK - 1, 3 * BLOCK, 3 * BLOCK + 1]
    got = ranges_of(offset_ranges(log_of(spark, [("a", 0, o) for o in edges])))
    assert [r[2:] for r in got] == islands(edges)
    whole = spark.range(4 * BLOCK).selectExpr("'a' AS topic", "0 AS partition", "id AS offset")
    assert ranges_of(offset_ranges(whole)) == [("a", 0, 0, 4 * BLOCK - 1)]


def test_null_and_negative_offsets_and_empty_logs(spark):
    assert ranges_of(offset_ranges(log_of(spark, [("a", 0, None), ("a", 0, -1), ("a", 0, 3)]))) == [("a", 0, 3, 3)]
    assert offset_ranges(log_of(spark, [])).count() == 0
    assert offset_gaps(offset_ranges(log_of(spark, []))).count() == 0


def test_a_busy_partition_is_the_work_of_many_tasks(spark):
    busy = spark.range(20 * BLOCK).selectExpr("'a' AS topic", "0 AS partition", "id AS offset")
    plan = plan_of(offset_ranges(busy))
    # Before the ranges of a partition meet, its blocks have been reduced to their ends.
    assert re.search(r"Exchange hashpartitioning\([^)]*_groupingexpression", plan)


def test_gaps_and_their_check(spark):
    log = log_of(spark, [("a", 0, o) for o in (2, 3, 7, 8)] + [("a", 1, 0), ("b", 0, 0), ("b", 0, 1)])
    assert sorted(tuple(r) for r in offset_gaps(offset_ranges(log)).collect()) == [("a", 0, 4, 6, 3)]
    assert sorted(tuple(r) for r in offset_gaps(offset_ranges(log), starts=0).collect()) == [("a", 0, 0, 1, 2), ("a", 0, 4, 6, 3)]
    rows = {r["check"]: r for r in gap_checks(log, ["a", "b", "c"]).collect()}
    assert [rows[t]["ok"] for t in "abc"] == [False, True, False]
    assert rows["a"]["detail"] == "5 offsets, 3 missing in 1 gaps"
    assert rows["c"]["detail"] == "no messages"
    assert gap_checks(log, ["a"], allowed=3).first()["ok"]


def test_ranges_that_overlap_or_touch_are_one(spark):
    parts = spark.createDataFrame(
        [("a", 0, 0, 9), ("a", 0, 4, 5), ("a", 0, 10, 12), ("a", 0, 14, 14), ("b", 0, 1, 1)],
        "topic STRING, partition INT, first BIGINT, last BIGINT",
    )
    assert ranges_of(joined_ranges(parts)) == [("a", 0, 0, 12), ("a", 0, 14, 14), ("b", 0, 1, 1)]


def test_what_lies_outside(spark):
    draw = random.Random(5)
    held = {(t, p, o) for t in "ab" for p in (0, 1) for o in range(3 * BLOCK) if draw.random() < 0.001 or o // 700 % 3 == 0}
    ranges = offset_ranges(log_of(spark, sorted(held)[::1]))
    rows = [(t, p, draw.randrange(4 * BLOCK)) for t in "abc" for p in (0, 1, 2) for _ in range(400)] + [("a", 0, None), (None, 0, 1)]
    got = sorted((tuple(r) for r in outside_ranges(log_of(spark, rows), ranges).collect()), key=repr)
    assert got == sorted((r for r in rows if r not in held), key=repr)
    assert outside_ranges(log_of(spark, rows), offset_ranges(log_of(spark, []))).count() == len(rows)


def test_places_reach_the_scan_and_cost_no_shuffle(spark, tmp_path):
    log = spark.range(1_000).selectExpr("concat('t', id % 2) AS topic", "CAST(id % 5 AS INT) AS partition", "id AS offset")
    log.write.parquet(f"{tmp_path}/log")
    rows = spark.read.parquet(f"{tmp_path}/log")
    known = {("t0", p): 300 + p for p in range(5)} | {("t1", 1): 7}
    new = after_positions(rows, known)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1_000)
    plan = plan_of(new)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "offset" in plan.split("PushedFilters")[1].split("ReadSchema")[0]
    assert "hashpartitioning" not in plan
    want = [r for r in rows.collect() if r["offset"] > known.get((r["topic"], r["partition"]), -1)]
    assert sorted(new.collect()) == sorted(want)


def test_places_of_a_thousand_partitions_and_odd_ones(spark):
    rows = [("a", p, o) for p in range(0, 1_000, 7) for o in (4, 5, 6)] + [("a", None, 1), (None, 0, 1), ("b", 2_000, 0)]
    known = {("a", p): 5 for p in range(1_000)}
    got = after_positions(log_of(spark, rows), known).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((r for r in rows if r[:2] not in known or r[2] > 5), key=repr)
    strange = {("a", 0): 5, ("a", None): 3, (None, 0): 0}
    got = after_positions(log_of(spark, [("a", None, 3), ("a", None, 4), (None, 0, 0), (None, 0, 1), ("a", 0, 6)]), strange)
    assert sorted(map(tuple, got.collect()), key=repr) == [("a", 0, 6), ("a", None, 4), (None, 0, 1)]


def test_backfill_reads_its_places_back(spark, tmp_path, monkeypatch):
    from strandline.contracts import Feed
    from strandline.operators.parse import LOG_KEY
    from strandline.plans import backfill as plans_backfill
    from strandline.plans.backfill import backfill

    scanned = []
    module = importlib.import_module("strandline.plans.backfill")
    real = module.positions_of
    monkeypatch.setattr(module, "positions_of", lambda df: scanned.append(df.inputFiles()) or real(df))
    feed = Feed.of("k", "k INT", [("k", "field", "k")])
    bronze = log_of(spark, [("a", 0, 4), ("a", 0, 9), ("a", 1, 2), ("b", 0, 7)])
    bronze = bronze.withColumn("timestamp", F.timestamp_seconds("offset")).withColumn("json_str", F.lit('{"k":1}'))
    bronze.write.parquet(f"{tmp_path}/bronze")
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    want = {("a", 0): 9, ("a", 1): 2, ("b", 0): 7}
    for quarantine in (False, True):
        out = f"{tmp_path}/silver{quarantine}"
        assert plans_backfill(bronze, feed, out, keys=LOG_KEY, keep=LOG_KEY, by_day=True, quarantine=quarantine).positions == want
        assert all(out in name for name in scanned.pop())
    # Another key may drop the row of the largest offset.
    assert backfill(bronze, feed, f"{tmp_path}/other", keep=LOG_KEY).positions == want
    assert all("bronze" in name for name in scanned.pop())
