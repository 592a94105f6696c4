"""What one task holds or does must not grow with the table."""

from __future__ import annotations

import re

import duckdb
import pytest
from conftest import plan_of

import __spark_entry__ as entry
from check import TABLES, rows_of
from strandline.operators import health
from strandline.operators.intervals import offset_ranges
from strandline.sinks import buckets
from workloads import mechanisms, messages, storage

SF_DIR = "/root/testdata/sf0.001"


def agrees(spark, name):
    got = entry.queries()[name](spark, SF_DIR)
    with duckdb.connect() as oracle:
        for table in TABLES:
            oracle.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        result = oracle.execute(entry.oracle_sql()[name])
        want = rows_of([c[0] for c in result.description], result.fetchall())
    return rows_of(got.columns, got.collect()) == want


def test_a_larger_table_has_more_buckets(spark, monkeypatch):
    assert [buckets.buckets_for(rows) for rows in (0, 1_000_000, 36_000_000)] == [4, 4, 144]
    made = []
    write = storage.write_bucketed
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 100)
    monkeypatch.setattr(storage, "write_bucketed", lambda *a: made.append(a[-1]) or write(*a))
    assert agrees(spark, "handoff_bucketed")
    assert made == [10]


@pytest.mark.parametrize("name", ["stream_key_sketch", "consumer_lag", "late_rows", "compacted_parts", "feed_outages_stream"])
def test_a_larger_table_lands_in_more_files(spark, monkeypatch, name):
    assert messages.files_for(spark, SF_DIR, 2) == 1
    monkeypatch.setattr(messages, "FILE_ROWS", 100)
    assert messages.files_for(spark, SF_DIR, 2) == 5
    assert agrees(spark, name)


def test_silver_is_parsed_once_for_all_steps_of_a_search(spark, monkeypatch):
    plans = []
    search = health.bounded_latest
    monkeypatch.setattr(mechanisms.health, "bounded_latest", lambda df, *a: plans.append(plan_of(df)) or search(df, *a))
    assert agrees(spark, "stage_graph")
    assert len(plans) == 2 and not any("from_json" in plan for plan in plans)


def test_bitmaps_are_cut_by_as_many_tasks_as_there_are(spark):
    rows = spark.range(200_000).selectExpr("'t' AS topic", "0 AS partition", "id * 2 AS offset")
    plan = re.sub(r"#\d+L?", "", plan_of(offset_ranges(rows)))
    assert re.search(rf"block, {spark.sparkContext.defaultParallelism}\), REPARTITION_BY_NUM", plan)
