"""Messages that bear the very same time are different messages (H2)."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Events of which four bear one time before the cutoff, and four one time behind it."""
    folder = str(tmp_path_factory.mktemp("same"))
    times = [datetime(2024, 1, 3, 5, 6, 7, 89)] * 4 + [datetime(2024, 1, 20, 5, 6, 7, 89)] * 4 + [datetime(2024, 1, 25)]
    kinds = ["view", "view", "click", "error", "click", "view", "view", "signup", "view"]
    rows = [(k, time, k % 3, kind, 10.0 * k, f'{{"k": {k % 2}}}') for k, (time, kind) in enumerate(zip(times, kinds, strict=True))]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "backfill_quarantine",
        "backfill_quarantine_rest",
        "stream_quarantine",
        "stream_quarantine_rest",
        "stream_late_row",
        "dedup_prefers_complete",
    ],
)
def test_no_message_is_lost_to_another_of_its_time(spark, folder, name):
    got = entry.queries()[name](spark, folder)
    with duckdb.connect() as oracle:
        oracle.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
        columns = ", ".join(f'"{column}"' for column in got.columns)
        want = oracle.execute(f"SELECT {columns} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
