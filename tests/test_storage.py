"""How tables are laid out: buckets, curves, days, swapped definitions, sketches of days."""

import random
import threading
from datetime import datetime, timedelta, timezone

import pytest
from conftest import at, plan_of
from pyspark.sql import functions as F

from strandline.contracts import ENVELOPE
from strandline.operators import keep_new
from strandline.operators.profile import daily_sketches, lag_checks, lag_profile, merged
from strandline.sinks import (
    batch_overwrite,
    curve_place,
    keep_new_bucketed,
    register_external,
    register_versioned,
    write_bucketed,
)
from strandline.sinks.buckets import buckets_of
from strandline.sources import recent_days, stream_days
from strandline.streaming import read_parts, stream_parts


@pytest.fixture
def lake(spark, tmp_path):
    name = f"lake_{random.randrange(10**9)}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}.db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ buckets


def test_only_the_new_side_is_shuffled(spark, lake, tmp_path):
    held = spark.range(0, 3_000, 3).selectExpr("id AS k", "id % 7 AS p", "'held' AS v")
    write_bucketed(held, f"{lake}.t", f"{tmp_path}/t", ["k", "p"], 6)
    assert buckets_of(spark, f"{lake}.t") == 6
    new = spark.range(3_000).selectExpr("id AS k", "id % 7 AS p", "'new' AS v")
    twice = new.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    found = keep_new_bucketed(twice, f"{lake}.t", ["k", "p"])
    found.collect()
    plan = plan_of(found).split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan
    assert "SortMergeJoin" in plan
    table = spark.table(f"{lake}.t")
    assert rows_of(found) == rows_of(keep_new(new, table, ["k", "p"]))


def test_nulls_in_keys_order_and_plain_tables(spark, lake, tmp_path):
    held = spark.createDataFrame([(1, "x"), (2, "x")], "k INT, v STRING")
    write_bucketed(held, f"{lake}.t", f"{tmp_path}/t", ["k"], 2)
    new = spark.createDataFrame([(2, "a"), (3, "b"), (3, "c"), (None, "d"), (None, "e")], "k INT, v STRING")
    assert rows_of(keep_new_bucketed(new, f"{lake}.t", ["k"], ["v"])) == [(3, "b"), (None, "d")]
    assert keep_new_bucketed(new.limit(0), f"{lake}.t", ["k"]).count() == 0
    held.write.saveAsTable(f"{lake}.plain")
    with pytest.raises(ValueError, match="not bucketed"):
        keep_new_bucketed(new, f"{lake}.plain", ["k"])


# ------------------------------------------------------------------ curve


def interleaved(x, y, bits=16):
    return sum(((x >> b) & 1) << (2 * b) | ((y >> b) & 1) << (2 * b + 1) for b in range(bits))


def test_place_on_the_curve_as_in_plain_python(spark):
    draw = random.Random(1)
    rows = [(draw.uniform(-20, 120), draw.uniform(-90, 90)) for _ in range(200)] + [(0.0, -90.0), (100.0, 90.0), (None, 0.0)]
    steps = (1 << 16) - 1
    step = lambda v, low, high: 0 if v is None else int(max(0.0, min(1.0, (v - low) / (high - low))) * steps)
    table = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    got = table.select("a", "b", curve_place({"a": (0.0, 100.0), "b": (-90.0, 90.0)}).alias("z")).collect()
    assert [r["z"] for r in got] == [interleaved(step(r["a"], 0, 100), step(r["b"], -90, 90)) for r in got]


def files_in_box(spark, path, since, until, low, high):
    """Files whose least and greatest values leave room for the box: those that a scan opens."""
    ends = spark.read.parquet(path).groupBy("_metadata.file_path").agg(
        F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"), F.min("lat").alias("l0"), F.max("lat").alias("l1")
    )
    inside = (F.col("t1") >= F.lit(since)) & (F.col("t0") < F.lit(until)) & (F.col("l1") >= low) & (F.col("l0") <= high)
    return ends.where(inside).count(), ends.count()


def test_a_box_reads_fewer_files_than_with_time_alone(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("timestamp_seconds(1700000000 + id * 60) AS timestamp", "CAST((id * 7919) % 18000 AS DOUBLE) / 100 - 90 AS lat")
    end = at(40_000 * 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        batch_overwrite(rows, f"{tmp_path}/time", cluster_by="timestamp")
        batch_overwrite(rows, f"{tmp_path}/both", cluster_by={"timestamp": (at(0), end), "lat": (-90.0, 90.0)})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    box = (at(0), end - timedelta(seconds=20_000 * 60), 10.0, 20.0)  # half of the time, an eighteenth of the latitudes
    by_time, all_time = files_in_box(spark, f"{tmp_path}/time", *box)
    by_both, all_both = files_in_box(spark, f"{tmp_path}/both", *box)
    assert all_time > 50 and all_both > 50
    assert by_both * 2 < by_time
    assert spark.read.parquet(f"{tmp_path}/both").count() == 40_000


# ------------------------------------------------------------------ days


def test_only_the_days_named_are_listed(spark, envelope_of, tmp_path):
    day = 86_400
    envelope_of([("t", n * day, str(n)) for n in range(9)]).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ENVELOPE).parquet(f"{tmp_path}/in")
    stream_parts(stream, f"{tmp_path}/bronze", f"{tmp_path}/cp1", None).awaitTermination(60)
    start = at(0)

    def run(today, lateness=2):
        days = recent_days(start + timedelta(days=today), lateness)
        source = stream_days(spark, f"{tmp_path}/bronze", ENVELOPE, days)
        query = stream_parts(source, f"{tmp_path}/copy", f"{tmp_path}/cp2", None)
        query.awaitTermination(60)
        assert query.exception() is None
        return query.lastProgress["numInputRows"] if query.lastProgress else 0

    copied = lambda: sorted(r["json_str"] for r in read_parts(spark, f"{tmp_path}/copy", ENVELOPE).collect())
    run(3)
    assert copied() == ["1", "2", "3", "4"]
    run(3)  # nothing new
    run(5)
    assert copied() == ["1", "2", "3", "4", "5", "6"]
    # A row that comes late to a day that is still named is read; one for an older day waits for a run that names it.
    envelope_of([("t", 4 * day, "late"), ("t", 0, "very late")]).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ENVELOPE).parquet(f"{tmp_path}/in")
    stream_parts(stream, f"{tmp_path}/bronze", f"{tmp_path}/cp1", None).awaitTermination(60)
    run(6)
    assert copied() == ["1", "2", "3", "4", "5", "6", "7", "late"]
    run(6, lateness=7)
    assert copied() == ["0", "1", "2", "3", "4", "5", "6", "7", "late", "very late"]


def test_recent_days():
    as_of = datetime(2024, 3, 1, 0, 30, tzinfo=timezone(timedelta(hours=1)))  # still February in UTC
    assert recent_days(as_of, 1) == ["2024-02-28", "2024-02-29", "2024-03-01"]


# ------------------------------------------------------------------ definitions that are swapped


def test_a_table_is_never_absent_while_it_is_redefined(spark, lake, tmp_path):
    spark.range(3).selectExpr("id AS a").write.parquet(f"{tmp_path}/0")
    spark.range(5).selectExpr("id AS a", "id * 2 AS `b c`").write.parquet(f"{tmp_path}/1")
    spark.range(4).selectExpr("id AS a", "id * 2 AS `b c`").write.parquet(f"{tmp_path}/2")
    register_external(spark, f"{lake}.t", f"{tmp_path}/0")
    absent, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            if not spark.catalog.tableExists(f"{lake}.t"):
                absent.append(1)

    reader = threading.Thread(target=look)
    reader.start()
    try:
        for version in (1, 2, 1, 2):
            register_external(spark, f"{lake}.t", f"{tmp_path}/{version}")
    finally:
        stop.set()
        reader.join()
    assert absent == []
    assert spark.table(f"{lake}.t").columns == ["a", "b c"]
    assert spark.table(f"{lake}.t").count() == 4
    spark.range(6).selectExpr("CAST(id AS STRING) AS a").write.parquet(f"{tmp_path}/3")
    assert rows_of(register_external(spark, f"{lake}.t", f"{tmp_path}/3")) == [(str(n),) for n in range(6)]


def test_definitions_of_any_columns_in_one_step(spark, lake, tmp_path):
    spark.range(3).selectExpr("id AS a", "id AS b").write.parquet(f"{tmp_path}/0")
    spark.range(5).selectExpr("CAST(id AS STRING) AS a").write.parquet(f"{tmp_path}/1")
    for version in (0, 1):
        register_versioned(spark, f"{lake}.seen", f"{tmp_path}/{version}")
    assert spark.table(f"{lake}.seen").dtypes == [("a", "string")]
    assert spark.table(f"{lake}.seen").count() == 5
    held = [t.name for t in spark.catalog.listTables(lake)]
    assert len(held) == 2  # the view and the table of its last definition
    assert spark.read.parquet(f"{tmp_path}/0").count() == 3
    spark.range(1).write.saveAsTable(f"{lake}.managed")
    with pytest.raises(ValueError, match="not a view"):
        register_versioned(spark, f"{lake}.managed", f"{tmp_path}/0")


# ------------------------------------------------------------------ sketches of days


def test_merged_days_equal_one_pass(spark):
    rows = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'b', 'a') AS topic", "timestamp_seconds(1700000000 + id * 20) AS timestamp",
        "timestamp_seconds(1700000000 + id * 20 - (id * 7919) % 1000) AS event_time", "id % 9000 AS k",
    )
    days = daily_sketches(rows, ["k"])
    assert days.select("day").distinct().count() == 8
    once = daily_sketches(rows.withColumn("timestamp", F.col("timestamp")), ["k"], by=())
    assert once.select("day").count() == 8
    for topic, n, keys in (("a", 20_000, 6_000), ("b", 10_000, 3_000)):
        row = lag_profile(days).where(F.col("topic") == topic).first()
        assert row["n"] == n
        assert row["keys"] == pytest.approx(keys, rel=0.03)
        assert [row[f"lag_p{p}"] for p in (50, 95, 99)] == pytest.approx([500, 950, 990], abs=12)
    half = merged(days.where("day < '2023-11-18'"))
    both = half.unionByName(merged(days.where("day >= '2023-11-18'")))
    assert lag_profile(both).where("topic = 'a'").first()["keys"] == lag_profile(days).where("topic = 'a'").first()["keys"]


def test_lag_of_rows_without_event_time(spark):
    rows = spark.createDataFrame([("a", at(0), None, 1), ("b", at(10), at(5), 1)], "topic STRING, timestamp TIMESTAMP, event_time TIMESTAMP, k INT")
    found = {r["topic"]: r for r in lag_profile(daily_sketches(rows, ["k"])).collect()}
    assert (found["a"]["n"], found["a"]["lag_p50"]) == (1, None)
    assert found["b"]["lag_p50"] == 5
    checks = {r["check"]: (r["ok"], r["detail"]) for r in lag_checks(lag_profile(daily_sketches(rows, ["k"])), 4).collect()}
    assert checks == {"a": (False, "no event times"), "b": (False, "95 of 100 rows within 5 s, limit 4 s")}
    assert lag_profile(daily_sketches(rows.limit(0), ["k"])).count() == 0


def test_file_checks_list_the_days_of_the_limit_only(spark, tmp_path, monkeypatch):
    import importlib
    import os

    from strandline.plans import check_files

    module = importlib.import_module("strandline.plans.health")
    asked = []
    real = module.file_inventory
    monkeypatch.setattr(module, "file_inventory", lambda *a, **k: asked.append(k.get("days")) or real(*a, **k))
    now = datetime(2024, 5, 20, 12, tzinfo=timezone.utc)
    for name, day, age in (("new", "2024-05-20", 60), ("old", "2024-05-10", 9 * 86_400), ("ancient", "2024-01-01", 140 * 86_400)):
        spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/{name}/day={day}")
        for entry in os.scandir(f"{tmp_path}/{name}/day={day}"):
            os.utime(entry.path, ((now - timedelta(seconds=age)).timestamp(),) * 2)
    names = ["new", "old", "ancient", "none"]
    fresh = {r["stage"]: r for r in check_files(spark, [(n, f"{tmp_path}/{n}") for n in names], now, look_back_days=30).collect()}
    assert {n: fresh[n]["age_seconds"] for n in names} == {"new": 60, "old": 9 * 86_400, "ancient": None, "none": None}
    assert [fresh[n]["ok"] for n in names] == [True, False, False, False]
    assert asked[0] == ["2024-05-19", "2024-05-20", "2024-05-21"]
    assert len(asked[1]) == 32
    whole = {r["stage"]: r for r in check_files(spark, [(n, f"{tmp_path}/{n}") for n in names], now).collect()}
    assert whole["ancient"]["age_seconds"] == 140 * 86_400
    assert asked[2:] == [None, None]
