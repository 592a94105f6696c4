"""Progress, drift, graphs of stages, silences, key sketches, salted dedup, freshness that is bounded."""

import json
import random
from datetime import timedelta

import pytest
from conftest import at, plan_of
from pyspark.sql import functions as F

from strandline.contracts import ENVELOPE, Feed
from strandline.functions import instant
from strandline.operators import health, outages
from strandline.operators.drift import expected_paths, schema_drift
from strandline.operators.graph import all_needs, in_order, stage_graph
from strandline.streaming import (
    ProgressTable,
    consumer_lag,
    first_within_watermark_salted,
    progress_checks,
    read_parts,
    read_progress,
    source_offsets,
    stream_parts,
)
from strandline.streaming.progress import PROGRESS
from strandline.streaming.sketch import level_for, parts_without, write_sketch


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def wait(query):
    query.awaitTermination(60)
    assert query.exception() is None


@pytest.fixture
def scratch(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    return str(tmp_path)


# ------------------------------------------------------------------ progress


def test_progress_of_a_stream_becomes_a_table(spark, envelope_of, scratch):
    for n in range(3):
        envelope_of([("a", n, "x"), ("a", n, "y")]).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    source = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    with ProgressTable(spark, f"{scratch}/progress") as table:
        wait(stream_parts(source, f"{scratch}/out", f"{scratch}/cp", None, name="copy"))
    assert table.errors == []
    progress = read_progress(spark, f"{scratch}/progress")
    row = consumer_lag(progress).where("name = 'copy'").first()
    assert (row["batches"], row["rows_in"], row["late_rows"], row["lag"]) == (3, 6, 0, None)
    # A query that stops moving fails its check, and so does one that never moved.
    end = row["last_at"]
    for later, ok in ((10, True), (61, False)):
        checks = progress_checks(progress, ["copy", "none"], F.lit(end + timedelta(seconds=later)), 60)
        assert rows_of(checks, "check", "ok") == [("copy", ok), ("none", False)]
    assert "no report" in {r["detail"] for r in checks.collect()}
    assert read_progress(spark, f"{scratch}/nothing").count() == 0


def report(name, batch, seconds, sources, rows=5, query="q"):
    text = json.dumps({"sources": sources})
    return (name, query, "r", batch, at(seconds).isoformat(), rows, 10, 0, text)


def test_offsets_and_lag_from_reports_alone(spark):
    first = [{"endOffset": {"t": {"0": 1, "1": 1}}, "latestOffset": {"t": {"0": 9, "1": 1}}}]
    last = [{"endOffset": {"t": {"0": 7, "1": 5}}, "latestOffset": {"t": {"0": 9, "1": 5}}}, {"endOffset": {"logOffset": 3}}]
    rows = [report("a", 0, 0, first), report("a", 1, 10, last), report("b", 4, 5, [{"endOffset": None}])]
    progress = spark.createDataFrame(rows, PROGRESS).withColumn("at", F.to_timestamp("at"))
    assert rows_of(source_offsets(progress), "topic", "partition", "end_offset", "latest_offset", "lag") == [
        ("t", 0, 7, 9, 2), ("t", 1, 5, 5, 0)]
    assert rows_of(consumer_lag(progress), "name", "batches", "rows_in", "last_batch", "lag") == [
        ("a", 2, 10, 1, 2), ("b", 1, 5, 4, None)]
    checks = progress_checks(progress, ["a", "b"], F.lit(at(12)), 60, max_lag=1)
    assert rows_of(checks, "check", "ok", "detail") == [
        ("a", False, "batch 1, 2 s ago, 2 messages behind"), ("b", True, "batch 4, 7 s ago")]
    ends = source_offsets(progress).select("topic", "partition", "end_offset")
    assert health.offset_checks(ends, ["t"]).first()["detail"] == "end offsets sum to 12"


def test_a_report_that_is_there_twice_counts_once(spark, scratch):
    table = spark.createDataFrame([report("a", 0, 0, [])], PROGRESS).withColumn("day", F.lit("2023-11-14"))
    for _ in range(2):
        table.write.mode("append").partitionBy("day").parquet(f"{scratch}/p")
    assert consumer_lag(read_progress(spark, f"{scratch}/p")).first()["rows_in"] == 5
    assert read_progress(spark, f"{scratch}/p", ["2023-11-15"]).count() == 0


# ------------------------------------------------------------------ drift

SHAPE = Feed.of(
    "shape", "a INT, b STRUCT<c: DOUBLE, d: STRING>, l ARRAY<STRUCT<e: BIGINT, m: STRUCT<q: INT>>>", [("a", "field", "a")]
)


def test_drift_of_each_kind(envelope_of, scratch):
    texts = [
        '{"a":1,"b":{"c":1.5,"d":"x"},"l":[{"e":1,"m":{"q":1}},{"e":"2"}]}',
        '{"a":"1","z":{"y":1},"b":{"c":2,"k":null,"w":true}}',
        "{bad", None, "[1]", '{"a":null,"l":[]}', '{"l":5,"b":7}', '{"a b":3}',
    ]
    got = rows_of(schema_drift(envelope_of([("t", 0, text) for text in texts]), SHAPE), "path", "verdict", "kind", "n", "of")
    assert got == sorted(
        [
            ("$", "retyped", "MALFORMED", 2, 8), ("$", "retyped", "ARRAY", 1, 8),
            ("$.a", "missing", None, 3, 5), ("$.a", "retyped", "STRING", 1, 5), ("$.a b", "unknown", "BIGINT", 1, 5),
            ("$.b", "missing", None, 2, 5), ("$.b", "retyped", "BIGINT", 1, 5), ("$.b.d", "missing", None, 1, 2),
            ("$.b.w", "unknown", "BOOLEAN", 1, 2), ("$.l", "missing", None, 2, 5), ("$.l", "retyped", "BIGINT", 1, 5),
            ("$.l[].e", "retyped", "STRING", 1, 2), ("$.l[].m", "missing", None, 1, 2), ("$.z", "unknown", "OBJECT", 1, 5),
        ],
        key=repr,
    )


def test_drift_agrees_with_the_parse(envelope_of, spark, scratch):
    """What is reported as retyped is what the parse turns into NULL."""
    from strandline.operators import parse

    draw = random.Random(2)
    values = ["1", "1.5", '"x"', "true", "null", "{}", "[]", '{"c":1}', "12345678901"]
    texts = [f'{{"a":{draw.choice(values)},"b":{draw.choice(values)}}}' for _ in range(200)]
    bronze = envelope_of([("t", 0, text) for text in texts])
    parsed = parse(bronze, SHAPE).select("json_str", F.col("data.a").isNull().alias("lost"), F.col("data.b").isNull().alias("gone"))
    report = {(r["path"], r["verdict"]): 0 for r in schema_drift(bronze, SHAPE).collect()}
    for r in schema_drift(bronze, SHAPE).collect():
        report[r["path"], r["verdict"]] += r["n"]
    rows = parsed.collect()
    large = sum('"a":12345678901' in r["json_str"] for r in rows)  # whole, but beyond the type's range
    assert report["$.a", "retyped"] + report["$.a", "missing"] + large == sum(r["lost"] for r in rows)
    assert report["$.b", "retyped"] + report["$.b", "missing"] == sum(r["gone"] for r in rows)


def test_drift_by_topic_and_day_in_one_scan(spark, envelope_of, scratch):
    envelope_of([("t", 0, '{"x":1}'), ("u", 0, '{"a":1}'), ("t", 90_000, '{"y":1}')]).write.parquet(f"{scratch}/b")
    got = schema_drift(spark.read.parquet(f"{scratch}/b"), SHAPE)
    unknown = rows_of(got.where("verdict = 'unknown'"), "topic", "day", "path")
    assert unknown == [("t", "2023-11-14", "$.x"), ("t", "2023-11-15", "$.y")]
    assert f"{scratch}/b" not in plan_of(got)  # the messages were read before, and once
    assert [p for p, _, _ in expected_paths(spark.createDataFrame([], "a ARRAY<ARRAY<INT>>").schema)] == ["$", "$.a", "$.a[]", "$.a[][]"]


def test_drift_of_nothing(envelope_of, scratch):
    assert schema_drift(envelope_of([]), SHAPE).count() == 0


# ------------------------------------------------------------------ stages as a graph


def checks_of(spark, rows):
    return spark.createDataFrame([(s, c, ok, "") for s, c, ok in rows], health.RESULT)


def test_a_failure_blocks_only_what_needs_it(spark):
    needs = {"a": (), "b": ("a",), "c": ("b",), "d": ("a",), "e": ("c", "d")}
    rows = [(s, f, not (f == "x" and s == "b")) for s in "abcde" for f in "xy"]
    got = stage_graph(checks_of(spark, rows), ["x", "y"], needs)
    assert rows_of(got, "feed", "stage", "status", "blocked_by") == [
        ("x", "a", "OK", None), ("x", "b", "FAIL", None), ("x", "c", "BLOCKED", "b"), ("x", "d", "OK", None),
        ("x", "e", "BLOCKED", "b"), *(("y", s, "OK", None) for s in "abcde")]


def test_no_rows_null_results_and_two_broken_needs(spark):
    needs = {"a": (), "b": (), "c": ("a", "b")}
    got = stage_graph(checks_of(spark, [("a", "x", None), ("c", "x", False), ("c", "x", True)]), ["x"], needs)
    assert rows_of(got, "stage", "status", "n_failed", "blocked_by") == [
        ("a", "FAIL", 1, None), ("b", "FAIL", 0, None), ("c", "BLOCKED", 1, "a,b")]


def test_a_line_of_stages_is_a_graph_too(spark):
    rows = [("producers", "x", True), ("kafka", "x", False), ("bronze", "x", True), ("silver", "x", True)]
    line = {r["stage"]: r["status"] for r in health.stage_report(checks_of(spark, rows)).collect()}
    assert {r["stage"]: r["status"] for r in stage_graph(checks_of(spark, rows), ["x"]).collect()} == line


def test_a_cycle_raises(spark):
    with pytest.raises(ValueError, match="need each other"):
        stage_graph(checks_of(spark, []), ["x"], {"a": ("c",), "b": ("a",), "c": ("b",)})
    assert in_order({"b": ("a",), "a": ()}) == ["a", "b"]


def test_needs_through_others(spark):
    needs = {"a": (), "b": ("a",), "c": ("a", "b"), "d": ("c",)}
    got = rows_of(all_needs(checks_of(spark, []), needs), "stage", "needed")
    assert got == [("b", "a"), ("c", "a"), ("c", "b"), ("d", "a"), ("d", "b"), ("d", "c")]


# ------------------------------------------------------------------ silences


def plain_silences(times, limit, as_of):
    times = sorted(t for t in times if t <= as_of)
    pairs = list(zip(times, [*times[1:], as_of], strict=True))
    return [(a, b) for a, b in pairs if b - a >= limit]


@pytest.mark.parametrize("limit", [10, 60])
def test_silences_as_in_plain_python(envelope_of, limit):
    draw = random.Random(limit)
    times = [draw.choice([draw.randrange(2_000), draw.randrange(200), 1_000, 1_000 + limit]) for _ in range(120)]
    rows = [("a", t, "") for t in times] + [("b", 5, ""), ("b", 2_500, ""), ("b", None, ""), ("c", 9_000, "")]
    got = outages.feed_outages(envelope_of(rows), limit, as_of=F.lit(at(2_100)), expected=["a", "b", "c", "d"])
    found = rows_of(got, "topic", "silent_from", "silent_to", "seconds")
    want = [("a", at(x), at(y), float(y - x)) for x, y in plain_silences(times, limit, 2_100)]
    want += [("b", at(5), at(2_100), 2_095.0), ("c", None, at(2_100), None), ("d", None, at(2_100), None)]
    plain = [(t, a and a.timestamp(), b.timestamp(), s) for t, a, b, s in found]
    assert sorted(plain, key=repr) == sorted(((t, a and a.timestamp(), b.timestamp(), s) for t, a, b, s in want), key=repr)


def test_a_busy_feed_is_reduced_before_the_shuffle(spark, scratch):
    log = spark.range(30_000).selectExpr("'hot' AS topic", "timestamp_seconds(id) AS timestamp").repartition(6)
    spans = outages.active_spans(log, 3_600)
    assert spans.count() == 9
    assert plan_of(spans).count("partial_min") >= 1


def test_sessions_of_a_stream_give_the_same_silences(spark, envelope_of, scratch):
    draw = random.Random(3)
    rows = [(f, draw.randrange(5_000), "") for f in "ab" for _ in range(60)] + [("c", 1, "")]
    draw.shuffle(rows)
    for k in range(0, len(rows), 40):
        envelope_of(rows[k : k + 40]).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        wait(outages.stream_sessions(stream, f"{scratch}/out", f"{scratch}/cp", 60, None))
    sessions = outages.read_sessions(spark, f"{scratch}/out")
    assert sessions.agg(F.sum("n")).first()[0] == len(rows)
    columns = ("topic", "silent_from", "silent_to", "seconds")
    end, names = F.lit(at(6_000)), ["a", "b", "c", "d"]
    batch = outages.feed_outages(envelope_of(rows), 60, as_of=end, expected=names)
    assert rows_of(outages.silences(sessions, 60, as_of=end, expected=names), *columns) == rows_of(batch, *columns)


def test_silences_of_the_last_hours_as_checks(spark, envelope_of, scratch):
    rows = [("a", s, "") for s in range(0, 3_600, 50)] + [("b", 0, ""), ("b", 3_500, ""), ("c", -9_000, "")]
    envelope_of(rows).write.parquet(f"{scratch}/log")
    log = spark.read.parquet(f"{scratch}/log")
    checks = outages.outage_checks(log, ["a", "b", "c"], instant(at(3_600)), 3_600, 600)
    found = {r["check"]: (r["ok"], r["detail"]) for r in checks.collect()}
    assert found["a"] == (True, "never silent for 600 s")
    assert found["b"] == (False, "1 silences, the longest of 3500 s")
    assert found["c"] == (False, "no records")
    assert "GreaterThanOrEqual" in plan_of(checks).split("PushedFilters")[1].split("ReadSchema")[0]


# ------------------------------------------------------------------ freshness that is bounded


def test_silent_feeds_are_looked_for_up_to_a_limit(spark, envelope_of, scratch, monkeypatch):
    log = envelope_of([("a", 100, ""), ("b", -5_000, ""), ("c", -500_000, ""), ("e", 9_000, ""), ("e", 50, "")])
    log.write.parquet(f"{scratch}/log")
    log = spark.read.parquet(f"{scratch}/log")
    read = []
    real = health.latest_by
    monkeypatch.setattr(health, "latest_by", lambda df, *rest: read.append(df.count()) or real(df, *rest))
    latest = health.bounded_latest(log, "topic", "timestamp", list("abcde"), F.lit(at(200)), 1_000, look_back_seconds=100_000)
    found = {r["topic"]: r["latest"].timestamp() for r in latest.collect()}
    # A row of the future keeps nothing fresh, and one beyond the limit is not looked for.
    assert found == {"a": at(100).timestamp(), "b": at(-5_000).timestamp(), "e": at(50).timestamp()}
    assert read == [2, 1, 0, 0]  # no step reads what the ones before it did


def test_rows_of_the_future_are_a_finding(envelope_of):
    log = envelope_of([("a", 10, ""), ("a", 99_999, ""), ("a", 70_000, ""), ("b", 11, "")])
    rows = {r["check"]: r for r in health.future_checks(log, "topic", "timestamp", ["a", "b", "c"], F.lit(at(11)), "bronze").collect()}
    assert [rows[t]["ok"] for t in "abc"] == [False, True, True]
    assert rows["a"]["detail"].startswith("2 rows are later than now, up to 2023-11-16T01:59:59")
    assert health.future_checks(log, "topic", "timestamp", ["a"], F.lit(at(11)), "bronze", 100_000).first()["ok"]


def test_one_stage_starts_no_job_of_another(spark):
    def fails():
        raise AssertionError("computed")

    fine = checks_of(spark, [("b", "x", True)])
    assert health.run_stages({"a": fails, "b": lambda: fine}, "b").collect() == fine.collect()
    with pytest.raises(ValueError, match="no stage"):
        health.run_stages({"a": fails}, "z")


# ------------------------------------------------------------------ key sketches


def keys_table(spark, numbers):
    return spark.createDataFrame([(f"key-{n}", n % 3) for n in numbers], "key STRING, part BIGINT")


def test_no_key_is_lost_and_most_parts_are_left_out(spark, scratch):
    draw = random.Random(1)
    parts = [[draw.randrange(10**9) for _ in range(draw.choice([0, 1, 50, 3_000]))] for _ in range(12)]
    for batch, numbers in enumerate(parts):
        write_sketch(keys_table(spark, numbers), ["key", "part"], f"{scratch}/s", "r", batch)
    assert {level_for(1), level_for(10**6)} == {4, 10}
    for hit in ([], [3], [3, 7, 9]):
        wanted = [draw.randrange(10**9, 2 * 10**9) for _ in range(200)] + [n for b in hit for n in parts[b][:1]]
        left = parts_without(spark, f"{scratch}/s", keys_table(spark, wanted), ["key", "part"])
        held = {b for b, numbers in enumerate(parts) if set(numbers) & set(wanted)}
        assert not held & {b for _, b in left}
        assert len(left) >= 11 - len(hit) - sum(not numbers for numbers in parts)
    assert parts_without(spark, f"{scratch}/none", keys_table(spark, [1]), ["key", "part"]) == []


def test_a_null_in_a_key_and_all_bits_of_a_block(spark, scratch):
    rows = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "key STRING, part BIGINT")
    many = spark.range(200_000).selectExpr("CAST(id AS STRING) AS key", "id AS part")
    write_sketch(rows, ["key", "part"], f"{scratch}/s", "r", 0)
    write_sketch(many, ["key", "part"], f"{scratch}/s", "r", 1)
    assert parts_without(spark, f"{scratch}/s", rows, ["key", "part"]) in ([("r", 1)], [])
    assert ("r", 1) not in parts_without(spark, f"{scratch}/s", many.sample(0.0005, 3), ["key", "part"])
    fresh = spark.range(200_000, 200_400).selectExpr("CAST(id AS STRING) AS key", "id AS part")
    assert set(parts_without(spark, f"{scratch}/s", fresh, ["key", "part"])) == {("r", 0), ("r", 1)}


def test_a_stream_reads_only_parts_that_may_hold_its_keys(spark, envelope_of, scratch, monkeypatch):
    import strandline.streaming.sinks as sinks

    left_out = []
    real = sinks.parts_without
    monkeypatch.setattr(sinks, "parts_without", lambda *a: left_out.append(real(*a)) or left_out[-1])
    schema = "topic STRING, timestamp TIMESTAMP, json_str STRING"
    for n in range(5):
        rows = [("t", n * 1_000 + k, f"key-{n}-{k}") for k in range(30)]
        if n == 4:
            rows += [("t", 90_000, "key-1-3"), ("t", 90_001, "key-4-3")]
        envelope_of(rows).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        source = spark.readStream.schema(schema).parquet(f"{scratch}/in")
        wait(stream_parts(source, f"{scratch}/out", f"{scratch}/cp", None, new_keys=["json_str"], sketch=f"{scratch}/sketch"))
    texts = [r["json_str"] for r in read_parts(spark, f"{scratch}/out", schema).collect()]
    assert sorted(texts) == sorted(f"key-{n}-{k}" for n in range(5) for k in range(30))
    assert [len(parts) for parts in left_out] == [0, 1, 2, 3, 3]  # only the part of key-1-3 is read by the last batch
    # A sketch that is lost costs reading, and no row.
    import shutil

    for path in __import__("glob").glob(f"{scratch}/sketch/run=*/batch=1"):
        shutil.rmtree(path)
    envelope_of([("t", 95_000, "key-1-5"), ("t", 95_000, "new")]).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    source = spark.readStream.schema(schema).parquet(f"{scratch}/in")
    wait(stream_parts(source, f"{scratch}/out", f"{scratch}/cp", None, new_keys=["json_str"], sketch=f"{scratch}/sketch"))
    assert read_parts(spark, f"{scratch}/out", schema).count() == 151


def test_a_sketch_needs_keys_without_a_time(spark, envelope_of, scratch):
    envelope_of([("t", 0, "")]).write.parquet(f"{scratch}/in")
    source = spark.readStream.schema(ENVELOPE).parquet(f"{scratch}/in")
    for keys in ((), ("topic", "timestamp")):
        with pytest.raises(ValueError, match="sketch"):
            stream_parts(source, f"{scratch}/o", f"{scratch}/c", None, new_keys=keys, sketch=f"{scratch}/s")


# ------------------------------------------------------------------ salted dedup


def test_copies_of_a_hot_key_are_dealt_to_many_tasks(spark, envelope_of, scratch):
    rows = [("hot", 100, "x")] * 400 + [("cold", 100 + k, str(k)) for k in range(20)]
    for k in range(4):
        envelope_of(rows[k::4]).repartition(4).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema(ENVELOPE).parquet(f"{scratch}/in")
    unique = first_within_watermark_salted(stream, ["topic", "json_str"], "1 hour")
    wait(stream_parts(unique, f"{scratch}/out", f"{scratch}/cp", None))
    assert read_parts(spark, f"{scratch}/out", ENVELOPE).count() == 21
    first = spark.read.format("statestore").option("operatorId", 0).load(f"{scratch}/cp")
    second = spark.read.format("statestore").option("operatorId", 1).load(f"{scratch}/cp")
    places = {}
    for name, state in (("first", first), ("second", second)):
        places[name] = state.where("key.topic = 'hot'").count()
    assert 1 < max(places.values())  # the copies met in several places first ...
    assert min(places.values()) == 1  # ... and in one at the end


def test_late_rows_are_counted(spark, envelope_of, scratch):
    # What is late is judged by the watermark that the micro-batch before had.
    batches = [[("t", 100_000, "new")], [("t", 100_001, "next")], [("t", 1, "late"), ("t", 2, "late"), ("t", 99_990, "in time")]]
    for number, rows in enumerate(batches):
        envelope_of(rows).coalesce(1).write.parquet(f"{scratch}/in/{number}")
    stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in/*")
    unique = first_within_watermark_salted(stream, ["json_str"], "1 hour")
    with ProgressTable(spark, f"{scratch}/progress"):
        wait(stream_parts(unique, f"{scratch}/out", f"{scratch}/cp", None, name="late"))
    assert rows_of(read_parts(spark, f"{scratch}/out", ENVELOPE), "json_str") == [("in time",), ("new",), ("next",)]
    assert consumer_lag(read_progress(spark, f"{scratch}/progress")).first()["late_rows"] == 2


# ------------------------------------------------------------------ fan-out without a sink log


def test_a_batch_of_a_fan_out_that_runs_again_gives_no_copies(spark, envelope_of, scratch):
    import glob
    import os

    from strandline.plans import fan_out_one_stream, read_fan_out

    rows = [(t, s, f"{t}{s}") for t in ("a", "b", "c d") for s in (0, 90_000)] + [("a", None, "no time")]
    envelope_of(rows).write.parquet(f"{scratch}/in")
    source = lambda: spark.readStream.schema(ENVELOPE).parquet(f"{scratch}/in")
    wait(fan_out_one_stream(source(), f"{scratch}/out", f"{scratch}/cp", None))
    for commit in glob.glob(f"{scratch}/cp/commits/*") + glob.glob(f"{scratch}/cp/commits/.*.crc"):
        os.remove(commit)  # written, but the driver was lost before it said so
    wait(fan_out_one_stream(source(), f"{scratch}/out", f"{scratch}/cp", None))
    assert rows_of(read_fan_out(spark, f"{scratch}/out"), "topic", "json_str") == sorted(((t, j) for t, _, j in rows), key=repr)
    assert read_fan_out(spark, f"{scratch}/out", values=["a", "b"], days=["2023-11-14"]).count() == 2
