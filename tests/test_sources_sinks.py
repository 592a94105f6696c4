"""Sources, batch sinks, publishing and tables."""

import json
import os
from types import SimpleNamespace

import pytest
from conftest import at, plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strandline import CONDITIONS, ENVELOPE
from strandline.operators import screen
from strandline.plans import backfill, silver_view
from strandline.plans.backfill import silver_rows
from strandline.session import scratch_dir
from strandline.sinks import (
    batch_overwrite,
    ensure_namespace,
    publish_json,
    register_external,
    register_union,
    register_view,
    run_sql,
    send_to_topic,
)
from strandline.sources import (
    end_offsets,
    file_inventory,
    glob_of,
    read_bronze,
    read_landed_json,
    read_topic,
    reported_offsets,
    topic_options,
)


def files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_topic_options_s1_s2_h19():
    assert topic_options("a", "h:1") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a",
        "startingOffsets": "earliest",
    }
    full = topic_options(["a", "b"], "h:1", "latest", fail_on_data_loss=False, max_offsets_per_trigger=5, min_partitions=9)
    assert full["subscribe"] == "a,b" and full["failOnDataLoss"] == "false"
    assert full["maxOffsetsPerTrigger"] == "5" and full["minPartitions"] == "9" and full["startingOffsets"] == "latest"


def test_missing_connector_is_an_error_not_an_empty_stream_s1(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_topic(spark, "a", "h:1")


def test_end_offsets_s8(spark):
    log = spark.createDataFrame(
        [("a", 0, 4), ("a", 0, 2), ("a", 1, 0), ("b", 0, 9)], "topic STRING, partition INT, offset BIGINT"
    )
    assert {tuple(r) for r in end_offsets(log).collect()} == {("a", 0, 5), ("a", 1, 1), ("b", 0, 10)}


def test_reported_offsets_s8(spark):
    progress = json.dumps({"sources": [{"latestOffset": {"a": {"0": 5, "1": 1}, "b": {"0": 10}}}]})
    assert {tuple(r) for r in reported_offsets(spark, progress).collect()} == {("a", 0, 5), ("a", 1, 1), ("b", 0, 10)}


def test_good_rows_and_side_table_in_one_write_h5(spark, envelope_of, tmp_path):
    bronze = envelope_of([("t", 1, '{"name":"a"}'), ("t", 2, "junk"), ("t", 3, '{"name":"b","cod":"x"}')])
    report = batch_overwrite(screen(bronze, CONDITIONS), f"{tmp_path}/q", partition_by="verdict")
    assert report.rows == 3
    read = spark.read.parquet(f"{tmp_path}/q")
    assert {(r["verdict"], r["city_name"], r["raw"]) for r in read.collect()} == {
        ("good", "a", None), ("malformed", None, "junk"), ("partial", "b", '{"name":"b","cod":"x"}'),
    }


def test_glob_s4_h17(spark, envelope_of, tmp_path):
    base = f"{tmp_path}/b"
    envelope_of([("x", 1, "1"), ("y", 2, "2")]).write.partitionBy("topic").parquet(base)
    with pytest.raises(AnalysisException):
        read_bronze(spark, base)
    assert read_bronze(spark, base, depth=1).filter("topic IS NULL").count() == 2
    assert {r["topic"] for r in read_bronze(spark, base, depth=1, base_path=base).collect()} == {"x", "y"}


def test_missing_location_h18(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_bronze(spark, f"{tmp_path}/none")
    empty = read_bronze(spark, f"{tmp_path}/none", missing_ok=True)
    assert empty.count() == 0 and empty.columns == ["topic", "timestamp", "json_str"]


def test_landed_json_s10(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n{"a":2}\n', encoding="utf-8")
    rows = read_landed_json(spark, str(tmp_path), "t").collect()
    assert [r["json_str"] for r in rows] == ['{"a":1}', '{"a":2}']
    assert all(r["topic"] == "t" and r["timestamp"] is not None for r in rows)


def test_inventory_s7_p11(spark, envelope_of, tmp_path):
    envelope_of([("t", 1, "1")]).coalesce(1).write.parquet(f"{tmp_path}/a/deep")
    (tmp_path / "a" / "note.txt").write_text("x")
    df = file_inventory(spark, [("a", f"{tmp_path}/a"), ("none", f"{tmp_path}/none")])
    (row,) = df.collect()
    assert row["stage"] == "a" and row["path"].endswith(".parquet") and row["length"] > 0
    assert "content" not in plan_of(df).split("ReadSchema")[1]
    assert file_inventory(spark, [("a", f"{tmp_path}/a")], modified_after="2999-01-01T00:00:00").count() == 0


def test_overwrite_reports_what_it_wrote_k3_k7_h11(envelope_of, tmp_path):
    df = envelope_of([("t", s, str(s)) for s in range(50)]).repartition(8)
    report = batch_overwrite(df, f"{tmp_path}/o", max_files=2)
    assert report.rows == 50 and report.cutoff == at(49).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
    assert len(files(f"{tmp_path}/o")) <= 2
    report = batch_overwrite(df.filter("false"), f"{tmp_path}/o")
    assert (report.rows, report.cutoff) == (0, None)
    assert df.sparkSession.read.parquet(f"{tmp_path}/o").count() == 0


def test_max_files_does_not_squeeze_the_dedup_h15(spark, envelope_of, tmp_path):
    plan = plan_of(silver_rows(envelope_of([("t", 1, "{}")]), CONDITIONS).repartition(2))
    assert "Coalesce" not in plan and plan.count("Exchange") == 2


def test_clustered_files_have_separate_ranges(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.lit("t").alias("topic"), F.timestamp_seconds(F.col("id") * 7919 % 1_000_003).alias("timestamp"), F.lit("{}").alias("json_str")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = batch_overwrite(rows, f"{tmp_path}/c", cluster_by="timestamp")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert report.rows == 40_000
    spans = (
        spark.read.parquet(f"{tmp_path}/c")
        .groupBy(F.input_file_name())
        .agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(spans) > 1
    assert all(a["high"] <= b["low"] for a, b in zip(spans, spans[1:]))
    with pytest.raises(ValueError):
        batch_overwrite(rows, f"{tmp_path}/d", max_files=2, cluster_by="timestamp")


def test_clustering_spreads_a_hot_time_over_files(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 500_000).otherwise(F.col("id") * 25)).alias("timestamp"), "id",
        F.create_map(F.lit("a"), F.col("id")).alias("m"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        batch_overwrite(rows, f"{tmp_path}/c", cluster_by="timestamp")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = spark.read.parquet(f"{tmp_path}/c").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == 40_000
    assert max(r["count"] for r in sizes) < 13_000  # a hot third lies in more than one file
    hot = spark.read.parquet(f"{tmp_path}/c").filter(F.unix_seconds("timestamp") == 500_000)
    assert hot.select(F.input_file_name()).distinct().count() > 1


def test_backfill_t5(spark, envelope_of, tmp_path):
    bronze = envelope_of([("t", 1, '{"name":"a"}'), ("t", 1, '{"name":"a"}'), ("t", 5, "junk"), ("t", None, "{}"), ("t", None, "{}")])
    for cluster in (False, True):
        report = backfill(bronze, CONDITIONS, f"{tmp_path}/s", cluster=cluster)
        assert report.rows == 3
        assert report.cutoff == at(5).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
    view = silver_view(spark, CONDITIONS, f"{tmp_path}/s", f"{tmp_path}/none", missing_ok=True)
    assert view.count() == 3 and len(view.columns) == 30


def test_publish_k4_f3(spark):
    df = spark.createDataFrame([(1, 'say "hi"\n', None)], "id INT, text STRING, gone STRING")
    (row,) = publish_json(df, "t", key="id").collect()
    assert row["topic"] == "t" and bytes(row["key"]) == b"1"
    assert json.loads(bytes(row["value"]).decode("utf-8")) == {"id": 1, "text": 'say "hi"\n'}


def test_sending_needs_the_connector_k4(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        send_to_topic(publish_json(spark.range(1), "t"), "h:1")


@pytest.mark.parametrize("cluster", [False, True])
def test_backfill_of_an_empty_table(spark, envelope_of, tmp_path, cluster):
    envelope_of([]).write.parquet(f"{tmp_path}/b")
    report = backfill(read_bronze(spark, f"{tmp_path}/b"), CONDITIONS, f"{tmp_path}/s", cluster=cluster)
    assert (report.rows, report.cutoff) == (0, None)
    assert silver_view(spark, CONDITIONS, f"{tmp_path}/s", f"{tmp_path}/none", missing_ok=True).count() == 0


def test_external_table_is_redefinable_k5_k6_q2(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/one")
    spark.range(5).selectExpr("id", "id * 2 AS twice").write.parquet(f"{tmp_path}/two")
    for _ in range(2):
        ensure_namespace(spark, "it_s", f"{tmp_path}/it's here")
    register_external(spark, "it_s.t", f"{tmp_path}/one")
    assert run_sql(spark, "SELECT * FROM it_s.t WHERE id > :low", low=0).count() == 2
    register_external(spark, "it_s.t", f"{tmp_path}/two")
    assert run_sql(spark, "SELECT max(twice) FROM it_s.t").first()[0] == 8
    assert len(files(f"{tmp_path}/one")) > 0  # the old files are untouched
    assert run_sql(spark, "SELECT * FROM it_s.t ORDER BY id LIMIT 2").count() == 2


def test_table_sees_new_files_after_refresh_q1(spark, tmp_path):
    ensure_namespace(spark, "fresh", f"{tmp_path}/fresh.db")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/a")
    spark.range(10, 12).coalesce(1).write.parquet(f"{tmp_path}/b")
    register_external(spark, "fresh.a", f"{tmp_path}/a")
    register_external(spark, "fresh.b", f"{tmp_path}/b")
    register_union(spark, "fresh.both", ["fresh.a", "fresh.b"])
    assert run_sql(spark, "SELECT count(*) FROM fresh.both").first()[0] == 5
    spark.range(20, 24).coalesce(1).write.mode("append").parquet(f"{tmp_path}/b")
    both = run_sql(spark, "SELECT count(*) FROM fresh.both", refresh=["fresh.a", "fresh.b"])
    assert both.first()[0] == 9
    with pytest.raises(ValueError, match="no table"):
        register_union(spark, "fresh.bad", ["fresh.zz"])


def test_view_q1(spark):
    register_view(spark, "v", spark.range(2))
    assert register_view(spark, "v", spark.range(7)).count() == 7


class Settings:
    """As much of a session as scratch_dir looks at."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: None)


def test_scratch_lies_in_the_shared_folder():
    path = scratch_dir(Settings("spark://host", "hdfs:///shared/"), "x")
    assert path.startswith("hdfs:///shared/strandline/x-")
    assert scratch_dir(Settings("spark://host", "hdfs:///shared/"), "x") != path


@pytest.mark.parametrize("master", ["spark://host", "local[2]"])
def test_scratch_needs_a_shared_folder_whatever_the_master(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Settings(master, None), "x")


def test_sink_log_hides_batch_files_from_a_directory_read_only_h7(spark, envelope_of, tmp_path):
    from strandline.streaming import stream_append

    path = f"{tmp_path}/s"
    envelope_of([("t", 1, "batch"), ("t", 2, "batch")]).write.parquet(path)
    envelope_of([("t", 3, "stream"), ("t", 4, "stream")]).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ENVELOPE).parquet(f"{tmp_path}/in")
    stream_append(stream, path, f"{tmp_path}/cp", every=None).awaitTermination()
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(glob_of(path)).count() == 4
    assert read_bronze(spark, path).count() == 4


def test_a_managed_table_is_not_dropped(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/files")
    spark.range(7).write.saveAsTable("precious")
    try:
        with pytest.raises(ValueError, match="not an external table"):
            register_external(spark, "precious", f"{tmp_path}/files")
        assert spark.table("precious").count() == 7
    finally:
        spark.sql("DROP TABLE precious")


def test_union_of_tables_with_odd_names(spark, tmp_path):
    from strandline.sinks import register_union

    spark.range(2).write.parquet(f"{tmp_path}/a")
    register_external(spark, "`or`", f"{tmp_path}/a")
    try:
        assert register_union(spark, "`select`", ["`or`", "`or`"]).count() == 4
    finally:
        spark.sql("DROP VIEW IF EXISTS `select`")
        spark.sql("DROP TABLE `or`")
