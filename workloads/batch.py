"""Batch queries: parse, dedup, handoff, publishing, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import AIR_QUALITY, CONDITIONS, Feed
from strandline.functions import utf8_text
from strandline.operators import after, envelope, keep_new, keep_one, parse, screen, to_silver, union_parts, up_to
from strandline.operators.parse import flatten
from strandline.plans.backfill import backfill, silver_rows
from strandline.session import scratch_dir
from strandline.sinks import (
    batch_overwrite,
    ensure_namespace,
    publish_json,
    register_external,
    register_union,
    run_sql,
)
from strandline.sources import glob_of, read_landed_json
from workloads import sql
from workloads.messages import (
    air_quality_bronze,
    conditions_bronze,
    cut_short,
    events,
    naive,
    plain_texts,
    props_messages,
    replayed,
    table,
)
from workloads.registry import query

# A key that names one message: its place in the log (H2).
LOG_KEY = ["topic", "partition", "offset"]

PROPS = Feed.of("props", "k INT", [("k", "field", "k")])

TALK = Feed.of(
    "talk",
    "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    [(name, "field", name) for name in ("conv_id", "turn", "role", "text")],
)


# ------------------------------------------------------------------ projections and parsing


@query(sql.select(sql.ENVELOPE))
def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 F1"""
    return naive(envelope(props_messages(events(spark, sf_dir))))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 P2 P5"""
    bronze = envelope(props_messages(events(spark, sf_dir)), keep=["offset"])
    return flatten(parse(bronze, PROPS), PROPS, F.col("offset").alias("event_id")).drop("timestamp")


@query(sql.select(sql.CONDITIONS))
def silver_shape_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 P5 P6 P7 P9 F4 F7"""
    return naive(to_silver(conditions_bronze(events(spark, sf_dir)), CONDITIONS))


@query(sql.select(sql.AIR_QUALITY))
def silver_shape_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 P8 F4"""
    return naive(to_silver(air_quality_bronze(events(spark, sf_dir)), AIR_QUALITY))


@query(sql.select(sql.CONDITIONS, ["timestamp", "rain_1h"]))
def optional_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object that most messages lack"""
    silver = to_silver(conditions_bronze(events(spark, sf_dir)), CONDITIONS)
    return naive(silver.select("timestamp", "rain_1h"))


@query(
    f"SELECT ts AS \"timestamp\", "
    f"CASE WHEN event_type <> 'view' THEN {sql.CONDITIONS['condition_id']} END AS condition_id, "
    f"CASE WHEN event_type <> 'view' THEN event_type END AS condition_main, "
    f"{sql.CONDITIONS['temp']} AS temp, {sql.CONDITIONS['city_name']} AS city_name FROM events"
)
def empty_array_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first element of an empty array is NULL, the rest of the message stays"""
    bronze = conditions_bronze(events(spark, sf_dir), empty_array_for="view")
    silver = to_silver(bronze, CONDITIONS)
    return naive(silver.select("timestamp", "condition_id", "condition_main", "temp", "city_name"))


@query(f"SELECT {sql.columns(sql.CONDITIONS, null_if="event_type = 'click'")} FROM events")
def malformed_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 H5: broken messages stay, with NULLs"""
    bronze = cut_short(conditions_bronze(events(spark, sf_dir)), "click")
    return naive(to_silver(bronze, CONDITIONS))


@query(
    """
    SELECT event_type AS topic,
           CASE event_type WHEN 'click' THEN 'malformed' WHEN 'signup' THEN 'partial' ELSE 'good' END AS verdict,
           count(*) AS n
    FROM events GROUP BY ALL
    UNION ALL SELECT 'pages', 'malformed', count(*) FROM pages
    UNION ALL SELECT 'documents', 'malformed', count(*) FROM documents
    """
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5 H6: messages by verdict; one topic is cut short, one has a field of the wrong type, two are no JSON"""
    readings = cut_short(conditions_bronze(events(spark, sf_dir), text_code_for="signup"), "click")
    judged = screen(readings.unionByName(plain_texts(spark, sf_dir)), CONDITIONS)
    return judged.groupBy("topic", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT 'pages' AS topic, 'malformed' AS verdict, count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS raw_chars
    FROM pages
    UNION ALL
    SELECT 'documents', 'malformed', count(*), CAST(sum(length(text)) AS BIGINT) FROM documents
    """
)
def quarantine_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: what can not be parsed is kept whole"""
    judged = screen(plain_texts(spark, sf_dir), CONDITIONS)
    return judged.groupBy("topic", "verdict").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("raw").cast("bigint")).alias("raw_chars")
    )


@query(
    f"""
    SELECT event_type AS topic,
           CASE WHEN date_trunc('second', ts) > {sql.CUTOFF_SQL} THEN 'out_of_range' ELSE 'good' END AS verdict,
           count(*) AS n
    FROM events GROUP BY ALL
    """
)
def quarantine_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation times beyond a limit"""
    judged = screen(conditions_bronze(events(spark, sf_dir)), CONDITIONS, latest=sql.CUTOFF)
    return judged.groupBy("topic", "verdict").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id, turn, text || chr(65533) || '.' AS text FROM conversations")
def decode_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a byte that is not UTF-8 becomes the replacement character"""
    talk = table(spark, sf_dir, "conversations")
    broken = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")), F.encode(F.lit("."), "UTF-8"))
    return talk.select("conv_id", "turn", utf8_text(broken, replace_invalid=True).alias("text"))


# ------------------------------------------------------------------ cutoff and dedup


@query(sql.select(sql.ENVELOPE, where=f"ts > {sql.CUTOFF_SQL}"))
def cutoff_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 F5"""
    return naive(after(envelope(props_messages(events(spark, sf_dir))), sql.CUTOFF))


@query(sql.one_per(sql.ENVELOPE, ["timestamp"]))
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 H3: one row per time out of a topic that was read three times"""
    bronze = envelope(props_messages(events(spark, sf_dir)))
    return naive(keep_one(replayed(bronze), ["timestamp"]))


@query(sql.one_per(sql.CONDITIONS, ["timestamp"]))
def dedup_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill's rows, parsed before the dedup"""
    return naive(silver_rows(replayed(conditions_bronze(events(spark, sf_dir))), CONDITIONS))


@query(sql.select(sql.AIR_QUALITY))
def dedup_silver_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 H2: the backfill's rows, deduplicated by place in the log before the parse"""
    bronze = air_quality_bronze(events(spark, sf_dir), keep=["partition", "offset"])
    return naive(silver_rows(replayed(bronze), AIR_QUALITY, LOG_KEY, raw_dedup=True))


@query(sql.one_per(sql.CONDITIONS, ["timestamp"], ["timestamp", "event_time", "temp", "city_id"]))
def dedup_prefers_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: a broken copy does not displace the good one"""
    bronze = conditions_bronze(events(spark, sf_dir))
    silver = silver_rows(cut_short(bronze, "click").unionByName(bronze), CONDITIONS)
    return naive(silver.select("timestamp", "event_time", "temp", "city_id"))


_LINEITEM_REST = (
    "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


@query(
    f"SELECT l_orderkey, {_LINEITEM_REST} FROM lineitem "
    f"QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINEITEM_REST}) = 1"
)
def dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: a key with natural duplicates and ties"""
    return keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber"])


@query(
    """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_returnflag, l_linestatus
        ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber,
                 l_quantity, l_extendedprice, l_discount, l_tax) = 1
    """
)
def dedup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: a handful of keys that hold all rows"""
    return keep_one(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_shipdate"])


@query(
    """
    SELECT * FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderpriority DESC) = 1
    """
)
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the latest row per key"""
    return keep_one(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"], keep="last")


@query(
    """
    SELECT event_type AS topic, count(*) * 3 AS rows_in, count(DISTINCT ts) AS rows_out
    FROM events GROUP BY event_type
    """
)
def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: rows before and after, in one pass"""
    bronze = replayed(envelope(props_messages(events(spark, sf_dir))))
    per_key = bronze.groupBy("topic", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("topic").agg(F.sum("n").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"))


# ------------------------------------------------------------------ handoff


def _labelled_parts(first: DataFrame, second: DataFrame) -> DataFrame:
    return union_parts(
        first.select(F.lit("backfill").alias("part"), "*"), second.select(F.lit("stream").alias("part"), "*")
    )


@query(
    f"SELECT CASE WHEN ts <= {sql.CUTOFF_SQL} THEN 'backfill' ELSE 'stream' END AS part, "
    f"{sql.columns(sql.CONDITIONS)} FROM events"
)
def handoff_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of silver, split by time"""
    bronze = conditions_bronze(events(spark, sf_dir), keep=["partition", "offset"])
    first = silver_rows(replayed(up_to(bronze, sql.CUTOFF)), CONDITIONS, LOG_KEY)
    second = to_silver(after(bronze, sql.CUTOFF), CONDITIONS)
    return naive(_labelled_parts(first, second))


@query(
    f"""
    SELECT CASE WHEN ts <= {sql.CUTOFF_SQL} AND event_type <> 'error' THEN 'backfill' ELSE 'stream' END AS part,
           event_type AS topic, ts AS "timestamp", props AS json_str, event_id AS "offset"
    FROM events
    """
)
def handoff_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: one topic reached bronze late; the stream reads everything and adds what is not loaded"""
    bronze = envelope(props_messages(events(spark, sf_dir)), keep=["offset"])
    first = up_to(bronze, sql.CUTOFF).filter(F.col("topic") != "error")
    second = keep_new(replayed(bronze), first, ["topic", "offset"])
    return naive(_labelled_parts(first, second))


@query(
    """
    SELECT feed, count(DISTINCT ts) AS rows_written, max(ts) AS cutoff
    FROM events, (VALUES ('air_quality'), ('conditions')) AS feeds(feed)
    GROUP BY feed
    """
)
def backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and cutoff that the write itself reports"""
    rows = events(spark, sf_dir)
    base = scratch_dir(spark, "backfill")
    reports = {
        "conditions": backfill(conditions_bronze(rows), CONDITIONS, f"{base}/conditions"),
        "air_quality": backfill(air_quality_bronze(rows), AIR_QUALITY, f"{base}/air_quality"),
    }
    # One row per feed.
    report = spark.createDataFrame(
        [(feed, r.rows, r.cutoff) for feed, r in reports.items()], "feed STRING, rows_written BIGINT, cutoff STRING"
    )
    return naive(report.withColumn("cutoff", F.to_timestamp("cutoff")))


# ------------------------------------------------------------------ publishing and landed text

_EVENT_JSON = (
    "'{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"event_type\":\"' || event_type || "
    "'\",\"props\":' || CAST(to_json(props) AS VARCHAR) || '}'"
)


@query(f"SELECT event_type AS topic, CAST(event_id AS VARCHAR) AS key, {_EVENT_JSON} AS value FROM events")
def publish_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 K4"""
    rows = events(spark, sf_dir)
    sent = publish_json(rows, F.col("event_type"), ["event_id", "user_id", "event_type", "props"], key="event_id")
    return sent.select("topic", utf8_text(F.col("key")).alias("key"), utf8_text(F.col("value")).alias("value"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, line breaks and accents come back as they were"""
    sent = publish_json(table(spark, sf_dir, "conversations"), "talk")
    stamped = sent.withColumn("timestamp", F.lit("2024-01-01T00:00:00Z").cast("timestamp"))
    return to_silver(envelope(stamped), TALK).drop("timestamp")


@query(f"SELECT 'landed' AS topic, {_EVENT_JSON} AS json_str FROM events")
def landed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines that lie in files"""
    lines = publish_json(events(spark, sf_dir), "landed", ["event_id", "user_id", "event_type", "props"])
    path = scratch_dir(spark, "landed")
    lines.select(utf8_text(F.col("value")).alias("value")).write.mode("overwrite").text(path)
    return read_landed_json(spark, glob_of(path, suffix=".txt"), "landed").select("topic", "json_str")


# ------------------------------------------------------------------ tables and SQL


# Namespaces that this process has made. Those of earlier runs go when a new one is made; their files stay.
_NAMESPACES: list[str] = []


def new_namespace(spark: SparkSession, base: str) -> str:
    """A namespace of this run's own, below ``base``."""
    while _NAMESPACES:
        spark.sql("DROP DATABASE IF EXISTS IDENTIFIER(:name) CASCADE", args={"name": _NAMESPACES.pop()})
    name = "strandline_" + base.rsplit("-", 1)[-1].lower()
    ensure_namespace(spark, name, f"{base}/namespace")
    _NAMESPACES.append(name)
    return name


def _silver_tables(spark: SparkSession, sf_dir: str, *feeds: str) -> str:
    """Silver tables in files and registered, in a namespace of this run's own."""
    rows = events(spark, sf_dir)
    base = scratch_dir(spark, "silver")
    name = new_namespace(spark, base)
    bronze = {"conditions": (conditions_bronze, CONDITIONS), "air_quality": (air_quality_bronze, AIR_QUALITY)}
    for feed in feeds:
        made, contract = bronze[feed]
        backfill(made(rows), contract, f"{base}/{feed}")
        register_external(spark, f"{name}.{feed}", f"{base}/{feed}")
    return name


@query(f"{sql.one_per(sql.CONDITIONS, ['timestamp'])} ORDER BY \"timestamp\" LIMIT 10")
def external_table_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 K6 Q1 L1"""
    name = _silver_tables(spark, sf_dir, "conditions")
    return naive(run_sql(spark, f"SELECT * FROM {name}.conditions ORDER BY timestamp LIMIT 10"))


@query(
    f"""
    WITH conditions AS ({sql.one_per(sql.CONDITIONS, ['timestamp'])}),
         air AS ({sql.one_per(sql.AIR_QUALITY, ['timestamp'])})
    SELECT condition_main, count(*) AS n, min(temp) AS lowest, max(temp) AS highest, max(aqi) AS worst_aqi
    FROM conditions JOIN air USING ("timestamp") WHERE temp > 280e0 GROUP BY condition_main
    """
)
def external_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: free SQL over both tables"""
    name = _silver_tables(spark, sf_dir, "conditions", "air_quality")
    return run_sql(
        spark,
        f"""
        SELECT condition_main, count(*) AS n, min(temp) AS lowest, max(temp) AS highest, max(aqi) AS worst_aqi
        FROM {name}.conditions JOIN {name}.air_quality USING (timestamp)
        WHERE temp > :above GROUP BY condition_main
        """,
        above=280.0,
    )


@query(
    """
    SELECT event_type AS condition_main, count(*) AS n, min(ts) AS earliest, max(ts) AS latest
    FROM events GROUP BY event_type
    """
)
def external_table_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One view over the two silver halves, each an external table of its own"""
    bronze = conditions_bronze(events(spark, sf_dir), keep=["partition", "offset"])
    base = scratch_dir(spark, "halves")
    name = new_namespace(spark, base)
    backfill(up_to(bronze, sql.CUTOFF), CONDITIONS, f"{base}/first", keys=LOG_KEY, cluster=True)
    batch_overwrite(to_silver(after(bronze, sql.CUTOFF), CONDITIONS), f"{base}/second")
    for half in ("first", "second"):
        register_external(spark, f"{name}.{half}", f"{base}/{half}")
    register_union(spark, f"{name}.conditions", [f"{name}.first", f"{name}.second"])
    return naive(
        run_sql(
            spark,
            "SELECT condition_main, count(*) AS n, min(timestamp) AS earliest, max(timestamp) AS latest "
            f"FROM {name}.conditions GROUP BY condition_main",
        )
    )
