"""The driver's tables as message tables: ``topic, timestamp, value`` with the value in UTF-8 JSON bytes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions import json_bytes
from strandline.operators import envelope

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, ``ts`` as an instant. Read as such, and not cast, so that time filters reach the scan.

    The table is a single row group, so one task would make and parse all messages: its rows are dealt out, by a key that
    is unique, to as many tasks as the session runs at once. Filters pass through that to the scan.
    """
    rows = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return rows.repartitionByRange(spark.sparkContext.defaultParallelism, "event_id")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream. The glob is over the file (or directory) of that name."""
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/event[s].parquet")


# Rows of one file of a landed copy of the table.
FILE_ROWS = 250_000


def files_for(spark: SparkSession, sf_dir: str, batches: int) -> int:
    """Files that each of ``batches`` equal parts of the events lands in: a larger table has more files, not larger ones."""
    return max(1, math.ceil(table(spark, sf_dir, "events").count() / batches / FILE_ROWS))


def landed(rows: DataFrame, path: str, files: int, mode: str = "error") -> None:
    """The rows in files that each hold a range of times."""
    rows.repartitionByRange(files, "timestamp").sortWithinPartitions("timestamp").write.mode(mode).parquet(path)


def _int(value: Column) -> Column:
    return value.cast("int")


def conditions_payload(empty_array_for: str | None = None, text_code_for: str | None = None) -> Column:
    """Shape A over the columns of events, as UTF-8 JSON bytes.

    ``empty_array_for``: messages of that type carry an empty ``weather`` array.
    ``text_code_for``: messages of that type carry ``cod`` as text, which does not fit its type.
    """
    value, user, event, kind = F.col("value"), F.col("user_id"), F.col("event_id"), F.col("event_type")
    epoch = F.unix_seconds("ts")
    weather = F.array(
        F.struct(
            _int(200 + user % 10).alias("id"),
            kind.alias("main"),
            F.concat(kind, F.lit(" reading")).alias("description"),
            F.lit("01d").alias("icon"),
        )
    )
    if empty_array_for:
        weather = F.when(kind == empty_array_for, F.slice(weather, 1, 0)).otherwise(weather)
    code = [F.lit(200).alias("cod")]
    if text_code_for:
        # Two fields of one name; the one that is NULL is left out of the text.
        fits = kind != text_code_for
        code = [F.when(fits, F.lit(200)).alias("cod"), F.when(~fits, F.lit("200")).alias("cod")]
    return json_bytes(
        F.struct((-value).alias("lon"), value.alias("lat")).alias("coord"),
        weather.alias("weather"),
        F.lit("stations").alias("base"),
        F.struct(
            (value + 273.15).alias("temp"),
            (value + 270.0).alias("feels_like"),
            value.alias("temp_min"),
            (value * 2.0).alias("temp_max"),
            _int(1000 + user % 50).alias("pressure"),
            _int(event % 101).alias("humidity"),
            _int(1000 + user % 50).alias("sea_level"),
            _int(990 + user % 50).alias("grnd_level"),
        ).alias("main"),
        F.lit(10000).alias("visibility"),
        F.struct((value / 10.0).alias("speed"), _int(event % 360).alias("deg"), (value / 5.0).alias("gust")).alias(
            "wind"
        ),
        F.when(kind == "error", F.struct(value.alias("1h"))).alias("rain"),
        F.struct(_int(user % 101).alias("all")).alias("clouds"),
        epoch.alias("dt"),
        F.struct(F.lit("XX").alias("country"), (epoch - 3600).alias("sunrise"), (epoch + 36000).alias("sunset")).alias(
            "sys"
        ),
        F.lit(3600).alias("timezone"),
        _int(user).alias("id"),
        F.concat(F.lit("site-"), user.cast("string")).alias("name"),
        *code,
    )


def air_quality_payload() -> Column:
    """Shape B over the columns of events, as UTF-8 JSON bytes."""
    value = F.col("value")
    gases = ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]
    reading = F.struct(
        F.unix_seconds("ts").alias("dt"),
        F.struct(_int(F.col("user_id") % 5 + 1).alias("aqi")).alias("main"),
        F.struct(*((value * float(i)).alias(gas) for i, gas in enumerate(gases, 1))).alias("components"),
    )
    return json_bytes(
        F.struct((-value).alias("lon"), value.alias("lat")).alias("coord"),
        F.array(reading).alias("list"),
    )


def messages(rows: DataFrame, value: Column) -> DataFrame:
    """Events as messages. ``partition`` and ``offset`` stand for the place in a topic's log."""
    return rows.select(
        F.col("event_type").alias("topic"),
        F.col("ts").alias("timestamp"),
        value.alias("value"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def logged(rows: DataFrame) -> DataFrame:
    """Events in a log whose offsets count from 0 in each partition, in the order of the events.

    The topics' partitions count by themselves, as a broker keeps them.
    """
    log = props_messages(rows).withColumn("_day", F.date_trunc("day", "timestamp"))
    # Rows are numbered by day, and each day begins where the one before it ends: a busy partition is many tasks' work.
    days = log.groupBy("topic", "partition", "_day").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("topic", "partition").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    starts = days.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    order = Window.partitionBy("topic", "partition", "_day").orderBy("timestamp", "offset")
    numbered = log.withColumn("_number", F.row_number().over(order)).join(starts, ["topic", "partition", "_day"])
    return numbered.withColumn("offset", F.col("_start") + F.col("_number") - 1).drop("_day", "_start", "_number")


def props_messages(rows: DataFrame) -> DataFrame:
    """Events with their own ``props`` text as the message."""
    return messages(rows, F.encode("props", "UTF-8"))


def conditions_bronze(rows: DataFrame, keep: Sequence[str] = (), **damage: str) -> DataFrame:
    return envelope(messages(rows, conditions_payload(**damage)), keep)


def air_quality_bronze(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return envelope(messages(rows, air_quality_payload()), keep)


def cut_short(bronze: DataFrame, topic: str) -> DataFrame:
    """Drop the closing brace from the messages of one topic, as a broken transfer would."""
    text = F.col("json_str")
    broken = F.left(text, F.length(text) - 1)
    return bronze.withColumn("json_str", F.when(F.col("topic") == topic, broken).otherwise(text))


def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages and documents as messages that are not JSON at all."""
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("topic"), F.col("html").alias("json_str"))
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("topic"), F.col("text").alias("json_str")
    )
    stamp = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    return pages.unionByName(documents).select("topic", stamp.alias("timestamp"), "json_str")


def replayed(bronze: DataFrame, times: int = 3) -> DataFrame:
    """The whole table ``times`` over, as after reading a topic again from its start."""
    return bronze.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_copy")


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the driver's own tables have them."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )
