"""Parse, flatten and quarantine."""

import math

import pytest
from conftest import at
from pyspark.sql import functions as F

from strandline import CONDITIONS, Feed
from strandline.functions import instant, utf8_text
from strandline.operators import envelope, flatten, parse, screen, to_silver

SMALL = Feed.of(
    "small",
    "coord STRUCT<lat: DOUBLE>, weather ARRAY<STRUCT<id: INT, main: STRING>>, "
    "main STRUCT<temp: DOUBLE, pressure: INT>, rain STRUCT<`1h`: DOUBLE>, dt BIGINT, cod INT",
    [
        ("event_time", "epoch", "dt"),
        ("lat", "field", "coord.lat"),
        ("condition_id", "first", "weather.id"),
        ("temp", "field", "main.temp"),
        ("pressure", "field", "main.pressure"),
        ("rain_1h", "field", "rain.1h"),
        ("cod", "field", "cod"),
    ],
)

OK = (
    '{"coord":{"lat":1.5},"weather":[{"id":800,"main":"Clear"}],"main":{"temp":290,"pressure":1012},'
    '"rain":{"1h":0.3},"dt":1700000000,"cod":200}'
)
NOTHING = {"event_time": None, "lat": None, "condition_id": None, "temp": None, "pressure": None, "rain_1h": None, "cod": None}

# text, expected values that differ from all-NULL, verdict
CORPUS = {
    "ok": (OK, {"lat": 1.5, "condition_id": 800, "temp": 290.0, "pressure": 1012, "rain_1h": 0.3, "cod": 200, "event_time": at(0)}, "good"),
    "no weather": ('{"dt":1700000000,"cod":200}', {"event_time": at(0), "cod": 200}, "good"),
    "empty weather": ('{"weather":[],"cod":200}', {"cod": 200}, "good"),
    "float in int": ('{"main":{"temp":1.5,"pressure":1012.5},"cod":200}', {"temp": 1.5, "cod": 200}, "partial"),
    "string in int": ('{"dt":1700000000,"cod":"200"}', {"event_time": at(0)}, "partial"),
    "string in double": ('{"main":{"temp":"290.5"},"cod":1}', {"cod": 1}, "partial"),
    "string in long": ('{"dt":"1700000000","cod":1}', {"cod": 1}, "partial"),
    "int overflow": ('{"cod":3000000000,"main":{"temp":2.0}}', {"temp": 2.0}, "partial"),
    "wrong case": ('{"DT":1700000000,"Cod":200,"main":{"Temp":1.0}}', {}, "good"),
    "truncated": ('{"dt":1700000000,"cod":20', {}, "malformed"),
    "not json": ("hello", {}, "malformed"),
    "top-level array": ('[{"dt":1,"cod":2}]', {}, "malformed"),
    "empty text": ("", {}, "malformed"),
    "null": (None, {}, "malformed"),
    "unknown key": ('{"zzz":{"a":1},"cod":5}', {"cod": 5}, "good"),
    "duplicate key": ('{"cod":1,"cod":2}', {"cod": 2}, "good"),
    "trailing text": ('{"dt":1700000000,"cod":3} x', {"event_time": at(0), "cod": 3}, "good"),
    "empty object": ("{}", {}, "good"),
}


def rows_of(df):
    # Instants as epoch seconds, so that the machine's zone does not matter.
    return [r.asDict() for r in df.withColumn("event_time", F.unix_seconds("event_time")).collect()]


@pytest.mark.parametrize("case", CORPUS)
def test_corpus_h5_h6(envelope_of, case):
    text, values, verdict = CORPUS[case]
    bronze = envelope_of([("t", 0, text)])
    expected = {**NOTHING, **values}
    if expected["event_time"] is not None:
        expected["event_time"] = int(expected["event_time"].timestamp())
    (got,) = rows_of(to_silver(bronze, SMALL).drop("timestamp"))
    assert got == expected
    (judged,) = rows_of(screen(bronze, SMALL).drop("timestamp"))
    assert judged.pop("verdict") == verdict
    assert judged.pop("raw") == (None if verdict == "good" else text)
    assert judged.pop("topic") == "t"
    assert judged == expected


def test_nan_is_a_number(envelope_of):
    (row,) = to_silver(envelope_of([("t", 0, '{"main":{"temp":NaN}}')]), SMALL).collect()
    assert math.isnan(row["temp"])


def test_empty_array_does_not_raise_under_ansi_h4(spark, envelope_of):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    (row,) = to_silver(envelope_of([("t", 0, '{"weather":[],"name":"x"}')]), CONDITIONS).collect()
    assert row["condition_id"] is None and row["city_name"] == "x"


@pytest.mark.parametrize("dt", [9223372036854775807, -9223372036854775808, 9223372036855])
def test_epoch_beyond_range_is_null_not_an_error_h14(envelope_of, dt):
    (row,) = to_silver(envelope_of([("t", 0, f'{{"dt":{dt},"cod":1}}')]), SMALL).collect()
    assert row["event_time"] is None and row["cod"] == 1


def test_epoch_in_milliseconds_is_caught_by_screen_h14(envelope_of):
    bronze = envelope_of([("t", 0, '{"dt":1700000000000}'), ("t", 1, '{"dt":1700000000}'), ("t", 2, '{"dt":5}')])
    judged = screen(bronze, SMALL, earliest="2000-01-01T00:00:00Z", latest="2100-01-01T00:00:00Z")
    assert [r["verdict"] for r in judged.orderBy("timestamp").select("verdict").collect()] == [
        "out_of_range", "good", "out_of_range",
    ]


def test_envelope_p1_f1(spark):
    messages = spark.createDataFrame(
        [(bytearray("{\"a\":\"é\"}", "utf-8"), "t", 3, 7, at(0))],
        "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP",
    )
    df = envelope(messages, keep=["partition", "offset"])
    assert df.columns == ["topic", "timestamp", "json_str", "partition", "offset"]
    assert df.first()["json_str"] == '{"a":"é"}'


def test_invalid_bytes_are_replaced_f12(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xffc"),)], "value BINARY")
    assert df.select(utf8_text(F.col("value"), replace_invalid=True)).first()[0] == "ab�c"


def test_parse_is_evaluated_once_per_row_and_pruned(envelope_of):
    from conftest import plan_of

    bronze = envelope_of([("t", 0, OK)])
    assert plan_of(to_silver(bronze, SMALL)).count("from_json(") == 1
    one = plan_of(to_silver(bronze, SMALL).select("temp"))
    assert "main" in one and "weather" not in one and "rain" not in one


def test_bad_cutoff_text_raises_f5(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID|INVALID"):
        spark.range(1).select(instant("yesterday-ish")).collect()


def test_flatten_can_carry_columns(envelope_of):
    df = flatten(parse(envelope_of([("t", 0, OK)]), SMALL), SMALL, "topic")
    assert df.columns[-1] == "topic"
