"""Raw JSON text to typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.contracts import Feed, SilverColumn
from strandline.functions import first_element, from_epoch_seconds, instant

CORRUPT = "_corrupt_record"

# A key that names one message: its place in the log (H2).
LOG_KEY = ("topic", "partition", "offset")

GOOD = "good"
PARTIAL = "partial"
MALFORMED = "malformed"
OUT_OF_RANGE = "out_of_range"


def parse(bronze: DataFrame, feed: Feed, with_corrupt: bool = False) -> DataFrame:
    """Add ``data``, the payload as a struct.

    Permissive: unknown fields are dropped, missing ones are NULL, a field of the wrong type is NULL
    alone (H6). Malformed text gives a struct of NULLs, empty or NULL text a NULL struct (H5).
    """
    schema = f"{feed.payload}, {CORRUPT} STRING" if with_corrupt else feed.payload
    options = {"columnNameOfCorruptRecord": CORRUPT} if with_corrupt else {}
    return bronze.withColumn("data", F.from_json("json_str", schema, options))


def value_of(column: SilverColumn, data: Column | None = None) -> Column:
    """The expression of one silver column over the parsed struct."""
    data = F.col("data") if data is None else data
    head, *rest = column.path.split(".")
    start = data.getField(head)
    if column.kind.startswith("first"):
        start = first_element(start)
    value = reduce(lambda struct, field: struct.getField(field), rest, start)
    return from_epoch_seconds(value) if column.kind.endswith("epoch") else value


def flatten(parsed: DataFrame, feed: Feed, *extra: Column | str) -> DataFrame:
    """``timestamp`` and the feed's silver columns, in the order of its contract."""
    return parsed.select(
        "timestamp",
        *(value_of(column).alias(column.name) for column in feed.columns),
        *extra,
    )


def to_silver(bronze: DataFrame, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    """Parse and flatten. Keeps every row, malformed ones with NULLs (H5). No shuffle.

    ``keep`` names envelope columns that silver has behind its own, such as those of :data:`LOG_KEY` (H2).
    """
    return flatten(parse(bronze, feed), feed, *keep)


def missing_values(feed: Feed) -> Column:
    """How many silver columns of a row are NULL. Of the rows of one key the one with the fewest is the best,
    in the batch and in the stream alike (H5): a full reading before an error reply, that before malformed text."""
    return reduce(lambda a, b: a + b, (F.col(column.name).isNull().cast("int") for column in feed.columns))


def is_blank(data: Column, feed_fields: list[str]) -> Column:
    """True when the payload gave nothing at all: a NULL struct, or every top-level field NULL."""
    return ~reduce(lambda a, b: a | b, (data.getField(f).isNotNull() for f in feed_fields))


def payload_fields(parsed: DataFrame) -> list[str]:
    return [f for f in parsed.schema["data"].dataType.fieldNames() if f != CORRUPT]


def screen(
    bronze: DataFrame,
    feed: Feed,
    earliest: str | None = None,
    latest: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Silver columns plus ``verdict``, and the text of the rows that need a look.

    ``verdict`` is ``good``, ``partial`` (some field did not fit), ``malformed`` (nothing usable) or,
    when ``earliest``/``latest`` are given, ``out_of_range`` for an ``event_time`` outside of them.
    ``topic`` comes along, and ``raw`` holds the text where the verdict is not ``good``. One write with
    ``partition_by="verdict"`` splits good rows from the side table in a single pass.
    """
    parsed = parse(bronze, feed, with_corrupt=True)
    data = F.col("data")
    flat = flatten(
        parsed,
        feed,
        *dict.fromkeys([*keep, "topic"]),
        F.col("json_str").alias("raw"),
        F.coalesce(is_blank(data, payload_fields(parsed)), F.lit(True)).alias("_blank"),
        data.isNull().alias("_no_struct"),
        data.getField(CORRUPT).isNotNull().alias("_corrupt"),
    )
    # An empty object is well-formed and blank, so blank alone is not enough.
    verdict = F.when(F.col("_blank") & (F.col("_corrupt") | F.col("_no_struct")), MALFORMED).when(
        F.col("_corrupt"), PARTIAL
    )
    if earliest is not None:
        verdict = verdict.when(F.col("event_time") < instant(earliest), OUT_OF_RANGE)
    if latest is not None:
        verdict = verdict.when(F.col("event_time") > instant(latest), OUT_OF_RANGE)
    judged = flat.withColumn("verdict", verdict.otherwise(GOOD))
    return judged.withColumn("raw", F.when(F.col("verdict") != GOOD, F.col("raw"))).drop(
        "_blank", "_no_struct", "_corrupt"
    )


SILVER, QUARANTINE = "silver", "quarantine"
REJECTED = (MALFORMED, OUT_OF_RANGE)


def routed(
    bronze: DataFrame,
    feed: Feed,
    earliest: str | None = None,
    latest: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """:func:`screen` with ``part``: where a row belongs.

    Malformed and out-of-range rows go to the quarantine with their text, all others to silver. One write with
    ``part`` as the first directory level makes both tables in a single pass.
    """
    judged = screen(bronze, feed, earliest, latest, keep)
    part = F.when(F.col("verdict").isin(*REJECTED), QUARANTINE).otherwise(SILVER)
    raw = F.when(F.col("verdict").isin(*REJECTED), F.col("raw"))
    return judged.withColumns({"part": part, "raw": raw})
