"""How late rows are and how many keys there are, from sketches that can be merged.

Exact quantiles and distinct counts need all rows again for every range of days that is asked for. A sketch of each day is kept
instead, a few kilobytes whatever its rows, and days are merged into any range. Counts are exact; the number of keys is within
``KEY_ERROR`` and the rank of a quantile within ``RANK_ERROR``, each in about 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import utc_day

# Registers of the sketch of keys, as a power of two, and items of that of lags.
KEY_POWER, LAG_ITEMS = 13, 400
KEY_ERROR, RANK_ERROR = 0.03, 0.01
QUANTILES = (0.5, 0.95, 0.99)


def daily_sketches(
    rows: DataFrame,
    keys: Sequence[str],
    event_time: str = "event_time",
    arrived: str = "timestamp",
    by: Sequence[str] = ("topic",),
) -> DataFrame:
    """One row for each group and UTC day of arrival: ``n``, ``key_sketch`` and ``lag_sketch`` of the whole seconds between event
    and arrival. Tasks sketch their own rows, so a busy group moves as little as any other. Rows without an event time have no lag."""
    lag = F.unix_seconds(arrived) - F.unix_seconds(event_time)
    hashed = F.xxhash64(*(F.col(key) for key in keys))
    return rows.groupBy(*by, utc_day(F.col(arrived)).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(hashed, KEY_POWER).alias("key_sketch"),
        F.kll_sketch_agg_bigint(lag, LAG_ITEMS).alias("lag_sketch"),
    )


def merged(sketches: DataFrame, by: Sequence[str] = ("topic",)) -> DataFrame:
    """The sketches of some days as one for each group."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("key_sketch").alias("key_sketch"),
        F.kll_merge_agg_bigint("lag_sketch").alias("lag_sketch"),
    )


def _quantile(sketch: Column, share: float) -> Column:
    some = F.kll_sketch_get_n_bigint(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_bigint(sketch, F.lit(share)))


def lag_profile(sketches: DataFrame, by: Sequence[str] = ("topic",)) -> DataFrame:
    """``n``, ``keys`` (distinct, estimated) and the quantiles ``lag_p50``, ``lag_p95``, ``lag_p99`` in seconds over the days given."""
    whole = merged(sketches, by)
    lags = [_quantile(F.col("lag_sketch"), share).alias(f"lag_p{round(share * 100)}") for share in QUANTILES]
    return whole.select(*by, "n", F.hll_sketch_estimate("key_sketch").alias("keys"), *lags)


def lag_checks(profile: DataFrame, limit_seconds: int, stage: str = "silver", group: str = "topic") -> DataFrame:
    """Result rows: of each group, 95 of 100 rows arrived within ``limit_seconds``."""
    late = F.format_string(f"95 of 100 rows within %d s, limit {limit_seconds} s", "lag_p95")
    return profile.select(
        F.lit(stage).alias("stage"),
        F.col(group).alias("check"),
        F.coalesce(F.col("lag_p95") <= limit_seconds, F.lit(False)).alias("ok"),
        F.when(F.col("lag_p95").isNull(), "no event times").otherwise(late).alias("detail"),
    )
