"""Shards of near equal size: the minimax contiguous partition of ordered groups that stay whole.

Groups are equal texts, in the order of their SHA-256. A capacity is feasible if shards filled greedily, each up to the capacity
and cut between groups, hold all of them; the smallest one is found by binary search. The groups themselves stay in Spark: the search
works on sums over stretches of the order, and a stretch in which a cut may fall is opened into shorter ones
until the cuts are known to the group.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import cut, text_of

SHARDS = 8
# Bytes of the digest that name the stretches of the first sums, and bytes by which an open stretch is divided.
FIRST_BYTES, MORE_BYTES = 1, 1
DIGEST_BYTES = 32
# Rows that are numbered in one task, and copies of one row that are made at one time.
NUMBERED_ROWS = 1_000_000
COPIES = 10_000


@dataclass(frozen=True)
class Stretch:
    """Groups that follow each other: those whose digest begins with ``prefix`` (upper-case hex)."""

    prefix: str
    size: int
    groups: int
    largest: int


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest``, ``size`` and ``text_crc32`` of the different rows, and ``n``, how often each occurs."""
    text = text_of()
    data = text.cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.unhex(F.sha2(data, 256)).alias("digest"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    return rows.groupBy("doc_id", "digest", "size", "text_crc32").agg(F.count("*").alias("n"))


def _prefix(size: int) -> Column:
    return F.hex(F.substring("digest", 1, size))


def stretches(groups: DataFrame, size: int) -> list[Stretch]:
    """Sums over the groups that share the first ``size`` bytes of the digest, in order."""
    sums = groups.groupBy(_prefix(size).alias("prefix")).agg(
        F.sum("bytes").cast("long").alias("size"), F.count("*").alias("groups"), F.max("bytes").cast("long").alias("largest")
    )
    return sorted((Stretch(*row) for row in sums.collect()), key=lambda s: s.prefix)


# ------------------------------------------------------------------ search over stretches


def fill(ends: list[int], capacity: int, shards: int) -> list[int]:
    """How many items each of ``shards`` shards has taken, filled one after the other up to ``capacity``, summed up."""
    cuts, at = [], 0
    for _ in range(shards):
        at = bisect_right(ends, (ends[at - 1] if at else 0) + capacity, lo=at)
        cuts.append(at)
    return cuts


def smallest_capacity(sizes: list[int], least: int, shards: int) -> int:
    """The smallest capacity from ``least`` on at which ``shards`` shards hold all items, by binary search."""
    ends = list(accumulate(sizes))
    low, high = least, max(least, ends[-1] if ends else 0)
    while low < high:
        middle = (low + high) // 2
        if fill(ends, middle, shards)[-1] == len(ends):
            high = middle
        else:
            low = middle + 1
    return low


def in_question(parts: list[Stretch], shards: int) -> list[Stretch]:
    """The stretches of several groups in which a cut may fall.

    No capacity below ``low`` and none above ``high`` is the smallest feasible one. At any capacity between them a
    shard ends no earlier than if it left the stretch that it can't hold whole, at ``low``, and no
    later than if it took all of the stretch in which it is full, at ``high``.
    """
    sizes = [p.size for p in parts]
    total = sum(sizes)
    ends = list(accumulate(sizes))
    low = max([-(-total // shards), *(p.largest for p in parts)])
    high = smallest_capacity(sizes, low, shards)
    open_, first, last = set(), 0, 0
    for _ in range(shards - 1):
        start = ends[first - 1] if first else 0
        first = bisect_right(ends, start + low, lo=first)
        full = (ends[last - 1] if last else 0) + high
        last = min(bisect_right(ends, full, lo=min(last, len(ends))) + 1, len(ends))
        open_.update(range(first, last))
    return [parts[k] for k in sorted(open_) if parts[k].groups > 1]


def cut_points(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[str]]:
    """The smallest feasible capacity, and the digests (upper-case hex, or their beginnings) at which shards 1, 2, … begin.

    ``groups`` has ``digest`` and ``bytes``. The driver sees sums over some ten thousand stretches at most in each turn, whatever the number of
    groups; each turn reads only the stretches that are open.
    """
    width = FIRST_BYTES
    parts = stretches(groups, width)
    while asked := in_question(parts, shards):
        opened = groups.where(_prefix(width).isin([p.prefix for p in asked]))
        width = min(DIGEST_BYTES, width + MORE_BYTES)
        closed = set(parts) - set(asked)
        parts = sorted([*closed, *stretches(opened, width)], key=lambda s: s.prefix)
        groups = opened
    sizes = [p.size for p in parts]
    least = max([0, -(-sum(sizes) // shards), *(p.largest for p in parts)])
    capacity = smallest_capacity(sizes, least, shards)
    cuts = fill(list(accumulate(sizes)), capacity, shards)
    return capacity, [parts[at].prefix for at in cuts[:-1] if at < len(parts)]


# ------------------------------------------------------------------ numbers


def numbered(rows: DataFrame, most: int = NUMBERED_ROWS) -> DataFrame:
    """``rows`` (``shard``, ``digest``, ``doc_id``, ``n``) with ``start``, the gapless number of each one's first copy in its shard.

    Rows are numbered in pieces: by the first bytes of the digest, and by a hash of the id where such a piece
    holds more than ``most`` rows, as with a text of very many copies. A piece begins where the ones before it end.
    """
    rows = rows.withColumn("piece", _prefix(1))
    sizes = cut(rows.groupBy("shard", "piece").agg(F.sum("n").alias("rows")))
    parts = F.ceil(F.col("rows") / most).cast("int")
    large = F.broadcast(sizes.where(F.col("rows") > most).select("shard", "piece", parts.alias("parts")))  # 256 · shards rows at most
    dealt = rows.join(large, ["shard", "piece"], "left")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("part", part).drop("parts")
    keys = ["shard", "piece", "part"]
    before = Window.partitionBy("shard").orderBy("piece", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*keys).agg(F.sum("n").alias("rows"))
    offsets = offsets.select(*keys, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*keys).orderBy("digest", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.join(cut(offsets), keys).withColumn("start", F.col("offset") + F.col("inside"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, most: int = NUMBERED_ROWS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot`` and ``grown_shard`` (null) for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the whole text plus 1. Rows of equal texts share a shard, and the largest shard is as small as it can be
    with texts in the order of their SHA-256 and shards cut from that order. A text whose copies are larger than
    an even share fills its shard alone or nearly so. ``slot`` counts from 0 in each shard, without gaps.

    A null text counts as empty. Null ids come first among equal texts; rows that repeat get a row and a slot
    each. Other columns are ignored; an empty table gives an empty result.
    """
    rows = cut(sized(docs))
    groups = cut(rows.groupBy("digest").agg(F.sum(F.col("size") * F.col("n")).alias("bytes")))
    _, points = cut_points(groups, shards)
    shard = F.lit(0)
    for point in points:
        shard = shard + (F.hex("digest") >= point).cast("int")
    placed = numbered(rows.withColumn("shard", shard), most)
    placed = placed.withColumn("end", F.col("start") + F.col("n") - 1)
    placed = placed.withColumn("from", F.explode(F.sequence("start", "end", F.lit(COPIES).cast("long"))))
    copies = placed.withColumn("slot", F.explode(F.sequence("from", F.least("end", F.col("from") + COPIES - 1))))
    return copies.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
