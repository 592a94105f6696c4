"""Places of a log as ranges of offsets: what was loaded, what is missing, what lies outside.

One largest offset for each partition says what was loaded only while nothing is missing before it. Ranges say it for any
history: ``(topic, partition, first, last)``, both ends included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.lists import expected_rows

PLACE = ("topic", "partition")
# Offsets of one block: the bits of Spark's bitmaps.
BLOCK_POWER = 15
BLOCK = 1 << BLOCK_POWER


def _block(offset: Column) -> Column:
    return F.shiftright(offset, BLOCK_POWER)


def _bits(bitmap: Column) -> Column:
    """A bitmap as text of 0 and 1, the first offset first.

    A byte's hexadecimal digits are swapped, and each is replaced by its four bits, lowest first.
    """
    digits = F.regexp_replace(F.hex(bitmap), "(.)(.)", "$2$1")
    # Letters that are no digits stand for the bits until all digits are replaced.
    for digit in range(16):
        bits = f"{digit:04b}"[::-1].replace("0", "o").replace("1", "l")
        digits = F.replace(digits, F.lit(f"{digit:X}"), F.lit(bits))
    return digits


def _islands(bits: Column, block: Column) -> Column:
    """The runs of set bits of one block as an array of ``first`` and ``last`` offsets."""
    runs = F.split(bits, "(?<=o)(?=l)|(?<=l)(?=o)")
    start = block * BLOCK
    state = F.struct(start.alias("at"), F.array().cast("array<struct<first:bigint,last:bigint>>").alias("found"))

    def step(so_far: Column, run: Column) -> Column:
        end = so_far["at"] + F.length(run)
        island = F.array(F.struct(so_far["at"].alias("first"), (end - 1).alias("last")))
        found = F.when(F.startswith(run, F.lit("l")), F.concat(so_far["found"], island)).otherwise(so_far["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(runs, state, step)["found"]


def joined_ranges(ranges: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """Ranges that overlap or touch, as one (gaps and islands over the ends).

    Each partition's ranges are ordered in one task; they are one for each gap, and one for each block.
    """
    ordered = Window.partitionBy(*place).orderBy("first", "last")
    before = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col("first") > before + 1)).cast("int")
    numbered = ranges.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(ordered))
    return (
        numbered.groupBy(*place, "_island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select(*place, "first", "last")
    )


def offset_ranges(messages: DataFrame, place: Sequence[str] = PLACE, offset: str = "offset") -> DataFrame:
    """The offsets that are there, as the fewest ranges: ``place``, ``first``, ``last``.

    Each task makes a bitmap of every block of 32,768 offsets it meets: one bit for an offset in place of a row,
    however often it repeats. The bitmaps of a block are merged after the shuffle, dealt out and cut into islands; blocks,
    not partitions, are the tasks' work, so a partition that holds most of a log is spread. Only islands that end at a
    block's edge are joined with those of the next block; all others are whole as they are. Rows without offset are left out.
    """
    placed = messages.where(F.col(offset) >= 0)
    bitmap = F.bitmap_construct_agg((F.col(offset) % BLOCK).cast("bigint")).alias("bitmap")
    blocks = placed.groupBy(*place, _block(F.col(offset)).alias("block")).agg(bitmap)
    # A bitmap is small and long to cut: AQE would give all of them to one task.
    blocks = blocks.repartition(messages.sparkSession.sparkContext.defaultParallelism, *place, "block")
    found = blocks.select(*place, "block", F.explode(_islands(_bits(F.col("bitmap")), F.col("block"))).alias("island"))
    found = found.select(*place, "block", "island.first", "island.last")
    at_edge = (F.col("first") == F.col("block") * BLOCK) | (F.col("last") == (F.col("block") + 1) * BLOCK - 1)
    # An island inside of a block is a group of its own, so only those at edges meet.
    grouped = found.withColumn("_own", F.when(~at_edge, F.col("first")).otherwise(-1))
    return joined_ranges(grouped, [*place, "_own"]).drop("_own")


def offset_gaps(ranges: DataFrame, place: Sequence[str] = PLACE, starts: int | None = None) -> DataFrame:
    """The offsets between the ranges: ``place``, ``first``, ``last``, ``missing``.

    Ranges as :func:`offset_ranges` gives them. With ``starts`` what is missing from there to the first range counts as well;
    without it a log begins where its first message is, as one does whose oldest messages have expired.
    """
    ordered = Window.partitionBy(*place).orderBy("first")
    before = F.lag("last").over(ordered)
    if starts is not None:
        before = F.coalesce(before, F.lit(starts - 1).cast("bigint"))
    gaps = ranges.select(*place, (before + 1).alias("low"), (F.col("first") - 1).alias("high"))
    return gaps.where("low <= high").select(
        *place, F.col("low").alias("first"), F.col("high").alias("last"), (F.col("high") - F.col("low") + 1).alias("missing")
    )


def outside_ranges(
    rows: DataFrame, ranges: DataFrame, place: Sequence[str] = PLACE, offset: str = "offset"
) -> DataFrame:
    """Rows whose offset lies in none of the ranges, whatever their order of arrival; batch or stream.

    An anti join by partition and block with the test of the ends behind it: a range takes part once for each block it
    covers. Rows without offset, and all of partitions without ranges, stay.
    """
    covered = ranges.select(
        *(F.col(name).alias(f"_{name}") for name in place),
        F.col("first").alias("_first"),
        F.col("last").alias("_last"),
        F.explode(F.sequence(_block(F.col("first")), _block(F.col("last")))).alias("_block"),
    )
    same = _block(F.col(offset)) == F.col("_block")
    for name in place:
        same &= F.col(name) == F.col(f"_{name}")
    return rows.join(covered, same & F.col(offset).between(F.col("_first"), F.col("_last")), "left_anti")


def gap_checks(
    messages: DataFrame, expected: Sequence[str], stage: str = "bronze", allowed: int = 0, starts: int | None = None
) -> DataFrame:
    """Result rows: each expected topic has messages, and no more than ``allowed`` offsets are missing between them."""
    wanted = messages.where(F.col("topic").isin(list(expected)))
    ranges = offset_ranges(wanted)
    held = ranges.groupBy("topic").agg(F.sum(F.col("last") - F.col("first") + 1).alias("held"))
    gaps = offset_gaps(ranges, starts=starts).groupBy("topic")
    gaps = gaps.agg(F.count(F.lit(1)).alias("gaps"), F.sum("missing").alias("missing"))
    rows = expected_rows(messages.sparkSession, "topic", expected).join(held, "topic", "left").join(gaps, "topic", "left")
    missing, many = F.coalesce("missing", F.lit(0)), F.coalesce("gaps", F.lit(0))
    return rows.select(
        F.lit(stage).alias("stage"),
        F.col("topic").alias("check"),
        (F.col("held").isNotNull() & (missing <= allowed)).alias("ok"),
        F.when(F.col("held").isNull(), "no messages")
        .otherwise(F.format_string("%d offsets, %d missing in %d gaps", "held", missing, many))
        .alias("detail"),
    )
