"""Which parts of a table may hold a key, from bits in place of the keys.

A key that does not say what its row's time is can be in any part. So that a micro-batch does not read the keys of the whole
table, each part gets a Bloom sketch: ``BITS_PER_KEY`` bits for each of its keys, in blocks of 32,768. A key has one block, found from the
number of blocks, and ``HASHES`` bits in it. A part in which no key of the batch has all its bits set holds none of them, and is
left out. Parts without a sketch are always read, so one that is lost costs time and no row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources.files import read_files

BLOCK_BITS = 32_768
WORD_BITS = 64
# About three keys in ten million are taken for one of a part that does not hold them.
BITS_PER_KEY = 32
HASHES = 16
# Blocks of the smallest sketch, as a power of two, so that the keys of a batch are spread over several tasks.
LEAST_LEVEL = 4

SKETCH = "level INT, block BIGINT, words ARRAY<BIGINT>, run STRING, batch BIGINT"


def _hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *(F.col(key) for key in keys))


def _block(keys: Sequence[str], level: Column) -> Column:
    """The block of a key among 2 to the power of ``level``."""
    return F.pmod(_hash(keys, 0), F.call_function("shiftleft", F.lit(1).cast("bigint"), level))


def _bits(keys: Sequence[str]) -> Column:
    """The places of a key's bits in its block: an arithmetic sequence from two hashes."""
    start, step = F.pmod(_hash(keys, 1), F.lit(BLOCK_BITS)), F.pmod(_hash(keys, 2), F.lit(BLOCK_BITS // 2)) * 2 + 1
    steps = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda k: F.pmod(start + k * step, F.lit(BLOCK_BITS)))
    return F.array_distinct(steps)


def _words(bitmap: Column) -> Column:
    """A bitmap as numbers of 64 bits; the first byte is the highest of its number."""
    text = F.hex(bitmap)
    digits = WORD_BITS // 4
    word = lambda k: F.conv(F.substring(text, k * digits + 1, F.lit(digits)), 16, -10).cast("bigint")
    return F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // WORD_BITS - 1)), word)


def _is_set(words: Column, bit: Column) -> Column:
    byte = F.floor(bit / 8) % 8
    return F.getbit(F.get(words, F.floor(bit / WORD_BITS).cast("int")), (F.lit(7) - byte) * 8 + bit % 8) == 1


def level_for(keys: int) -> int:
    """Blocks, as a power of two, that give ``keys`` keys their bits."""
    return max(LEAST_LEVEL, math.ceil(math.log2(max(1, keys * BITS_PER_KEY / BLOCK_BITS))))


def sketch_of(rows: DataFrame, keys: Sequence[str], level: int) -> DataFrame:
    """``level``, ``block`` and ``words`` for the keys of ``rows``. Tasks set the bits of their own rows before the shuffle."""
    bits = rows.select(_block(keys, F.lit(level)).alias("block"), F.explode(_bits(keys)).alias("bit"))
    blocks = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return blocks.select(F.lit(level).alias("level"), "block", _words(F.col("bitmap")).alias("words"))


def write_sketch(rows: DataFrame, keys: Sequence[str], path: str, run: str, batch_id: int) -> None:
    """Write the sketch of one part, in place of an earlier one of the same part. ``rows`` are what the part holds."""
    made = sketch_of(rows, keys, level_for(rows.count()))
    made.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}/batch={batch_id}")


def parts_without(spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str]) -> list[tuple[str, int]]:
    """The parts (``run``, ``batch``) whose sketches say that they hold none of the keys of ``wanted``.

    Sketches meet keys by block, in a semi join that ends with a block's first hit. A row for each part comes to the driver.
    """
    sketches = read_files(spark, path, SKETCH, depth=2, missing_ok=True, base_path=path)
    parts = sketches.select("run", "batch", "level").distinct().collect()
    if not parts:
        return []
    levels = sorted({row["level"] for row in parts})
    each = wanted.select(*keys).distinct().withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    named = each.select("_level", _block(keys, F.col("_level")).alias("_block"), _bits(keys).alias("_bits"))
    hit = F.forall("_bits", lambda bit: _is_set(F.col("words"), bit))
    same = (F.col("level") == F.col("_level")) & (F.col("block") == F.col("_block"))
    found = sketches.join(named, same & hit, "left_semi").select("run", "batch").distinct().collect()
    held = {(row["run"], row["batch"]) for row in found}
    return [(row["run"], row["batch"]) for row in parts if (row["run"], row["batch"]) not in held]
