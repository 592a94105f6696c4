"""What the operators of this package share: reading, row functions, held-out rows, lineage cuts, joins by id."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows that a Python task turns into objects at one time; the rest of an Arrow batch stays packed.
SLICE_ROWS = 256

# Keys (40 bytes each) up to which a join by key sends them to every executor. More are shuffled instead.
BROADCAST_IDS = 500_000

FOLDS = 3
HELD_OUT_FOLD = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fold that no model learns from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def importable(rows: DataFrame) -> DataFrame:
    """``rows``, with this library's folder on the import path of workers that share the driver's disk.

    A cluster gets the library as it gets any other package.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    rows.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", root)
    return rows


# What a Python worker keeps from task to task: one thing, as workers go from operator to operator.
KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept in this worker under ``name`` in place of what was kept before."""
    release(name)
    if name not in KEPT:
        KEPT[name] = make()
    return KEPT[name]


def release(but: str | None = None) -> None:
    """Give the memory back of what an earlier operator kept in this worker."""
    for name in KEPT.keys() - {but}:
        del KEPT[name]


def map_texts(
    rows: DataFrame,
    schema: str,
    start: Callable[[], Callable[..., Iterator[tuple] | list[tuple]]],
    keeps: str | None = None,
) -> DataFrame:
    """Give every row of ``rows`` to a Python function, in slices, and collect the tuples it makes.

    ``start`` runs once in each task and returns a function from equally long column lists to result tuples
    of ``schema``. Only a slice of a batch is ever unpacked, so long texts do not pile up. ``keeps`` names what ``start`` has ``kept``.
    """
    names = [part.split()[0] for part in schema.split(",")]
    types = [ARROW_TYPES[part.split()[1]] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keeps)
        work = start()
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(low, SLICE_ROWS)
                made = list(work(*(column.to_pylist() for column in piece.columns)))
                columns = list(zip(*made, strict=True)) if made else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, type=kind) for values, kind in zip(columns, types, strict=True)], names=names
                )

    return importable(rows).mapInArrow(run, schema)


ARROW_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<double>": pa.list_(pa.float64()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def with_folder(spark: SparkSession) -> SparkSession:
    """``spark`` with a checkpoint folder: the cluster's ``spark.checkpoint.dir``.

    Only where that is unset and all executors are in this process, as in tests, a temporary folder takes its place.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from those files."""
    with_folder(df.sparkSession)
    return df.checkpoint()


def text_digest(column: str = "text") -> Column:
    """SHA-256 of the whole text, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(text_of(column).cast("binary"), 256))


def join_keys(rows: DataFrame, found: DataFrame, keys: dict[str, Column], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of ``rows`` with the columns of ``found`` that ``keys`` names.

    ``keys`` says what stands for each of them in ``rows``; null equals null. What was found is broadcast if it was counted and
    is little; otherwise both sides are shuffled and AQE splits what is skewed.
    """
    found = cut(found.select(*(F.col(name).alias(f"_joined_{name}") for name in keys)).distinct())
    if found.count() <= BROADCAST_IDS:
        found = F.broadcast(found)
    same = [value.eqNullSafe(found[f"_joined_{name}"]) for name, value in keys.items()]
    return rows.join(found, reduce(Column.__and__, same), how)


def one_of_each(rows: DataFrame, repeated: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``rows``, of those whose ``keys`` stand in ``repeated`` the smallest one of each key only.

    Tasks reduce their own rows first, so a row that is there very often crosses the shuffle once for each task.
    """
    repeated = cut(repeated)
    if repeated.isEmpty():
        return rows
    named = {f"_key_{name}": value for name, value in keys.items()}
    twice = join_keys(rows, repeated, keys, "left_semi")
    one = twice.groupBy(*(value.alias(name) for name, value in named.items())).agg(F.min(F.struct(*rows.columns)).alias("_row"))
    return join_keys(rows, repeated, keys, "left_anti").unionByName(one.select("_row.*"))


def sample_by_hash(
    rows: DataFrame, group: str, most: int, key: tuple[str, ...] = ("doc_id",), stands_for: str | None = None
) -> DataFrame:
    """About ``most`` rows of each value of ``group``, all where there are no more; the same ones in every run.

    Rows are taken by a hash of the columns ``key`` below a bound that follows from the group's size, so no group
    is sorted or gathered. Rows that agree in ``key`` are taken together, so it must tell rows apart: see ``sample_texts``. The expected number is ``most``; it varies by its square root. A column
    ``stands_for``, if named, says how many rows of its group each row stands for.
    """
    sizes = {row[0]: row[1] for row in rows.groupBy(group).count().collect()}
    share = F.lit(0.0)
    for value, count in sizes.items():
        if value is not None:
            share = F.when(F.col(group) == F.lit(value), F.lit(min(1.0, most / count))).otherwise(share)
    place = F.pmod(F.xxhash64(*key), F.lit(1_000_003)) / F.lit(1_000_003.0)
    taken = rows.where(place < share)
    return taken if stands_for is None else taken.withColumn(stands_for, F.try_divide(F.lit(1.0), share))


def sample_texts(docs: DataFrame, keyed: DataFrame, group: str, most: int, stands_for: str | None = None) -> DataFrame:
    """Texts of about ``most`` rows of each value of ``group``, all where there are no more: ``group``, ``text`` and ``unit``.

    ``keyed`` has ``group``, ``doc_id`` and ``digest`` of the rows to draw from. Rows that agree in all three count as one, and each is
    drawn by a hash of id and text: so neither null ids nor an id or a text on very many rows break the bound or keep others out. Only
    these keys are shuffled. ``unit`` is the id, or a hash of the text where the id is null or repeats.
    """
    different = cut(keyed.select(group, "doc_id", "digest").distinct())
    drawn = sample_by_hash(different, group, most, ("doc_id", "digest"), stands_for)
    of_id = Window.partitionBy(group, "doc_id")  # a bounded sample
    alone = F.col("doc_id").isNotNull() & (F.count("*").over(of_id) == 1)
    drawn = cut(drawn.withColumn("unit", F.when(alone, F.col("doc_id")).otherwise(F.xxhash64("digest"))))
    weight = [stands_for] if stands_for else []
    named = drawn.select(group, "unit", *weight, F.col("doc_id").alias("_drawn_id"), F.col("digest").alias("_drawn_digest"))
    read = docs.select("doc_id", text_of(), text_digest().alias("_digest"))
    same = F.col("doc_id").eqNullSafe(F.col("_drawn_id")) & (F.col("_digest") == F.col("_drawn_digest"))
    # The sample's bound is what makes it fit for a broadcast.
    found = read.join(F.broadcast(named), same).select(group, "unit", "text", *weight, "_drawn_id", "_drawn_digest")
    one = found.dropDuplicates([group, "_drawn_id", "_drawn_digest"])
    return one.drop("_drawn_id", "_drawn_digest")


def share_of_copies(sizes: list[tuple[int, int]], most: int) -> float:
    """The share of rows at which about ``most`` different values are drawn, if a value with c copies is drawn with
    probability min(1, c · share). ``sizes`` has pairs of copies and how many values have so many."""
    if sum(values for _, values in sizes) <= most:
        return 1.0
    left = sum(copies * values for copies, values in sizes)
    for copies, values in sorted(sizes, reverse=True):
        if copies * most < left:
            break
        left, most = left - copies * values, most - values
    return most / left


def sample_by_copies(rows: DataFrame, group: str, most: int, key: str, stands_for: str) -> DataFrame:
    """About ``most`` rows of each value of ``group``, all where there are no more; the same ones in every run.

    ``rows`` are different values of ``key``, each with its ``copies``. A value is drawn by its hash, the likelier the more
    copies it has, and always if they are so many that one is sure to be drawn; ``stands_for`` says for how many
    copies it stands, so that they add up to those of the group. The driver sees a row for each number of copies.
    """
    sizes: dict = {}
    for value, copies, values in rows.groupBy(group, "copies").count().collect():
        sizes.setdefault(value, []).append((copies, values))
    share = F.lit(0.0)
    for value, pairs in sizes.items():
        if value is not None:
            share = F.when(F.col(group) == F.lit(value), F.lit(share_of_copies(pairs, most))).otherwise(share)
    chance = F.least(F.lit(1.0), F.col("copies") * share)
    place = F.pmod(F.xxhash64(key), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return rows.where(place < chance).withColumn(stands_for, F.try_divide(F.col("copies"), chance))
