"""From raw documents to token ids: the stages of one training-data pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import decontaminate, exact, simhash, toxicity
from strandline.llm.common import table, with_folder
from strandline.llm.queries import encoded
from strandline.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. It learns from ``docs`` and the table ``labels``.

    Each row is judged by its own whole text, however long; null and empty texts stay, as do rows without id and rows that repeat if
    their text does. Without labels the fixed words alone decide. Extra columns stay; an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that of the smallest ``doc_id``, whole texts compared.

    Rows are told apart by id and text: a text that is there once stays whatever its id, rows without id are judged like all others, and
    of rows that agree in both the smallest stays. Null and empty texts are one text. Extra columns stay; an empty table stays empty.
    """
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints of four-word shingles that differ in four bits or fewer.

    That of the smallest ``doc_id`` stays; ids that are null or repeat are as in the stage before. Texts without words, null ones among
    them, are one group. Whole texts, however long. Extra columns stay; an empty table stays empty.
    """
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the table ``benchmark`` (0.8 or more of its five-word shingles).

    The text alone decides, whatever the ids. Null, empty and short texts stay, long ones are searched whole; without items all stay. Extra
    columns stay; an empty table stays empty.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left: one row for each row, whatever its id; a null text has no tokens."""
    return encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", drop_contaminated),
    ("bpe", bpe),
]

# Learned scores decide in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each to what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    place = scratch_dir(with_folder(spark), "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{place}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
