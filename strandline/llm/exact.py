"""Exact dedup: local winners, then salted groups, then salt winners, comparing whole texts at each stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, join_keys, one_of_each, text_of

# Parts into which the rows of one text are dealt before they meet.
SALTS = 32


def normalised(column: str = "text") -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(text_of(column), r"[\x20\x09-\x0D]+", " ")


def sha256_key(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _addressed(docs: DataFrame, digest) -> DataFrame:
    content = normalised()
    return docs.select("doc_id", content.alias("content"), digest(content).alias("digest"))


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row for each different text: ``digest``, ``content``, smallest ``doc_id`` as ``keep_id``, ``n`` rows.

    Each aggregation has the text itself in its key, so rows meet only if their texts are equal and a
    digest alone never decides. Before the first shuffle a task reduces its own rows to one for each text.
    A salt that stands for the task's partition deals the local winners of one text to ``salts`` places;
    the last shuffle moves at most ``salts`` rows of any text.
    """
    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    by_salt = salted.groupBy("salt", "digest", "content").agg(F.min("doc_id").alias("m"), F.count("*").alias("c"))
    return by_salt.groupBy("digest", "content").agg(F.min("m").alias("keep_id"), F.sum("c").alias("n"))


def exact_groups(docs: DataFrame, salts: int = SALTS, digest=sha256_key) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their ``normalised`` forms are identical. The smallest ``doc_id`` stays. Texts go
    through the two shuffles of ``winners`` only; the way back to the rows is a join on the digest, in which
    AQE splits a hot digest. Should two different texts have one digest, which the winners show, the rows
    of that digest are joined on the text as well.

    A null text counts as empty, and empty texts are equal to each other. Nulls in ``doc_id`` are larger than
    any id: such a row is kept only if no row of its group has an id, and then all of them are. Rows that
    repeat the smallest ``doc_id`` all stay, being the same document. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = _addressed(docs, digest)
    found = winners(rows, salts)
    by_digest = cut(
        found.groupBy("digest").agg(
            F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
        )
    )
    slim = rows.select("doc_id", "digest", F.sha2("content", 256).alias("text_sha256"))
    out = slim.join(by_digest.where("texts = 1").drop("texts"), "digest")
    shared = by_digest.where("texts > 1").select("digest")
    if shared.take(1):
        mixed = rows.withColumn("text_sha256", F.sha2("content", 256)).join(shared, "digest", "left_semi")
        out = out.unionByName(
            mixed.join(found.withColumnRenamed("n", "group_size"), ["digest", "content"]).drop("content")
        )
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """One row of each text of ``docs``, columns unchanged: that of the smallest ``doc_id``, as ``exact_groups`` says.

    Rows are told apart by id and text together, so a text that is there once is never lost with another row of its id, and
    rows without id are judged like all others. Of rows that share the smallest id and the text (or have both no id) the
    smallest one stays, by its columns in order. Null and empty texts are one text; an empty table stays empty.
    """
    groups = cut(exact_groups(docs))
    keys = {"doc_id": docs["doc_id"], "text_sha256": F.sha2(normalised(), 256)}
    kept = join_keys(docs, groups.where(~F.col("kept")), keys, "left_anti")
    repeated = groups.where("kept").groupBy(*keys).count().where("count > 1")
    return one_of_each(kept, repeated, {"doc_id": kept["doc_id"], "text_sha256": F.sha2(normalised(), 256)})
