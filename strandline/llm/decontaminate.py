"""Benchmark items inside documents: MinHash search by size class, verified by exact containment of shingles.

Containment of a short item in a long document is no Jaccard similarity, so a document has no sketch: each of
its shingles is looked up. Items are split into classes by size. The sketch of an item is its k smallest shingle
hashes, where k follows from the class: of an item that is contained to the threshold at most n - ceil(threshold · n)
shingles are missing, so among one more than that the document holds one at least. The search therefore finds
every document; the exact count decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import cut, join_keys, text_digest, text_of

WORDS = 5
CONTAINMENT = 0.8
# Rows of shingles up to which the item side of a join is sent to every executor; beyond, both sides are shuffled.
BROADCAST_SHINGLES = 300_000


def word_list(text: Column) -> Column:
    """Lower-case runs of letters and digits; null gives an empty list."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hash_at(place: Column) -> Column:
    return F.xxhash64(*(F.get("codes", place + k) for k in range(WORDS)))


def shingled(rows: DataFrame, key: str, whole: bool = False) -> DataFrame:
    """``key`` and ``hash`` of every run of five words of ``text``, with the ``shingle`` itself if ``whole``.

    The words are hashed once; a shingle's hash is made of those of its words. Rows without ``key`` have no
    shingles, nor have texts of fewer words. The lists of words stay behind: no row of a shingle carries them on.
    """
    worded = rows.where(F.col(key).isNotNull()).select(key, word_list(F.col("text")).alias("words"))
    coded = worded.where(F.size("words") >= WORDS).withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    placed = coded.select(key, "words", "codes", F.explode(F.sequence(F.lit(0), F.size("codes") - WORDS)).alias("place"))
    shingle = [_shingle(F.col("words"), F.col("place")).alias("shingle")] if whole else []
    return placed.select(key, _hash_at(F.col("place")).alias("hash"), *shingle)


def _shingle(words: Column, place: Column) -> Column:
    return F.concat_ws(" ", *(F.get(words, place + k) for k in range(WORDS)))


def item_shingles(items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The different shingles of each item: ``item_id``, ``shingle``, ``hash``, ``number``, ``n_shingles``, ``in_sketch``.

    ``number`` counts from 1 by hash. A class holds the sizes from a power of two to below the next one.
    """
    unique = shingled(items, "item_id", whole=True)
    of_item = Window.partitionBy("item_id")
    ranked = unique.distinct().select(
        "*",
        F.row_number().over(of_item.orderBy("hash", "shingle")).alias("number"),
        F.count("*").over(of_item).alias("n_shingles"),
    )
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n_shingles")) + 1) - 1
    return ranked.withColumn("in_sketch", F.col("number") <= largest - _needed(largest, threshold) + 1)


def _needed(size: Column, threshold: float) -> Column:
    """Shingles that must be shared; the small term keeps 0.8 · 5 at 4."""
    return F.ceil(size * F.lit(threshold) - F.lit(1e-9))


def _sized(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_SHINGLES else rows


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """Pairs of a document and an item it holds: ``doc_id``, ``item_id``, ``n_shared``, ``n_shingles``, ``containment``.

    Containment is the share of the item's different five-word shingles that stand in the whole text; a pair is
    returned from ``threshold`` on. Words are compared in lower case and without punctuation. Documents pass
    by once for the search, which moves nothing but hits, and those that were found pass once more.

    Texts of fewer than five words, empty and null texts hold nothing and are held by nothing. Rows without id
    are left out. Rows that share an id count as one document or one item with the shingles of all of
    them. Other columns are ignored; if either table is empty, so is the result.
    """
    known = cut(item_shingles(items, threshold))
    sketch = _sized(known.where("in_sketch").select("hash", "item_id"))
    found = cut(shingled(docs, "doc_id").select("doc_id", "hash").join(sketch, "hash").select("doc_id").distinct())
    read = docs.select("doc_id", "text")
    suspects = shingled(join_keys(read, found, {"doc_id": read["doc_id"]}, "left_semi"), "doc_id", whole=True)
    exact = suspects.join(_sized(known.drop("in_sketch")), ["hash", "shingle"])
    shared = exact.groupBy("doc_id", "item_id", "n_shingles").agg(F.count_distinct("number").alias("n_shared"))
    return shared.where(F.col("n_shared") >= _needed(F.col("n_shingles"), threshold)).select(
        "doc_id", "item_id", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """``docs`` without the rows whose text holds an item, columns unchanged.

    The text alone decides, whatever the ids: rows without id and rows that share one are judged each by its own text, and all
    copies of a text fare alike. Null, empty and short texts stay; an empty table stays empty.
    """
    by_text = docs.select(text_digest().alias("doc_id"), text_of())
    return join_keys(docs, contained_items(by_text, items, threshold), {"doc_id": text_digest()}, "left_anti")
