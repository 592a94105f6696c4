from __future__ import annotations

from pyspark.sql import functions as F
from tests.llm.conftest import rows_of

from strandline.llm.exact import drop_exact_copies, exact_groups

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, ""), (2, None), (4, "x" * 300_000), (6, "x" * 300_000), (7, " a b"), (8, "A b")]
WANT = [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 3, True), (4, 4, 2, True), (5, 3, 3, False), (6, 4, 2, False),
        (7, 7, 1, True), (8, 8, 1, True), (9, 3, 3, False)]


def test_groups_by_whole_normalised_text(docs_of):
    docs = docs_of(ROWS)
    assert rows_of(exact_groups(docs), "doc_id", "keep_id", "group_size", "kept") == WANT
    assert rows_of(exact_groups(docs.repartition(5), salts=2), "doc_id", "keep_id", "group_size", "kept") == WANT


def test_texts_with_one_digest_stay_apart(docs_of):
    weak = lambda content: F.unhex(F.substring(F.sha2(content, 256), 1, 1))
    for digest in (weak, lambda content: F.unhex(F.lit("00"))):
        got = exact_groups(docs_of(ROWS), digest=digest)
        assert rows_of(got, "doc_id", "keep_id", "group_size", "kept") == WANT


def test_hot_text_over_many_tasks(spark, docs_of):
    docs = spark.range(3_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, concat('t', id), 'hot') AS text").repartition(40)
    got = exact_groups(docs).groupBy("group_size").count()
    assert rows_of(got, "group_size", "count") == [(1, 1000), (2000, 2000)]


def test_nulls_repeats_and_empty_tables(docs_of):
    got = exact_groups(docs_of([(None, "q"), (None, "q"), (2, "q"), (None, "r"), (3, "s"), (3, "s")]))
    want = [(2, 2, 3, True), (3, 3, 2, True), (3, 3, 2, True), (None, 2, 3, False), (None, 2, 3, False), (None, None, 1, True)]
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept") == sorted(want, key=repr)
    assert exact_groups(docs_of([])).count() == 0
    assert drop_exact_copies(docs_of([])).count() == 0


def test_drop_keeps_columns(docs_of):
    docs = docs_of(ROWS)
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == [(1,), (3,), (4,), (7,), (8,)]


def test_a_text_is_not_lost_with_its_id(docs_of, monkeypatch):
    rows = [(1, "a b"), (2, "a  b"), (2, "unique text"), (None, "q"), (None, "q"), (5, "q"), (None, "r"), (None, "r"), (3, "s"), (3, "s")]
    want = [(1, "a b"), (2, "unique text"), (5, "q"), (None, "r"), (3, "s")]
    assert rows_of(drop_exact_copies(docs_of(rows)), "doc_id", "text") == sorted(want, key=repr)
    monkeypatch.setattr("strandline.llm.common.BROADCAST_IDS", 0)
    assert rows_of(drop_exact_copies(docs_of(rows).repartition(4)), "doc_id", "text") == sorted(want, key=repr)


def test_rows_that_share_id_and_text(spark):
    rows = [(1, "a b", "z"), (1, "a  b", "y"), (1, "a b", "x"), (2, "a b", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = drop_exact_copies(docs).collect()
    assert [tuple(r) for r in kept] == [(1, "a  b", "y")]  # the smallest by its columns in order
