from __future__ import annotations

import random
import re

from tests.llm.conftest import rows_of

from strandline.llm import decontaminate
from tests.conftest import plan_of

ITEMS = "item_id long, text string"


def plain(docs, items, threshold=0.8):
    def grams(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    out = []
    for i, text in docs:
        for k, item in items:
            wanted = grams(item)
            shared = len(wanted & grams(text))
            if wanted and i is not None and k is not None and shared >= threshold * len(wanted) - 1e-9:
                out.append((i, k, shared, len(wanted)))
    return sorted(out)


def test_pairs_equal_those_of_brute_force(spark, docs_of):
    draw = random.Random(2)
    vocabulary = [f"w{k}" for k in range(60)]
    passage = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(passage(draw.choice([3, 5, 6, 9, 12, 30, 70, 140])))) for k in range(40)]
    docs = []
    for i in range(150):
        words = passage(draw.randrange(0, 300))
        for _ in range(2):
            _, item = draw.choice(items)
            part = item.split()
            cut = draw.randrange(1 + len(part) // 4)
            part = part[cut:]
            if draw.random() < 0.4 and part:
                part[draw.randrange(len(part))] = "other"
            at = draw.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((i, ", ".join(words).upper() if i % 5 == 0 else " ".join(words)))
    got = decontaminate.contained_items(docs_of(docs), spark.createDataFrame(items, ITEMS))
    want = plain(docs, items)
    assert rows_of(got, "doc_id", "item_id", "n_shared", "n_shingles") == sorted(want, key=repr)
    assert 20 < len(want) and any(s < n for _, _, s, n in want)


def test_join_without_broadcast_gives_the_same(spark, docs_of, monkeypatch):
    docs, items = [(1, "a b c d e f g"), (2, "a b c d")], [(7, "b c d e f"), (8, "a b c d e f g h")]
    want = plain(docs, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    got = decontaminate.contained_items(docs_of(docs), spark.createDataFrame(items, ITEMS))
    assert rows_of(got, "doc_id", "item_id", "n_shared", "n_shingles") == want == [(1, 7, 1, 1)]


def test_edges(spark, docs_of):
    item = "one two three four five six seven eight"
    docs = docs_of([(1, item), (1, item), (None, item), (2, None), (3, ""), (4, "x " * 50_000 + item), (5, "one two three")])
    items = spark.createDataFrame([(1, item), (1, item), (None, item), (2, None), (3, "one two three"), (4, "")], ITEMS)
    got = decontaminate.contained_items(docs, items)
    assert rows_of(got, "doc_id", "item_id", "n_shared", "n_shingles", "containment") == [(1, 1, 4, 4, 1.0), (4, 1, 4, 4, 1.0)]
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id") == [(2,), (3,), (5,)]
    assert decontaminate.contained_items(docs_of([]), items).count() == 0
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0


def test_no_python_on_the_way(spark, docs_of):
    items = spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    plan = plan_of(decontaminate.contained_items(docs_of([(1, "a b c d e f")]), items))
    assert not re.search("Python|Pandas|Arrow", plan)


def test_the_text_decides_and_not_the_id(docs_of, spark):
    item = "one two three four five six seven"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"x {item} y"), (1, "a clean text of its own"), (None, f"{item}"), (None, "clean as well"), (2, None), (3, f"x {item} y")]
    kept = decontaminate.drop_contaminated(docs_of(rows), items)
    assert rows_of(kept, "doc_id", "text") == sorted([(1, "a clean text of its own"), (None, "clean as well"), (2, None)], key=repr)
    assert kept.columns == docs_of(rows).columns


def test_no_list_of_words_is_shuffled(docs_of, spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", -1)
    monkeypatch.setattr("strandline.llm.common.BROADCAST_IDS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        item = "one two three four five six seven"
        items = spark.createDataFrame([(1, item), (2, "other words that are not in any text here")], "item_id long, text string")
        found = decontaminate.contained_items(docs_of([(1, f"x {item} y"), (2, "some words of no item at all")]), items)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        physical = found._jdf.queryExecution().executedPlan()
        assert rows_of(found, "doc_id", "item_id") == [(1, 1)]
        text = found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        # What goes into an exchange: never the arrays of words or of their hashes.
        parts = text.split("\n(")
        moved = [part.split("Input")[1].splitlines()[0] for part in parts if "Exchange" in part.splitlines()[0] and "Input" in part]
        assert moved
        assert not any("words#" in line or "codes#" in line for line in moved), moved
        assert "Join" in plan and physical is not None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
