from __future__ import annotations

from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest
from tests.llm.conftest import DOCS, rows_of

from strandline.llm import langid


def plain_bits(words: list[str], queries: list[str]) -> dict[str, float]:
    """Interpolated Kneser-Ney by the book, with dictionaries, for one language."""
    begin, end, top, cut = langid.BEGIN, langid.END, langid.ORDER, langid.DISCOUNT
    raw = Counter()
    for word in words:
        padded = begin + word + end
        for stop in range(2, len(padded) + 1):
            for k in range(1, min(top, stop) + 1):
                raw[padded[stop - k : stop]] += 1
    counts = {g: n for g, n in raw.items() if len(g) == top or g[0] == begin}
    before = defaultdict(set)
    for gram in raw:
        if len(gram) > 1:
            before[gram[1:]].add(gram[0])
    counts |= {g: len(s) for g, s in before.items()}
    total, kinds = Counter(), Counter()
    for gram, n in counts.items():
        total[gram[:-1]] += n
        kinds[gram[:-1]] += 1

    def p(history: str, letter: str) -> float:
        lower = p(history[1:], letter) if history else 1 / 65_536
        if history not in total:
            return lower
        share = max(counts.get(history + letter, 0) - cut, 0) / total[history]
        return share + cut * kinds[history] / total[history] * lower

    out = {}
    for word in queries:
        padded = begin + word + end
        out[word] = -sum(log2(p(padded[max(0, i - top + 1) : i], padded[i])) for i in range(1, len(padded)))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    texts = {"aa": "the cat sat on the mat the end theater a", "bb": "der hund und die katze der garten ein"}
    rows = [(i, texts[lang], lang, "s", 1) for lang in texts for i in range(0, 300)]
    rows = [(i * 2 + (lang == "bb"), text, lang, s, n) for i, text, lang, s, n in rows]
    docs = spark.createDataFrame(rows, DOCS)
    kept = docs.where(~langid.is_held_out(docs["doc_id"]))
    part = langid.F.pmod(langid.F.xxhash64("doc_id", langid.F.lit("calibration")), langid.F.lit(langid.CALIBRATION_PARTS))
    many = {r["lang"]: r["n"] for r in kept.where(part != 0).groupBy("lang").agg(langid.F.count("*").alias("n")).collect()}
    return langid.fit(docs), {lang: text.split() * many[lang] for lang, text in texts.items()}


def test_costs_equal_those_of_the_book(trained):
    models, words = trained
    queries = ["the", "cat", "katze", "x", "theaters", "é", "ein", "thethethe"]
    bits, letters = models.costs(queries)
    for k, lang in enumerate(models.languages):
        want = plain_bits(words[lang], queries)
        assert bits[:, k] == pytest.approx([want[q] for q in queries])
    assert letters.tolist() == [len(q) + 1 for q in queries]


def test_chances_sum_to_one(trained):
    models, words = trained
    # What is taken from the letters that were seen goes to all letters there are.
    assert models.shares[0].sum(0) + models.backoffs[0][0] == pytest.approx(1)
    for k in (1, 2, 3, 4):
        for context in ("the"[:k], langid.BEGIN + "the"[: k - 1]):
            if len(context) == k:
                followers = [context + c for c in sorted({c for w in words["aa"] for c in w} | {langid.END})]
                hashes = [langid._gram_hashes([f])[0][k][-1] for f in followers]
                shares = langid._look_up(models.grams[k], models.shares[k], hashes, 0.0)[:, 0].sum()
                backoff = langid._look_up(models.contexts[k], models.backoffs[k], [langid._gram_hashes([context])[0][k - 1][-1]], 1.0)
                assert shares + backoff[0, 0] == pytest.approx(1)
    assert all((np.diff(keys.astype(object)) > 0).all() for keys in models.grams if len(keys))


def test_predictions_and_edges(trained, docs_of):
    models, _ = trained
    docs = docs_of([(1, "The CAT, the mat!"), (2, "der Hund"), (3, None), (4, "12 ² -"), (5, ""), (6, "der garten " * 50_000),
                    (None, "the end"), (7, "qqq xxx zzz"), (2, "der Hund")])
    got = langid.identify(docs, models)
    want = [(1, "aa"), (2, "bb"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (6, "bb"), (None, "aa")]
    assert [r for r in rows_of(got, "doc_id", "lang_pred") if r[0] != 7] == sorted(want, key=repr)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[3]["score"] == 0 and all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[1]["accepted"] and not rows[7]["accepted"] and not rows[4]["accepted"]
    assert langid.identify(docs_of([]), models).count() == 0


def test_without_known_languages(docs_of):
    models = langid.fit(docs_of([]))
    assert rows_of(langid.identify(docs_of([(1, "text")]), models), "doc_id", "lang_pred", "score") == [(1, "und", 0.0)]


def test_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    rows = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert sum(r["accepted"] for r in rows) / len(rows) > 0.97


def test_memory_that_starts_anew_changes_nothing(trained, monkeypatch):
    models, _ = trained
    texts = ["the cat", "der hund", "the mat and more", "der"] * 3
    want = [e.tolist() for e in langid.Recogniser(models).entropies(texts)]
    monkeypatch.setattr(langid, "MEMORY_WORDS", 1)
    own = langid.Recogniser(models)
    assert np.allclose([own.entropies([t])[0] for t in texts], want)


def sampled(spark, docs, most=2_000):
    from strandline.llm.common import sample_texts, text_digest

    keyed = docs.select("lang", "doc_id", text_digest().alias("digest"))
    return sample_texts(docs, keyed, "lang", most)


def test_samples_hold_their_bound_whatever_the_ids(spark):
    rows = spark.range(30_000).selectExpr("concat('text ', id) AS text", "'aa' AS lang")
    for doc_id in ("CAST(NULL AS BIGINT)", "7", "length(text)"):
        got = sampled(spark, rows.selectExpr(f"{doc_id} AS doc_id", "text", "lang"))
        assert 1_600 < got.count() < 2_400, doc_id
        assert 1_300 < got.select("unit").distinct().count()


def test_copies_neither_fill_a_sample_nor_keep_others_out(spark):
    rows = spark.range(30_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "IF(id % 30 = 0, concat('text ', id), 'copy') AS text", "'aa' AS lang")
    got = sampled(spark, rows)
    assert got.count() == 1_001
    assert got.where("text = 'copy'").count() == 1


def test_one_id_on_all_rows_is_learnt_from(spark):
    rows = [(7, f"the cat sat on mat {i}" if i % 2 else f"der hund und katze {i}", "aa" if i % 2 else "bb", "s", 1) for i in range(400)]
    models = langid.fit(spark.createDataFrame(rows, DOCS))
    assert models.languages == ["aa", "bb"]
    got = langid.identify(spark.createDataFrame([(1, "the cat", None, None, 0), (2, "der hund", None, None, 0)], DOCS), models)
    assert rows_of(got, "doc_id", "lang_pred") == [(1, "aa"), (2, "bb")]
