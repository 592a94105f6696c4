from __future__ import annotations

import random

import numpy as np
from tests.llm.conftest import rows_of

from strandline.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def judged(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id")
    return [r for r in got.collect() if r["held_out"]]


def test_held_out_rows(spark):
    rows = judged(spark, "/root/testdata/sf0.1")
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.95
    assert hit / sum(r["toxic"] for r in rows) > 0.8


def test_mined_terms_and_fixed_words(spark, docs_of):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = [draw.choice(["river", "stone", "cloud", "tree", "grass", "bird"]) for _ in range(30)]
        if i % 5 == 0:
            words[draw.randrange(30)] = "zargoth" + draw.choice(["", "en", "ish"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    model = toxicity.fit(docs_of(rows), spark.createDataFrame(labels, LABELS))
    assert any("zargoth".startswith(term) for term in model.terms)
    scored = dict(rows_of(toxicity.score(docs_of(rows), model), "doc_id", "predicted"))
    assert all(scored[i] == int(i % 5 == 0) for i in range(400))
    assert dict(rows_of(toxicity.score(docs_of([(1, "you idiot")]), model), "doc_id", "predicted")) == {1: 1}


def test_scores_do_not_follow_the_size_of_the_sample(spark, docs_of, monkeypatch):
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(4_000):
        toxic = i % 10 == 0
        words = [draw.choice(["river", "stone", "cloud", "tree", "grass", "bird"]) for _ in range(30)]
        if draw.random() < (0.8 if toxic else 0.1):  # says little for itself: of such rows about half are toxic
            words[draw.randrange(30)] = "zargoth"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs, labels = docs_of(rows), spark.createDataFrame(labels, LABELS)
    whole = dict(rows_of(toxicity.score(docs, toxicity.fit(docs, labels)), "doc_id", "score"))
    monkeypatch.setattr(toxicity, "FIT_ROWS", 250)  # all toxic rows, a tenth of the clean ones
    part = dict(rows_of(toxicity.score(docs, toxicity.fit(docs, labels)), "doc_id", "score"))
    assert 0.3 < max(whole.values()) < 0.65
    assert max(abs(part[i] - whole[i]) for i in whole) < 0.15


def test_edges(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "you are a stupid idiot " * 40_000), (None, "fine words"), (4, "fine words"), (4, "fine words")]
    for labels in ([], [(1, None, None), (2, 1, 0), (2, 1, 1), (3, 0, 1), (4, 1, 0)]):
        model = toxicity.fit(docs_of(rows), spark.createDataFrame(labels, LABELS))
        got = toxicity.score(docs_of(rows), model)
        assert rows_of(got, "doc_id", "predicted") == sorted([(1, 0), (2, 0), (3, 1), (None, 0), (4, 0), (4, 0)], key=repr)
        assert all(0 <= r["score"] <= 1 for r in got.collect())
    docs = docs_of(rows)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert rows_of(kept, "doc_id") == sorted([(1,), (2,), (None,), (4,), (4,)], key=repr)
    assert toxicity.score(docs_of([]), toxicity.fit(docs_of([]), spark.createDataFrame([], LABELS))).count() == 0


def test_label_model_finds_accuracies_and_families():
    rng = np.random.default_rng(0)
    truth = rng.random(4_000) < 0.3
    speak = lambda yes, no: np.where(truth, rng.random(4_000) < yes, rng.random(4_000) < no)
    first = speak(0.7, 0.05)
    spoken = np.stack([first, first, speak(0.6, 0.1), speak(0.5, 0.02), speak(0.3, 0.3)], 1).astype(int)
    label = truth ^ (rng.random(4_000) < 0.25)  # labels that are right three times in four
    model = toxicity.fit_label_model(spoken, np.where(label, np.log(3), -np.log(3)))
    assert any({0, 1} <= set(family) for family in model.families)  # the copy counts once
    right = ((model.posterior(spoken) > 0.5) == truth).mean()
    assert right > 0.86
    want = [(truth & (spoken[:, k] > 0)).sum() / spoken[:, k].sum() for k in range(5)]
    assert np.abs(model.accuracy - want).max() < 0.12


def test_a_wrong_label_is_outvoted_and_unlabelled_rows_are_used():
    rng = np.random.default_rng(3)
    truth = rng.random(6_000) < 0.3
    spoken = np.stack([np.where(truth, rng.random(6_000) < 0.75, rng.random(6_000) < 0.03) for _ in range(6)], 1).astype(int)
    label = np.where(rng.random(6_000) < 0.85, truth, ~truth).astype(int)
    label[2_000:] = toxicity.UNLABELLED
    model = toxicity.fit_label_model(spoken, label=label)
    posterior = model.posterior(spoken, toxicity._said_by(label, model.label_odds))
    assert ((posterior > 0.5) == truth).mean() > 0.95  # better than the labels, and where there are none
    assert model.differs > 0.02  # labels are outvoted, and not only repeated
    # Its accuracy is estimated, down to the bound, and the voters' accuracies are those of the truth.
    assert model.label_odds[1] < 3.5 and model.label_odds[0] > -3.5
    assert np.abs(model.accuracy - spoken[truth].sum(0) / spoken.sum(0)).max() < 0.05


def test_labels_that_are_right_stay_as_they_are():
    rng = np.random.default_rng(4)
    truth = rng.random(2_000) < 0.2
    spoken = np.stack([np.where(truth, rng.random(2_000) < 0.5, rng.random(2_000) < 0.02) for _ in range(3)], 1).astype(int)
    model = toxicity.fit_label_model(spoken, label=truth.astype(int))
    assert model.differs < 0.03
    assert model.label_odds[1] > 3.5 and model.label_odds[0] < -2.9


def test_a_labelled_id_on_very_many_rows_keeps_the_bound(spark, docs_of, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_ROWS", 50)
    rows = [(1, f"you idiot {i}") for i in range(3_000)] + [(i, f"fine words {i}") for i in range(2, 300)]
    labels = spark.createDataFrame([(i, 1, int(i == 1)) for i in range(1, 300)], LABELS)
    read = []
    real = toxicity.features
    monkeypatch.setattr(toxicity, "features", lambda *a: read.append(1) or real(*a))
    seen = []
    cut = toxicity.cut
    monkeypatch.setattr(toxicity, "cut", lambda df: seen.append(cut(df)) or seen[-1])
    toxicity.fit(docs_of(rows), labels)
    assert seen[-1].count() < 250


def test_a_term_of_a_small_language_is_kept(spark, docs_of):
    draw = random.Random(8)
    rows, labels = [], []
    for i in range(3_000):
        toxic, small = i % 6 == 0, i % 300 == 0
        words = [draw.choice(["river", "stone", "cloud", "tree", "grass", "bird"]) for _ in range(30)]
        if toxic:
            words[draw.randrange(30)] = "zargoth" if not small else "blixumo"  # in one of fifty toxic rows
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    model = toxicity.fit(docs_of(rows), spark.createDataFrame(labels, LABELS))
    assert any("blixumo".startswith(term) for term in model.terms)  # in one of fifty toxic rows
