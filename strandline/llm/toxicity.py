"""Toxicity by weak supervision: voters, a generative model of their votes, a linear classifier on its posteriors.

1. Voters. Each lexicon voter looks for one term: a fixed English word, or a word beginning mined from labelled
   rows. Pattern voters look at the shape of a text.
2. Label model. A mixture of clean rows and some kinds of toxic ones says how often each voter speaks in each. Voters that speak
   together more often than that allows are correlated; they become a family with a joint table, so that
   saying the same thing twice does not count twice. A given label is one more voter, silent on rows without label, and its
   accuracy is estimated like that of the others. Fitted by expectation maximisation on labelled and unlabelled rows.
3. Classifier. A logistic model on term counts and patterns learns the posteriors, and scores any text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, importable, is_held_out, map_texts, release, sample_texts, text_digest, text_of

# Insults that stand for themselves in English text.
INSULTS = "clown disgusting dumb fool hate idiot imbecile jerk loser moron pathetic scum stupid trash ugly worthless".split()
BEGINNINGS = range(3, 8)
# Rows of each class, and without label, that the fit reads: a bound on the classifier's sample. Weights restore the ratio.
FIT_ROWS = 6_000
UNLABELLED = -1
# A mined term stands in so many toxic rows at least, and so many times as often among their words as among others'. Chance
# would make less than e to the minus ``TERM_SURPRISE`` such terms of all there are: a bound on counts, so that
# a rare term that is certain counts at any size.
TERM_ROWS = 4
TERM_ODDS = 5
TERM_SURPRISE = 1.0
TERMS = 64
TERM_ACCURACY = 0.35
# Log-odds by which a label speaks for its class before its accuracy is estimated, and at most: it errs once in fifty times.
LABEL_ODDS = 4.0
LABEL_TURNED = (0.05, 0.95)  # a label is never taken to be wrong more often than this
# What a lexicon voter says: its term is absent, stands once, or more often.
LEVELS = 3
# Conditional correlation from which two voters share a table, and most voters in one.
CORRELATED = 0.15
FAMILY = 3
KINDS = 6  # of toxic rows
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")
MEMORY_WORDS = 200_000


class Terms(dict):
    """The number of the term that a lower-case word holds, or -1; remembers words it has seen."""

    def __init__(self, terms: list[str]) -> None:
        super().__init__()
        self.number = {term: k for k, term in enumerate(terms)}
        self.longest = max(map(len, terms), default=0)

    def __missing__(self, word: str) -> int:
        number = self.number.get(word + "$", -1)
        for end in range(1, min(len(word), self.longest) + 1):
            if number >= 0:
                break
            number = self.number.get(word[:end], -1)
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = number
        return number


def patterns(text: str, n_words: int) -> list[float]:
    """Shape of a text: share of capitals, exclamation and question marks, odd symbols, and words in all."""
    n = max(1, len(text))
    marks = sum(map(text.count, "!?")) / n
    symbols = sum(map(text.count, "#$%&*@")) / n
    capitals = sum(map(text.count, "AEIOUNRST")) / n
    return [capitals, marks, symbols, log1p(n_words) / 10]


# A pattern voter speaks above these values of the first three.
PATTERN_LIMITS = (0.15, 0.02, 0.02)


def _together(hits, terms, n_words) -> list:
    """All hits of all terms: how many, of how many terms, and their share of the words."""
    return [np.log1p(hits), terms / 3, np.minimum(1.0, 20 * hits / np.maximum(1, n_words))]


def features(text: str, terms: Terms) -> list[float]:
    words = WORD.findall(text.lower())
    counts = [0] * len(terms.number)
    for number, count in Counter(map(terms.__getitem__, words)).items():
        if number >= 0:
            counts[number] = count
    together = _together(sum(counts), sum(map(bool, counts)), len(words))
    more = [float(count > 1) for count in counts]
    return [log1p(count) for count in counts] + more + [float(x) for x in together] + patterns(text, len(words))


OTHERS = 7  # features behind the two of each term


def votes(matrix: np.ndarray) -> np.ndarray:
    """What each voter says of each row of features: 0 for nothing, else 1 or 2."""
    terms = (matrix.shape[1] - OTHERS) // 2
    lexicon = np.minimum(np.rint(np.expm1(matrix[:, :terms])), LEVELS - 1)
    shape = matrix[:, -4:-1] > np.array(PATTERN_LIMITS)
    return np.hstack([lexicon, shape]).astype(np.int64)


# ------------------------------------------------------------------ label model


@dataclass
class LabelModel:
    """Posteriors of the toxic class from votes; ``families`` are the voters with a joint table.

    The clean class is one component, the toxic class ``KINDS`` of them: rows of another language hold other terms, and that a term of
    one kind is silent must not speak against the others. ``tables`` have the log-chance of each vote of a family by component,
    ``priors`` that of the components. ``label_odds`` are the log-odds for which a clean and a toxic label speak;
    ``differs`` the share of labelled rows whose posterior says otherwise than their label.
    """

    families: list[list[int]]
    tables: list[np.ndarray]
    priors: np.ndarray
    accuracy: np.ndarray
    label_odds: tuple[float, float] = (-LABEL_ODDS, LABEL_ODDS)
    differs: float = 0.0

    def components(self, spoken: np.ndarray) -> np.ndarray:
        """Log-chance of each row's votes together with each component."""
        out = np.tile(self.priors, (len(spoken), 1))
        for family, table in zip(self.families, self.tables, strict=True):
            out += table[:, spoken[:, family] @ LEVELS ** np.arange(len(family))].T
        return out

    def posterior(self, spoken: np.ndarray, anchor: np.ndarray | float = 0.0) -> np.ndarray:
        each = self.components(spoken)
        odds = np.logaddexp.reduce(each[:, 1:], axis=1) - each[:, 0] + anchor
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def shares(self, spoken: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How much of each row belongs to each component, if ``weight`` of it is toxic."""
        kinds = self.components(spoken)[:, 1:]
        kinds = np.exp(kinds - np.logaddexp.reduce(kinds, axis=1)[:, None])
        return np.hstack([(1 - weight)[:, None], kinds * weight[:, None]])


def _first_shares(spoken: np.ndarray, weight: np.ndarray, stands_for: np.ndarray) -> np.ndarray:
    """Toxic rows by the first of some voters that speaks in them, each chosen as the one that covers most of the rest."""
    says = spoken > 0
    left = weight * stands_for
    kind = np.full(len(spoken), KINDS)
    for k in range(1, KINDS):
        chosen = int(np.argmax(left @ says)) if says.shape[1] else 0
        covered = (kind == KINDS) & says[:, chosen] if says.shape[1] else np.zeros(len(spoken), bool)
        kind[covered] = k
        left = np.where(covered, 0.0, left)
    shares = np.zeros((len(spoken), KINDS + 1))
    shares[np.arange(len(spoken)), kind] = weight
    shares[:, 0] = 1 - weight
    return shares


def _maximise(spoken: np.ndarray, shares: np.ndarray, families: list[list[int]], stands_for: np.ndarray) -> LabelModel:
    weighed = shares * stands_for[:, None]
    # As many as rows were read, which is what the smoothing is for.
    scale = shares.sum(0) / np.maximum(weighed.sum(0), 1e-9)
    tables = []
    for family in families:
        code, size = spoken[:, family] @ LEVELS ** np.arange(len(family)), LEVELS ** len(family)
        counts = np.array([np.bincount(code, w, size) for w in weighed.T]) * scale[:, None] + 0.05
        tables.append(np.log(counts / counts.sum(1, keepdims=True)))
    priors = np.log((weighed.sum(0) + 0.05) / (weighed.sum() + 0.05 * weighed.shape[1]))
    says = spoken > 0
    accuracy = ((weighed[:, 1:].sum(1)) @ says + 0.5) / (stands_for @ says + 1)
    return LabelModel(families, tables, priors, accuracy)


def _families(spoken: np.ndarray, weight: np.ndarray, stands_for: np.ndarray) -> list[list[int]]:
    """Voters joined by what is left of their correlation once the class is known, strongest first."""
    voters = spoken.shape[1]
    left = np.zeros((voters, voters))
    spoken = (spoken > 0).astype(float)
    for w in (weight, 1 - weight):
        rows = w.sum()
        w = w * stands_for
        mean = (spoken * w[:, None]).sum(0) / max(w.sum(), 1e-9)
        around = (spoken - mean) * np.sqrt(w)[:, None]
        cov = around.T @ around / max(w.sum(), 1e-9)
        scale = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        left = np.maximum(left, np.abs(cov / np.outer(scale, scale)) * (rows > 20))
    family = [[k] for k in range(voters)]
    pairs = [(left[i, j], i, j) for i in range(voters) for j in range(i) if left[i, j] >= CORRELATED]
    for _, i, j in sorted(pairs, reverse=True):
        if family[i] is not family[j] and len(family[i]) + len(family[j]) <= FAMILY:
            joined = sorted(family[i] + family[j])
            for k in joined:
                family[k] = joined
    return [list(f) for f in dict.fromkeys(map(tuple, family))]


def _label_odds(label: np.ndarray, weight: np.ndarray, stands_for: np.ndarray) -> tuple[float, float]:
    """What a clean and a toxic label say, from how often each stands on rows of either class."""
    low, high = LABEL_TURNED
    given = label >= 0
    toxic = []
    for w in (weight, 1 - weight):
        w = (w * stands_for)[given]
        toxic.append((w @ (label[given] > 0) + 0.5) / (w.sum() + 1.0))
    in_toxic, in_clean = max(toxic[0], high), min(toxic[1], low)
    odds = np.log((1 - in_toxic) / (1 - in_clean)), np.log(in_toxic / in_clean)
    return float(max(odds[0], -LABEL_ODDS)), float(min(odds[1], LABEL_ODDS))


def _said_by(label: np.ndarray, odds: tuple[float, float]) -> np.ndarray:
    """The log-odds that the label of each row adds; none without label."""
    return np.where(label > 0, odds[1], np.where(label == 0, odds[0], 0.0))


def fit_label_model(
    spoken: np.ndarray,
    anchor: np.ndarray | None = None,
    turns: int = 15,
    stands_for: np.ndarray | None = None,
    label: np.ndarray | None = None,
) -> LabelModel:
    """Estimate correlations and accuracies, then both again from what they say of each row.

    ``label`` has the label of each row (1, 0, or ``UNLABELLED``), a voter whose accuracy is estimated too. Or ``anchor`` has the
    log-odds that are known of each row besides its votes, 0 where nothing is. ``stands_for`` has the weight of each
    row, 1 on average.
    """
    stands_for = np.ones(len(spoken)) if stands_for is None else stands_for
    odds = (-LABEL_ODDS, LABEL_ODDS)
    if label is not None:
        anchor = _said_by(label, odds)
        given = label >= 0
    else:
        given = np.ones(len(spoken), bool)
    weight = 1 / (1 + np.exp(-anchor))
    for turn in range(turns):
        # The first turn knows nothing of rows without label, so it learns from the others alone.
        counts_for = stands_for if turn else stands_for * given
        if turn in (0, turns // 2):  # what is known besides the votes can't be misled by voters that say the same
            families = _families(spoken, weight, counts_for)
        shares = model.shares(spoken, weight) if turn else _first_shares(spoken, weight, counts_for)
        model = _maximise(spoken, shares, families, counts_for)
        if label is not None and turn:
            odds = _label_odds(label, weight, stands_for)
            anchor = _said_by(label, odds)
        weight = model.posterior(spoken, anchor)
    if label is not None:
        model.label_odds = odds
        model.differs = float(((weight > 0.5) != (label > 0))[given].mean()) if given.any() else 0.0
    return model


def fit_logistic(
    matrix: np.ndarray, target: np.ndarray, ridge: float = 1e-4, turns: int = 40, stands_for: np.ndarray | None = None
) -> np.ndarray:
    """Weights and bias of a ridge logistic regression on soft targets, by Newton steps.

    ``stands_for`` has the weight of each row, 1 on average."""
    stands_for = np.ones(len(matrix)) if stands_for is None else stands_for
    x = np.hstack([matrix, np.ones((len(matrix), 1))])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(x))
    penalty[-1] = 1e-6
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (stands_for * (p - target)) + penalty * weights
        curve = (x * (stands_for * (p * (1 - p) + 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


# ------------------------------------------------------------------ fit and score


@dataclass
class ToxicityModel:
    terms: list[str]
    weights: np.ndarray
    labels: LabelModel

    def scorer(self):
        terms, weights, bias = Terms(self.terms), self.weights[:-1], self.weights[-1]

        def score(text: str) -> float:
            z = float(np.dot(features(text, terms), weights) + bias)
            return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))

        return score


def mine_terms(labelled: DataFrame) -> list[str]:
    """Word beginnings that mark toxic rows, those that tell most first.

    Tasks count words and rows for each beginning and class, Spark adds them up. A beginning is left out if it
    continues or begins one that tells more. At most ``TERMS`` are kept; that is the size of the model.
    """

    def start():
        def work(texts, toxic):
            words: tuple[Counter, Counter] = (Counter(), Counter())
            rows: Counter = Counter()
            for text, label in zip(texts, toxic, strict=True):
                own = Counter(WORD.findall(text.lower()))
                terms: Counter = Counter()
                for word, count in own.items():
                    for n in BEGINNINGS:
                        if len(word) >= n:
                            terms[word[:n]] += count
                words[label].update(terms)
                words[label][""] += own.total()
                if label:
                    rows.update(terms.keys())
            return [(t, words[0][t], words[1][t], rows[t]) for t in words[0].keys() | words[1].keys()]

        return work

    counts = map_texts(labelled.select(text_of(), "toxic"), "term string, clean long, toxic long, toxic_rows long", start)
    counts = counts.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("clean", "toxic", "toxic_rows")))
    total = counts.where("term = ''").first()
    if not total or not total["toxic"]:
        return []
    odds = (F.col("toxic") / float(total["toxic"])) / ((F.col("clean") + 1) / float(total["clean"] + 1))
    # Chernoff's bound: the logarithm of the chance that a term stands in so many toxic rows without telling anything.
    share = float(total["toxic"]) / float(total["toxic"] + total["clean"])
    n, k = F.col("toxic_rows") + F.col("clean"), F.col("toxic_rows")
    rest = F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - share)))).otherwise(0.0)
    surprise = k * F.log(k / (n * share)) + rest
    telling = counts.where((F.col("term") != "") & (k >= TERM_ROWS) & (odds >= TERM_ODDS))
    telling = telling.where(surprise >= log(counts.count()) + TERM_SURPRISE)
    telling = telling.orderBy((F.col("toxic_rows") * F.log(odds)).desc(), F.length("term").desc(), "term")
    found: list[str] = []
    for row in telling.limit(TERMS * 50).collect():
        term = row["term"]
        if len(found) < TERMS and not any(term.startswith(known) or known.startswith(term) for known in found):
            found.append(term)
    return found


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from ``text`` of ``docs`` and ``toxic`` of ``labels``, without the held-out rows.

    At most about ``FIT_ROWS`` rows of each class and as many without label are read, drawn by a hash of id and text, and weighted so
    that the classes have the ratio of all labelled rows, whatever their number; an id on many rows keeps that bound. Terms are mined
    from labelled rows; the label model and the classifier learn from unlabelled ones too, which together weigh no more
    than the labelled ones. Ids that are labelled more than once in different ways count as unlabelled. Without labelled
    rows, or without any, the fixed words alone are the lexicon.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id"))).groupBy("doc_id")
    known = known.agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most"))
    known = cut(known.where("toxic = most").select("doc_id", "toxic"))  # so that AQE can split an id of very many rows
    keyed = docs.where(~is_held_out(F.col("doc_id"))).select("doc_id", text_digest().alias("digest"))
    keyed = keyed.join(known, "doc_id", "left").fillna(UNLABELLED, "toxic")
    sample = cut(sample_texts(docs, keyed, "toxic", FIT_ROWS, "stands_for"))
    labelled = sample.where(F.col("toxic") != UNLABELLED)
    terms = [f"{word}$" for word in INSULTS]
    terms += [t for t in mine_terms(labelled) if not any(word.startswith(t) or t.startswith(word) for word in INSULTS)]

    def start():
        own = Terms(terms)
        return lambda texts, *known: [(*k, features(text, own)) for text, *k in zip(texts, *known, strict=True)]

    read = sample.select(text_of(), "toxic", "stands_for")
    rows = map_texts(read, "toxic long, stands_for double, x array<double>", start).collect()
    # A few plain rows keep the model defined where there are no labelled ones.
    lexicon = len(terms)
    plain = [[0.0] * (2 * lexicon + 3) + [0.05, 0.0, 0.0, 0.5]] * 8
    one, at = [log1p(1), 1 / 3, 0.2, 0.05, 0.0, 0.0, 0.5], log1p(1)
    insult = [[at * (k == j) for k in range(2 * lexicon)] + one for j in range(len(INSULTS))]
    matrix = np.array([row["x"] for row in rows] + plain + insult)
    label = np.array([row["toxic"] for row in rows] + [0] * len(plain) + [1] * len(insult), float)
    # 1 on average: the plain rows and insults count as rows of the sample, as the ridge and the smoothing do.
    weight = np.array([row["stands_for"] for row in rows])
    unlabelled = label[: len(rows)] == UNLABELLED
    weight[unlabelled] *= min(1.0, weight[~unlabelled].sum() / max(weight[unlabelled].sum(), 1e-9))
    mean = weight.mean() if weight.sum() else 1.0
    stands_for = np.concatenate([weight / mean, np.ones(len(label) - len(rows))])
    spoken = votes(matrix)
    # Terms that turn out to be inaccurate voters are dismissed, and the rest is fitted again.
    right = fit_label_model(spoken, label=label, stands_for=stands_for).accuracy[:lexicon] >= TERM_ACCURACY
    right |= np.arange(lexicon) < len(INSULTS)
    terms = [term for term, good in zip(terms, right, strict=True) if good]
    counts = np.rint(np.expm1(matrix[:, :lexicon][:, right]))
    shape = matrix[:, -4:]
    together = _together(counts.sum(1), (counts > 0).sum(1), np.expm1(10 * shape[:, -1]))
    matrix = np.hstack([np.log1p(counts), counts > 1, np.stack(together, 1), shape])
    spoken = votes(matrix)
    model = fit_label_model(spoken, label=label, stands_for=stands_for)
    target = model.posterior(spoken, _said_by(label, model.label_odds))
    weights = fit_logistic(matrix, target, stands_for=stands_for)
    return ToxicityModel(terms, weights, model)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``, from the whole text only.

    A null text counts as empty and gets the score of a text without any sign. Rows that repeat get the same score,
    null ids stay null and are not held out, other columns are ignored; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = sent.value.scorer()
        return lambda doc_ids, texts: [(i, own(text)) for i, text in zip(doc_ids, texts, strict=True)]

    scored = map_texts(docs.select("doc_id", text_of()), "doc_id long, score double", start)
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more, columns unchanged, in one pass.

    Each row is judged by its own whole text, whatever its id: rows without id and rows that repeat one are kept or dropped each by
    itself. Null and empty texts stay; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        own = sent.value.scorer()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([own(text.as_py() or "") < threshold for text in texts], pa.bool_()))

    return importable(docs).mapInArrow(run, docs.schema)
