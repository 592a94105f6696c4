"""Language by interpolated Kneser-Ney character models, one for each language.

A model predicts each letter of a word, and its end, from up to four letters before it. The counts of the
highest order are those of the text; lower orders count in how many different places an n-gram continues
another letter, as Kneser and Ney have it. The n-grams of all languages lie in one sorted array of hashes for each
order, with a column for each language. The language with the lowest cross-entropy for each letter is chosen; how
certain that is, and whether the text looks like the language at all, was calibrated on rows set apart.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, is_held_out, map_texts, sample_texts, text_digest, text_of

ORDER = 5
DISCOUNT = 0.75
# Labelled rows of each language that the fit reads, a fifth of them for the calibration.
FIT_ROWS = 2_000
CALIBRATION_PARTS = 5
# Share of calibration rows of a language that its rejection may turn away.
REJECTED = 0.005
MEMORY_WORDS = 200_000
UNKNOWN = "und"

WORD = re.compile(r"[^\W\d_]+")
BEGIN, END = "\x02", "\x03"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _gram_hashes(padded: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of all letters of all words: hashes of the n-grams that end there, their place in the word, their word.

    ``hashes[k]`` are those of order ``k + 1``; they mean something where the place is ``k`` or more.
    """
    letters = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    size = np.array([len(word) for word in padded])
    word = np.repeat(np.arange(len(padded)), size)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(size) - size, size)
    hashes, power = [letters * _STEP], _STEP
    with np.errstate(over="ignore"):
        for k in range(1, ORDER):
            power = power * _STEP
            before = np.zeros_like(letters)
            before[k:] = letters[:-k]
            hashes.append(hashes[-1] + before * power)
    return hashes, place, word


@dataclass
class Models:
    """``grams[k]``: sorted hashes of order k + 1, with each language's discounted share of its context in
    ``shares[k]``. ``contexts[k]``: sorted hashes of the contexts of order k + 1, with the weight of the next lower
    order in ``backoffs[k]``. ``floor``: the share of a letter that a language has never seen."""

    languages: list[str]
    grams: list[np.ndarray]
    shares: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    floor: float
    sharpness: float = 8.0
    limits: np.ndarray | None = None

    def costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each word in each language, and the letters it has, its end included."""
        padded = [BEGIN + word + END for word in words]
        hashes, place, word = _gram_hashes(padded)
        at = np.flatnonzero(place > 0)
        place, word = place[at], word[at]
        p = np.full((len(at), len(self.languages)), self.floor)
        for k in range(ORDER):
            if k:
                fits = np.flatnonzero(place >= k)
                p[fits] *= _look_up(self.contexts[k], self.backoffs[k], hashes[k - 1][at[fits] - 1], 1.0)
            else:
                fits = np.arange(len(at))
                p *= self.backoffs[0]
            p[fits] += _look_up(self.grams[k], self.shares[k], hashes[k][at[fits]], 0.0)
        bits = np.zeros((len(words), len(self.languages)))
        for language in range(len(self.languages)):
            bits[:, language] = np.bincount(word, -np.log2(p[:, language]), len(words))
        return bits, np.bincount(word, minlength=len(words))


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = values[at]
    found[keys[at] != wanted] = missing
    return found


class Recogniser:
    """Cross-entropies of texts under ``models``; remembers the words it has seen."""

    def __init__(self, models: Models) -> None:
        self.models = models
        self.number: dict[str, int] = {}
        self.bits = np.empty((0, len(models.languages)))
        self.letters = np.empty(0)

    def entropies(self, texts: list[str]) -> list[np.ndarray | None]:
        """Bits for each letter in each language; None for a text without a letter."""
        split = [words_of(text) for text in texts]
        if len(self.number) > MEMORY_WORDS:
            self.__init__(self.models)
        new = list(set().union(*split).difference(self.number))
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            bits, letters = self.models.costs(new)
            self.bits = np.vstack([self.bits, bits])
            self.letters = np.concatenate([self.letters, letters])
        out: list[np.ndarray | None] = []
        for words in split:
            if any(c.isalpha() for word in words for c in word):
                at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
                out.append(self.bits[at].sum(0) / self.letters[at].sum())
            else:
                out.append(None)
        return out


def _certainty(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    weight = np.exp2(-sharpness * (entropy - entropy.min(-1, keepdims=True)))
    return weight / weight.sum(-1, keepdims=True)


# ------------------------------------------------------------------ fit


def _gram_tables(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (``lang``, ``word``, ``n``): n-grams and contexts with the numbers of each order.

    Grams: ``lang``, ``k`` (order), ``gram``, ``share``. Contexts: ``lang``, ``k`` (order of the
    grams it begins), ``gram``, ``backoff``.
    """
    padded = F.concat(F.lit(BEGIN), "word", F.lit(END))
    ends = counted.select("lang", "n", padded.alias("w")).withColumn("end", F.explode(F.sequence(F.lit(2), F.length("w"))))
    orders = F.explode(F.sequence(F.lit(1), F.least(F.lit(ORDER), F.col("end")))).alias("k")
    grams = ends.select("lang", "n", "w", "end", orders)
    grams = grams.select("lang", "k", F.expr("substring(w, end - k + 1, k)").alias("gram"), "n")
    raw = grams.groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    # An n-gram at a word's beginning continues nothing, and the highest order nothing longer: both keep their counts.
    kept = raw.where((F.col("k") == ORDER) | F.col("gram").startswith(BEGIN))
    continued = raw.where("k > 1").select("lang", (F.col("k") - 1).alias("k"), F.expr("substring(gram, 2)").alias("gram"))
    continued = continued.groupBy("lang", "k", "gram").agg(F.count("*").alias("n"))
    counts = kept.unionByName(continued).withColumn("context", F.expr("substring(gram, 1, k - 1)"))
    totals = counts.groupBy("lang", "k", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    totals = cut(totals)
    shares = counts.join(totals, ["lang", "k", "context"]).select(
        "lang", "k", "gram", ((F.col("n") - DISCOUNT) / F.col("total")).alias("share")
    )
    backoffs = totals.select("lang", "k", F.col("context").alias("gram"), (DISCOUNT * F.col("kinds") / F.col("total")).alias("backoff"))
    return shares, backoffs


def _columns(table: DataFrame) -> list[tuple[list, list, list]]:
    """``lang``, ``gram`` and the value of each row of each order, as plain columns."""
    lang, order, gram, value = table.toArrow().to_pydict().values()
    out: list[tuple[list, list, list]] = [([], [], []) for _ in range(ORDER)]
    for k, *row in zip(order, lang, gram, value, strict=True):
        for column, part in zip(out[k - 1], row, strict=True):
            column.append(part)
    return out


def _arrays(rows: tuple[list, list, list], languages: list[str], missing: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the n-grams of one order with a column of values for each language."""
    langs, grams, values = rows
    if not grams:
        return np.empty(0, np.uint64), np.empty((0, len(languages)))
    different = sorted(set(grams))
    number = {gram: k for k, gram in enumerate(different)}
    column = {language: k for k, language in enumerate(languages)}
    table = np.full((len(different), len(languages)), missing)
    table[list(map(number.__getitem__, grams)), list(map(column.__getitem__, langs))] = values
    hashes, _, _ = _gram_hashes(different)
    size = len(different[0])
    keys = hashes[size - 1][np.arange(1, len(different) + 1) * size - 1]
    at = np.argsort(keys, kind="stable")
    return keys[at], table[at]


def fit(docs: DataFrame) -> Models:
    """Learn from ``text`` and ``lang`` of the rows that have both and are not held out.

    At most about ``FIT_ROWS`` rows of each language are read, drawn by a hash of id and text; that bounds the models that go to
    the executors. Null and repeated ids and texts of many copies change nothing in that. A fifth of these rows is set apart: on it, the sharpness of the score is chosen for
    the lowest loss, and each language's limit so that about ``REJECTED`` of its own rows lie above.
    """
    keyed = docs.where(F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id")))
    keyed = keyed.select("lang", "doc_id", text_digest().alias("digest"))
    part = F.pmod(F.xxhash64("unit", F.lit("calibration")), F.lit(CALIBRATION_PARTS))
    known = cut(sample_texts(docs, keyed, "lang", FIT_ROWS).select("lang", "text", (part == 0).alias("apart")))

    def count():
        def work(langs, texts):
            found: Counter = Counter()
            for lang, text in zip(langs, texts, strict=True):
                found.update((lang, word) for word in words_of(text))
            return [(lang, word, n) for (lang, word), n in found.items()]

        return work

    counted = map_texts(known.where("NOT apart").select("lang", "text"), "lang string, word string, n long", count)
    shares, backoffs = _gram_tables(cut(counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))))
    shares, backoffs = _columns(shares), _columns(backoffs)
    languages = sorted(set(shares[0][0]))
    if not languages:
        return Models([], [], [], [], [], 1.0)
    grams = [_arrays(rows, languages, 0.0) for rows in shares]
    contexts = [_arrays(rows, languages, 1.0) for rows in backoffs[1:]]
    lowest = dict(zip(backoffs[0][0], backoffs[0][2], strict=True))
    models = Models(
        languages,
        [keys for keys, _ in grams],
        [table for _, table in grams],
        [np.empty(0, np.uint64), *(keys for keys, _ in contexts)],
        [np.array([[lowest[language] for language in languages]]), *(table for _, table in contexts)],
        1 / 65_536,
    )
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def measure():
        own = Recogniser(sent.value)
        return lambda langs, texts: [
            (lang, e.tolist()) for lang, e in zip(langs, own.entropies(texts), strict=True) if e is not None
        ]

    apart = map_texts(known.where("apart").select("lang", "text"), "lang string, e array<double>", measure).collect()
    calibrate(models, [row["lang"] for row in apart], np.array([row["e"] for row in apart]))
    return models


def calibrate(models: Models, langs: list[str], entropies: np.ndarray) -> None:
    """Set ``sharpness`` and ``limits`` of ``models`` from rows of known language."""
    models.limits = np.full(len(models.languages), np.inf)
    truth = np.array([models.languages.index(x) if x in models.languages else -1 for x in langs], np.int64)
    if not (truth >= 0).any():
        return
    entropies, truth = entropies[truth >= 0], truth[truth >= 0]
    loss = {}
    for sharpness in (0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0):
        right = _certainty(entropies, sharpness)[np.arange(len(truth)), truth]
        loss[sharpness] = -np.log(np.clip(right, 1e-9, None)).mean()
    models.sharpness = min(loss, key=loss.get)
    for k in range(len(models.languages)):
        own = entropies[truth == k, k]
        if len(own) >= 20:
            models.limits[k] = np.quantile(own, 1 - REJECTED) * 1.05


# ------------------------------------------------------------------ predict


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``entropy`` and ``accepted`` for every row of ``docs``.

    Only the whole text is looked at. ``score`` is the calibrated certainty that ``lang_pred`` is the right one of
    the known languages; ``entropy`` the bits for each letter; ``accepted`` is false if that exceeds the language's
    limit, so the text may be in none of them. Null texts and those without a letter are ``und`` with score 0, no
    entropy and not accepted, and so is every text if no language is known. Ties go to the first language by
    name. Null ids stay null and are not held out; rows that repeat and other columns change nothing; an empty table gives an
    empty result. Texts of any length are read whole, word by word.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def start():
        models = sent.value
        own = Recogniser(models)

        def work(doc_ids, texts):
            if not models.languages:
                return [(doc_id, UNKNOWN, 0.0, None, False) for doc_id in doc_ids]
            out = []
            for doc_id, entropy in zip(doc_ids, own.entropies(texts), strict=True):
                if entropy is None:
                    out.append((doc_id, UNKNOWN, 0.0, None, False))
                else:
                    best = int(entropy.argmin())
                    limit = np.inf if models.limits is None else models.limits[best]
                    score = float(_certainty(entropy, models.sharpness)[best])
                    out.append((doc_id, models.languages[best], score, float(entropy[best]), bool(entropy[best] <= limit)))
            return out

        return work

    schema = "doc_id long, lang_pred string, score double, entropy double, accepted boolean"
    found = map_texts(docs.select("doc_id", text_of()), schema, start)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "accepted")
