"""Secrets: fixed formats, and random strings by the likelihood ratio of two Markov models.

One model of character pairs is trained on strings that are known to be random, another on ordinary identifiers: words, and
names, constants and paths made of them as programs do. A string whose characters follow each other as in the first, by more than
a margin for each character, is a secret even if nothing around it says so. The margin is set on identifiers of
documents set apart. A string is judged as a whole, then by the parts between its separators, so that a key glued to a
path is found; a string that overlaps a fixed format is judged by what is left of it.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import map_texts, text_of

# The formats; matches that are too short for their kind are dropped.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Strings that the models judge: their characters and least length.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CANDIDATE_LEAST = 20
PART = re.compile(r"[A-Za-z0-9+]+")
# Letters of a part from which it can show that a string is a path or a name and not random as a whole.
NAME_LEAST = 6
# Identifiers by their form, which no model judges.
UUID = re.compile(r"(?i:[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})")
# Log-likelihood ratio for each pair of characters above which a string is random, at least.
MARGIN = 0.5
# Share of the identifiers set apart that may lie above the margin.
FALSE_ALARMS = 0.001
# One document in so many is set apart for the margin; random strings that are added to those the fit finds, and
# the seeds of these and of those that measure how many are found.
APART = 5
RANDOM_STRINGS = 400
SEED, APART_SEED = 20_240_229, 20_250_301
# Classes of scores from which the margin is read: their least score and width.
SCORE_LEAST, SCORE_STEP = -8.0, 0.02

ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-."
_PLACE = np.full(128, len(ALPHABET), np.int64)
_PLACE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
STATES = len(ALPHABET) + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind``, start and end of the fixed formats, by start and then kind."""
    found = []
    lower = text.encode().lower()  # ASCII letters only
    if any(word.encode() in lower for word in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if any(HEX.search(word) for word in text.split() if len(word) >= HEX_LEAST):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _pairs(text: str) -> np.ndarray:
    """Numbers of the pairs of neighbouring characters."""
    at = _PLACE[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    return at[:-1] * STATES + at[1:]


@dataclass
class Markov:
    """Log-likelihood ratio of each pair of characters, random over ordinary.

    ``recall`` is the share of fresh random strings above ``margin``, ``false_alarms`` that of the identifiers set apart.
    """

    ratio: np.ndarray
    margin: float = MARGIN
    recall: float = 0.0
    false_alarms: float = 0.0

    def score(self, text: str) -> float:
        """Mean ratio of the pairs of ``text``."""
        return float(self.ratio[_pairs(text)].mean()) if len(text) > 1 else 0.0

    def scores(self, texts: list[str]) -> np.ndarray:
        """:meth:`score` of each of ``texts``, which have two characters or more."""
        if not texts:
            return np.empty(0)
        many = np.array([len(text) for text in texts])
        starts = np.cumsum(many) - many
        ratios = np.append(self.ratio[_pairs("".join(texts))], 0.0)
        ratios[starts + many - 1] = 0.0  # from one text to the next
        return np.add.reduceat(ratios, starts) / (many - 1)


def random_strings(n: int = RANDOM_STRINGS, seed: int = SEED) -> list[str]:
    """Labelled samples of strings as key generators make them: hexadecimal, letters and digits, base 64."""
    draw = random.Random(seed)
    sets = (string.hexdigits[:16], string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/")
    return ["".join(draw.choices(letters, k=40)) for letters in sets for _ in range(n)]


def _pascal(words: list[str]) -> str:
    return "".join(word.capitalize() for word in words)


# How programs join words to a name.
STYLES = (
    lambda w: w[0].lower() + _pascal(w[1:]),
    _pascal,
    lambda w: "_".join(w).lower(),
    lambda w: "_".join(w).upper(),
    lambda w: "-".join(w).lower(),
    lambda w: "/".join(w).lower(),
    lambda w: "/".join(w[:2]).lower() + "/" + _pascal(w[2:]),
    lambda w: f"{w[0].lower()}{len(w[1])}_{w[2].lower()}_{len(w[3]) * 37}",
)
# Words of which programs make names.
PROGRAM_WORDS = (
    "abstract access account action active adapter address admin agent alias api application archive argument array assert async "
    "attribute audit auth backup base batch bean binary block boolean bridge browser buffer builder bundle button cache callback "
    "cancel catalog chain channel check child class client cloud cluster code collection column command comment commit common "
    "component config connection console constant container content context control cookie count create current custom data "
    "database date debug default delegate delete dependency deploy description design device dialog directory dispatch document "
    "domain download driver dynamic edit element email empty enable engine entity environment error event example exception "
    "execution export extension factory field file filter final folder format frame function gateway generic global graph group "
    "handler hash header helper history host http icon image import index info initial input insert instance integer interface "
    "internal invalid item java job json key label language layout length level library limit line link list listener loader local "
    "lock logger login machine main manager map master match maximum memory menu message meta method metric minimum mode model "
    "module monitor name native network node notification null number object offset operation option order output package page "
    "parameter parent parse partition password path pattern payload permission plugin pointer policy pool port prefix process "
    "product profile project property protocol provider proxy public query queue random range record reference region register "
    "registry release remote render report repository request reset resource response result retry return role root route rule "
    "sample schedule schema scope script search section security select send sequence server service session setting shared "
    "signal simple single size socket sort source spark stack state static status storage store stream string style subject submit "
    "suffix summary support switch sync system table target task template test text theme thread threshold timeout timer title "
    "token tool total trace transaction transfer transform trigger type unique unit update upload user utility valid value vector "
    "version view virtual visible web widget window worker wrapper write"
).split()
PROGRAM_NAMES = 4_000
NAME_WORDS = 4
NAME_PART = re.compile(r"[A-Za-z]{3,}")


def identifiers(text: str) -> list[str]:
    """Names made of the words of a text as they follow each other, in all styles by turns."""
    words = NAME_PART.findall(text)
    starts = range(0, len(words) - NAME_WORDS + 1, NAME_WORDS)
    return [STYLES[k % len(STYLES)](words[at : at + NAME_WORDS]) for k, at in enumerate(starts)]


def program_names(n: int = PROGRAM_NAMES, seed: int = SEED) -> list[str]:
    """Labelled samples of ordinary identifiers in all styles."""
    draw = random.Random(seed)
    return [STYLES[k % len(STYLES)](draw.choices(PROGRAM_WORDS, k=NAME_WORDS)) for k in range(n)]


def _pair_counts(samples: list[str]) -> np.ndarray:
    """How often each pair of characters stands in the samples, which hold no line breaks."""
    data = np.frombuffer("\n".join(samples).encode("ascii", "replace"), np.uint8)
    inside = (data[:-1] != 10) & (data[1:] != 10)
    at = _PLACE[data]
    return np.bincount((at[:-1] * STATES + at[1:])[inside], minlength=STATES * STATES).astype(float)


def _log_chances(counts: np.ndarray) -> np.ndarray:
    """Log of the chance of the second character after the first, smoothed by that of the second alone."""
    counts = counts.reshape(STATES, STATES)
    alone = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * STATES)
    return np.log((counts + 5 * alone) / (counts.sum(1, keepdims=True) + 5)).ravel()


def fit(docs: DataFrame) -> Markov:
    """Train both models on all documents but those set apart, and on ``random_strings``.

    Values of the fixed formats are the random samples of the text; its other words of six or more characters and
    ``identifiers`` made of them the ordinary ones. One document in ``APART``, by a hash of id and text, is set apart: the margin is the
    score above which ``FALSE_ALARMS`` of their identifiers lie, and ``MARGIN`` at least. Spark sums the counts of pairs and of
    scores; tables of fixed size reach the driver. Without documents the margin is ``MARGIN``.
    """
    apart = F.pmod(F.xxhash64("doc_id", text_of()), F.lit(1_000_003)) % APART == 0

    def start():
        def work(texts):
            ordinary: list[str] = []
            secret: list[str] = []
            for text in texts:
                spans = base_spans(text)
                secret += [re.split(r"[\s\"':=]+", text[a:b], maxsplit=1)[-1] for _, a, b in spans]
                for _, a, b in reversed(spans):
                    text = text[:a] + " " * (b - a) + text[b:]
                ordinary += [w for w in text.split() if len(w) > 5] + identifiers(text)
            out = np.stack([_pair_counts(ordinary), _pair_counts(secret)])
            which, pair = np.nonzero(out)
            return zip(which.tolist(), pair.tolist(), out[which, pair].tolist(), strict=True)

        return work

    counts = map_texts(docs.where(~apart).select(text_of()), "which long, pair long, n double", start)
    table = np.zeros((2, STATES * STATES))
    for row in counts.groupBy("which", "pair").agg(F.sum("n").alias("n")).collect():
        table[row["which"], row["pair"]] = row["n"]
    # Fixed samples weigh as much as the documents do: their words may be of any language, and not all values in them are random.
    for row, samples in zip(table, (program_names(), random_strings()), strict=True):
        fixed = _pair_counts(samples)
        row += fixed * max(1.0, row.sum() / fixed.sum())
    model = Markov(_log_chances(table[1]) - _log_chances(table[0]))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        def work(texts):
            names = [name for text in texts for name in identifiers(text) if len(name) >= CANDIDATE_LEAST]
            classes = np.trunc((sent.value.scores(names) - SCORE_LEAST) / SCORE_STEP).astype(int)
            return Counter(classes.tolist()).items()

        return work

    classes = map_texts(docs.where(apart).select(text_of()), "class long, n long", judge)
    scores = sorted((row["class"], row["n"]) for row in classes.groupBy("class").agg(F.sum("n").alias("n")).collect())
    return calibrated(model, [(SCORE_LEAST + SCORE_STEP * (k + 1), n) for k, n in scores])


def calibrated(model: Markov, scores: list[tuple[float, int]]) -> Markov:
    """``model`` with the margin that follows from the scores of ordinary identifiers, ascending with their numbers."""
    total, above, margin = sum(n for _, n in scores), 0, MARGIN
    for score, n in reversed(scores):
        if above + n > FALSE_ALARMS * total:
            margin = max(margin, score)
            break
        above += n
    fresh = [model.score(sample) > margin for sample in random_strings(seed=APART_SEED)]
    false_alarms = sum(n for score, n in scores if score > margin) / max(1, total)
    return Markov(model.ratio, margin, sum(fresh) / len(fresh), false_alarms)


def _left_over(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What ``taken``, in order of start, leaves of a stretch."""
    out = []
    for a, b in taken:
        if b > start and a < end:
            if a > start:
                out.append((start, a))
            start = max(start, b)
    if start < end:
        out.append((start, end))
    return [(a, b) for a, b in out if b - a >= CANDIDATE_LEAST]


def all_spans(text: str, base: list[tuple[str, int, int]], model: Markov, margin: float) -> list[tuple[str, int, int]]:
    """``base`` and the random strings of ``text`` beside them, by start and then kind.

    A string is random as a whole if no part between its separators is a name; else those parts are that are long enough."""
    found = list(base)
    long = {word for word in text.split() if len(word) >= CANDIDATE_LEAST}
    if not any(CANDIDATE.search(word) for word in long):
        return found
    taken = sorted([(a, b) for _, a, b in base] + [m.span() for m in UUID.finditer(text)])
    ends = list(accumulate((b for _, b in taken), max))
    for match in CANDIDATE.finditer(text):
        first = bisect_right(ends, match.start())  # of those that end after the match begins
        last = bisect_left(taken, (match.end(), 0))
        for a, b in _left_over(*match.span(), taken[first:last]):
            parts = [part.span() for part in PART.finditer(text, a, b)]
            names = [text[c:d] for c, d in parts if d - c >= NAME_LEAST]
            if model.score(text[a:b]) > margin and all(model.score(name) > 0 for name in names):
                found.append(("random", a, b))
            else:
                long_parts = [(c, d) for c, d in parts if d - c >= CANDIDATE_LEAST]
                found += [("random", c, d) for c, d in long_parts if model.score(text[c:d]) > margin]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def find_secrets(docs: DataFrame, model: Markov, margin: float | None = None) -> DataFrame:
    """Secrets in every row of ``docs``, from the whole text.

    ``doc_id``, numbers of base spans ``n_assign``, ``n_access`` and ``n_hex``, and two lists joined by commas:
    ``base_spans`` and ``spans``, each entry ``kind:start:end`` in code points, end exclusive, by start
    and then kind. ``spans`` adds the strings of kind ``random`` that overlap no base span, those above ``margin`` (else the model's own).

    A null text counts as empty and gives empty lists. Null and repeated ids and other columns change nothing; an
    empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def join(spans):
            return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)

        def work(doc_ids, texts):
            for doc_id, text in zip(doc_ids, texts, strict=True):
                base = base_spans(text)
                many = Counter(kind for kind, _, _ in base)
                spans = all_spans(text, base, sent.value, sent.value.margin if margin is None else margin)
                yield doc_id, many["assign"], many["access"], many["hex"], join(base), join(spans)

        return work

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"
    return map_texts(docs.select("doc_id", text_of()), schema, start)


def span_digests(found: DataFrame) -> DataFrame:
    """``find_secrets`` with the SHA-256 of the base spans in their place."""
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )
