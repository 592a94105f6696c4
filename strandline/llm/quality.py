"""Quality by a regularised quadratic discriminant over transformed statistics of a document.

Each class is a normal distribution of the statistics. Its covariance is shrunk towards the pooled one and its
diagonal, its Cholesky factor is computed once, and a document's score comes from the difference of the two log
densities: Mahalanobis distances under either factor.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from itertools import islice
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, importable, is_held_out, map_texts, text_of

TO_POOLED = 0.1
TO_DIAGONAL = 0.05
THRESHOLD = 0.5

# Kinds of bytes, by number; bytes of letters beyond ASCII are kind 0.
_KINDS = np.zeros(256, np.int64)
for _kind, _members in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:'\"-()", b"!?"),
    start=1,
):
    _KINDS[np.frombuffer(_members, np.uint8)] = _kind
_KINDS[[b for b in range(128) if not _KINDS[b]]] = 8
KINDS = 9

STATISTICS = 15


def _odds(part: float, whole: float) -> float:
    """Log-odds of a share, kept finite."""
    return log((part + 0.5) / (whole - part + 0.5)) if whole else 0.0


def statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text: shares as log-odds, sizes as logarithms.

    Shares of each kind of character, of words that repeat, that equal the word before, that have one or two
    letters; of lines that repeat; lengths of text, words and lines.
    """
    octets = text.encode()
    kinds = np.bincount(_KINDS, np.bincount(np.frombuffer(octets, np.uint8), minlength=256), KINDS).tolist()
    words = text.split()
    lines = text.split("\n")
    n, size = len(words), len(octets)
    same = sum(map(operator.eq, words, islice(words, 1, None)))
    short = sum(1 for word in words if len(word) < 3)
    out = [_odds(part, size) / 4 for part in kinds[1:]]
    out += [
        _odds(n - len(set(words)), n),
        _odds(same, n),
        _odds(short, n),
        _odds(len(lines) - len(set(lines)), len(lines)),
        log1p(n),
        log1p(size / max(1, n)),
        log1p(size / len(lines)),
    ]
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x``, the statistics of the whole text, for every row; a null text counts as empty."""

    def start():
        return lambda doc_ids, texts: zip(doc_ids, map(statistics, texts), strict=True)

    return map_texts(docs.select("doc_id", text_of()), "doc_id long, x array<double>", start)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of both classes, and the log-odds of their shares."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        if not self.means:
            return np.full(len(x), 1 / (1 + np.exp(-self.odds)))
        far = [((x - m) @ f.T) ** 2 @ np.ones(x.shape[1]) for m, f in zip(self.means, self.factors, strict=True)]
        gain = (far[0] - far[1] + self.log_dets[0] - self.log_dets[1]) / 2 + self.odds
        return 1 / (1 + np.exp(-np.clip(gain, -30, 30)))


def discriminant(count: np.ndarray, total: np.ndarray, squares: np.ndarray) -> Discriminant:
    """From the number of rows, the sums and the sums of products of each class."""
    odds = float(np.log((count[1] + 0.5) / (count[0] + 0.5)))
    if count.min() < 2:
        return Discriminant([], [], [], odds)
    means = total / count[:, None]
    cov = squares / count[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.tensordot(count / count.sum(), cov, 1)
    model = Discriminant([], [], [], odds)
    for mean, own, n in zip(means, cov, count, strict=True):
        few = min(1.0, 2 * len(mean) / n)  # with few rows more comes from the pooled estimate
        shrunk = (1 - max(TO_POOLED, few)) * own + max(TO_POOLED, few) * pooled
        shrunk = (1 - TO_DIAGONAL) * shrunk + np.diag(TO_DIAGONAL * np.diag(shrunk) + 1e-3)
        factor = np.linalg.cholesky(shrunk)
        model.means.append(mean)
        model.factors.append(np.linalg.inv(factor))
        model.log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return model


def fit(known: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from ``x`` of ``known`` (``document_statistics``) and ``quality`` of ``labels``.

    All labelled rows but the held-out ones count. Spark sums their moments, so what reaches the driver has the
    size of two covariance matrices. Rows without label, and ids that are labelled more than once in different
    ways, are left out. With fewer than two rows of a class every score is the share of class 1.
    """
    given = labels.where(F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id"))).groupBy("doc_id")
    given = given.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    rows = known.join(given.select("doc_id", "quality"), "doc_id")
    x = F.concat(F.array(F.lit(1.0)), "x")
    products = F.flatten(F.transform(x, lambda a: F.transform(x, lambda b: a * b)))
    moments = rows.select("quality", F.posexplode(products).alias("at", "v")).groupBy("quality", "at")
    table = np.zeros((2, (STATISTICS + 1) ** 2))
    for row in moments.agg(F.sum("v").alias("v")).collect():
        table[row["quality"], row["at"]] = row["v"]
    table = table.reshape(2, STATISTICS + 1, STATISTICS + 1)
    return discriminant(table[:, 0, 0], table[:, 0, 1:], table[:, 1:, 1:])


def score(known: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``known``."""
    sent = known.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.score(x))], ["doc_id", "score"])

    scored = importable(known).select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Scores of every row of ``docs`` by a discriminant learnt from ``labels``.

    Texts are read once: their statistics are written to the checkpoint folder, for the fit and for the scores. A
    null text counts as empty; an empty text is scored by its statistics like any other. Rows that repeat get the same
    score, null ids stay null and are not held out, other columns are ignored, an empty table gives an empty result.
    """
    known = cut(document_statistics(docs))
    return score(known, fit(known, labels), threshold)
