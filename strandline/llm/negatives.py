"""Hard negatives: other-label rows whose score lies in a window below that of a positive, by spanning-tree bounds.

The anchors of a cell form spanning trees that hang from the origin, at which every candidate's score is 0. A score at
an anchor differs from the score at its parent by no more than the length of the edge times the candidate's norm. So the
interval of a candidate at the parent gives one at the child, and only candidates whose interval
overlaps the child's window are scored there.

All anchors meet all candidates in a grid of cells of bounded size: stripes of anchors by strips of candidates. Each
cell keeps the best rows of its own anchors, and a ranking merges the cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import cut, importable

ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
# Window of a negative's score, in hundredths of the positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95
SCALE = 256.0
# The labels of some rows are moved on.
MOVED_EVERY, LABELS = 7, 10

# Rows of one cell of the grid, and the least number of strips into which the candidates are dealt.
STRIPE_ANCHORS = 65_536
STRIP_CANDIDATES = 65_536
LEAST_STRIPS = 32
# Anchors of one tree and candidates that are bounded at one time.
TREE_ANCHORS = 512
STEP_CANDIDATES = 4_096
# Floats hold integers exactly below this; larger scores are computed with Python's integers.
EXACT = 2.0**52
LARGEST = 2**63 - 1
# Rounding of norms and edges never narrows an interval.
SLACK = 1.0 + 1e-9

Take = Callable[[int, np.ndarray, np.ndarray], None]


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` (moved on where ``vec_id`` asks for it), ``embedding`` as double and ``dim``; one row for each id.

    Rows with a null id or label, a null vector or a component that is null or not finite take no part. Of rows that share an id
    the one with the smallest label, then the smallest vector, counts.
    """
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    wrong = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * SCALE == float("inf")))
    whole = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(~wrong)
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    one = whole.groupBy("vec_id").agg(F.min(F.struct(moved.alias("label"), "embedding")).alias("row"))
    return one.select("vec_id", "row.label", "row.embedding", F.size("row.embedding").alias("dim"))


# ------------------------------------------------------------------ one cell


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors of a column as whole numbers."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.astype(np.float64) * SCALE).reshape(len(column), dim)


def spanning_tree(anchors: np.ndarray) -> tuple[list[int], np.ndarray, list[int]]:
    """Parent (-1: the origin), edge length and an order, parents first and depth first, of a least spanning tree."""
    n = len(anchors)
    edge = np.sqrt((anchors * anchors).sum(1))
    parent = np.full(n, -1)
    free = np.ones(n, bool)
    for _ in range(n):
        at = int(np.argmin(np.where(free, edge, np.inf))) if free.any() else 0
        if not free[at]:
            at = int(np.flatnonzero(free)[0])
        free[at] = False
        away = anchors - anchors[at]
        away = np.sqrt((away * away).sum(1))
        nearer = free & (away < edge)
        edge[nearer], parent[nearer] = away[nearer], at
    children: dict[int, list[int]] = {}
    for node, above in enumerate(parent.tolist()):
        children.setdefault(above, []).append(node)
    order, waiting = [], children.get(-1, [])[::-1]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += children.get(node, [])[::-1]
    return parent.tolist(), edge * SLACK, order


class Tree:
    """Anchors with a spanning tree, and the search of candidates along it."""

    def __init__(self, anchors: np.ndarray) -> None:
        self.anchors = anchors
        self.norm = np.sqrt((anchors * anchors).sum(1)) * SLACK
        self.parent, self.edge, self.order = spanning_tree(anchors)
        self.left = np.bincount(np.array(self.parent, int) + 1, minlength=len(anchors) + 1)[1:].tolist()
        self.scored = 0

    def search(
        self,
        vectors: np.ndarray,
        window: Callable[[int], tuple[float, float]],
        wanted: Callable[[int], np.ndarray],
        take: Take,
    ) -> None:
        """Give ``take`` the anchor, the numbers and the scores of the ``wanted`` candidates in its ``window``.

        Of the intervals only those are kept that children still need.
        """
        norms = np.sqrt((vectors * vectors).sum(1)) * SLACK
        exact = float(norms.max(initial=0.0)) * float(self.norm.max(initial=0.0)) < EXACT
        zero = np.zeros(len(vectors))
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        left = list(self.left)
        for node in self.order:
            above = self.parent[node]
            low, high = held.get(above, (zero, zero))
            reach = norms * self.edge[node]
            if not exact:  # the norm of a huge vector may be infinite
                reach = np.nan_to_num(reach, nan=np.inf, posinf=np.inf)
            low, high = low - reach, high + reach
            if above >= 0:
                left[above] -= 1
                if not left[above]:
                    del held[above]
            least, most = window(node)
            hit = np.flatnonzero((high >= least) & (low <= most) & wanted(node)) if least <= most else ()
            if len(hit):
                self.scored += len(hit)
                if not exact:
                    whole = [int(v) for v in self.anchors[node]]
                    products = (sum(a * int(b) for a, b in zip(whole, vectors[i], strict=True)) for i in hit)
                    scores = np.array([max(-LARGEST - 1, min(LARGEST, score)) for score in products], object)
                elif 2 * len(hit) > len(vectors):  # a product with all rows costs less than a copy of most
                    low = high = vectors @ self.anchors[node]
                    scores = low[hit]
                else:
                    scores = vectors[hit] @ self.anchors[node]
                    low[hit] = high[hit] = scores
                inside = (scores >= least) & (scores <= most)
                if inside.any():
                    take(node, hit[inside], scores[inside])
            if left[node]:
                held[node] = (low, high)


class Best:
    """The ``most`` first entries by larger score, then smaller id, of what is offered."""

    def __init__(self, most: int) -> None:
        self.most, self.entries = most, []

    @property
    def least(self) -> float:
        """The score below which nothing more is taken."""
        return -self.entries[-1][0] if len(self.entries) == self.most else -np.inf

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take from candidates in ascending order of id."""
        if len(scores) > self.most:
            if scores.dtype == object:
                first = np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[: self.most])
            else:
                bar = np.partition(scores, -self.most)[-self.most]
                over, equal = np.flatnonzero(scores > bar), np.flatnonzero(scores == bar)
                first = np.concatenate((over, equal[: self.most - len(over)]))
            ids, scores = ids[first], scores[first]
        new = [(-int(score), one) for score, one in zip(scores.tolist(), ids.tolist(), strict=True)]
        self.entries = sorted(self.entries + new)[: self.most]


def _forest(anchors: pa.Table, dim: int) -> Iterator[tuple[Tree, np.ndarray]]:
    """Trees over the anchors, those with the same signs next to each other, and the rows of each tree."""
    vectors = matrix(anchors["embedding"], dim)
    order = np.lexsort((vectors[:, :16] > 0).T[::-1]) if dim else np.arange(len(vectors))
    for low in range(0, len(order), TREE_ANCHORS):
        at = order[low : low + TREE_ANCHORS]
        yield Tree(vectors[at]), at


def _steps(candidates: pa.Table, dim: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of the candidates by id, in slices."""
    candidates = candidates.sort_by("vec_id")
    out = []
    for low in range(0, candidates.num_rows, STEP_CANDIDATES):
        part = candidates.slice(low, STEP_CANDIDATES)
        out.append((part["vec_id"].to_numpy(), part["label"].to_numpy(), matrix(part["embedding"], dim)))
    return out


def first_positives(candidates: pa.Table, anchors: pa.Table, most: int = POSITIVES) -> list[tuple]:
    """``anchor_id``, ``positive_id`` and score of the first ``most`` rows of each anchor's label in this cell."""
    dim = anchors["dim"][0].as_py()
    steps, out = _steps(candidates, dim), []
    anchor_ids, anchor_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
    for tree, at in _forest(anchors, dim):
        own, label, best = anchor_ids[at], anchor_labels[at], [Best(most) for _ in at]
        for ids, labels, vectors in steps:
            tree.search(
                vectors,
                lambda node: (best[node].least, np.inf),
                lambda node: (labels == label[node]) & (ids != own[node]),  # noqa: B023
                lambda node, hit, scores: best[node].offer(ids[hit], scores),  # noqa: B023
            )
        out += [(int(a), one, -minus) for a, b in zip(own, best, strict=True) for minus, one in b.entries]
    return out


def first_negatives(candidates: pa.Table, anchors: pa.Table, most: int = NEGATIVES) -> list[tuple]:
    """``anchor_id``, ``positive_id``, ``negative_id``, ``positive_score``, ``negative_score``: the first ``most`` rows of other labels
    in the window of each positive in this cell."""
    dim = anchors["dim"][0].as_py()
    steps, out = _steps(candidates, dim), []
    anchor_ids, anchor_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
    positives = anchors["positives"].to_pylist()
    for tree, at in _forest(anchors, dim):
        own, label = anchor_ids[at], anchor_labels[at]
        wanted = []  # for each anchor: lowest and highest score that fits a positive, and the best of it
        for row in at.tolist():
            ends = [(p, -(-LEAST_PERCENT * p["score"] // 100), MOST_PERCENT * p["score"] // 100) for p in positives[row]]
            wanted.append([(p, low, high, Best(most)) for p, low, high in ends if low <= high])

        def window(node: int) -> tuple[float, float]:
            fits = wanted[node]  # noqa: B023
            if not fits:
                return 1.0, 0.0
            return min(max(low, best.least) for _, low, _, best in fits), max(high for _, _, high, _ in fits)

        for ids, labels, vectors in steps:

            def take(node: int, hit: np.ndarray, scores: np.ndarray) -> None:
                for _, low, high, best in wanted[node]:  # noqa: B023
                    fits = (scores >= max(low, best.least)) & (scores <= high)
                    if fits.any():
                        best.offer(ids[hit[fits]], scores[fits])  # noqa: B023

            tree.search(vectors, window, lambda node: labels != label[node], take)  # noqa: B023
        out += [
            (int(a), p["id"], one, p["score"], -minus)
            for a, fits in zip(own, wanted, strict=True)
            for p, _, _, best in fits
            for minus, one in best.entries
        ]
    return out


# ------------------------------------------------------------------ the grid


def _per_cell(candidates: DataFrame, anchors: DataFrame, strips: int, stripes: int, work, schema: str) -> DataFrame:
    """``work`` on each cell of candidates and anchors of one dimension. The rows of a cell are bounded; neither labels nor
    values decide the cell, so no label or repeated vector can fill one."""
    place = lambda many: F.pmod(F.xxhash64("vec_id"), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    left = candidates.withColumns({"strip": place(strips), "stripe": every(stripes)})
    right = anchors.select(*(F.col(name).alias(name) for name in anchors.columns))  # apart from the left side's columns
    right = right.withColumns({"stripe": place(stripes), "strip": every(strips)})
    names = [part.split()[0] for part in schema.split(", ")]

    def cell(rows: pa.Table, own: pa.Table) -> pa.Table:
        made = work(rows, own) if rows.num_rows and own.num_rows else []
        columns = list(zip(*made, strict=True)) if made else [[] for _ in names]
        return pa.table({name: pa.array(values, pa.int64()) for name, values in zip(names, columns, strict=True)})

    keys = ("strip", "stripe", "dim")
    return importable(left).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, schema)


def _first(rows: DataFrame, keys: list[str], score: str, other: str, most: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def hard_negatives(
    rows: DataFrame,
    every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    stripe_anchors: int = STRIPE_ANCHORS,
    strip_candidates: int = STRIP_CANDIDATES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` for all anchors of ``rows``.

    Anchors are rows whose ``vec_id`` is divisible by ``every``; their positives the first ``positives`` other rows of the same
    label; a positive's negatives the first ``negatives`` rows of other labels whose score lies in the window below its own. Scores are
    inner products of whole numbers, larger ones first, ties by smaller ``vec_id``.

    Rows that can't be used (see ``usable``) are left out, and repeated ids count once. Vectors are compared with
    those of their own length; empty ones have score 0. An anchor or a positive without rows that fit gives none. A score beyond 64 bits
    counts as the nearest 64-bit number. Other columns are ignored; an empty table gives an empty result.
    """
    whole = cut(usable(rows))
    anchors = whole.where(F.col("vec_id") % every == 0)
    strips = max(LEAST_STRIPS, -(-whole.count() // strip_candidates))
    stripes = max(1, -(-anchors.count() // stripe_anchors))
    near = _per_cell(
        whole, anchors, strips, stripes, lambda a, b: first_positives(a, b, positives),
        "anchor_id long, positive_id long, score long",
    )
    near = _first(near, ["anchor_id"], "score", "positive_id", positives)
    listed = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), "score")).alias("positives")
    )
    hard = _per_cell(
        whole, anchors.join(cut(listed), "vec_id"), strips, stripes, lambda a, b: first_negatives(a, b, negatives),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    return _first(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
