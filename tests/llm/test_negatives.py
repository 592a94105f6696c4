from __future__ import annotations

import math
import random

import numpy as np
from tests.conftest import plan_of
from tests.llm.conftest import rows_of

from strandline.llm import negatives
from strandline.llm.negatives import Tree, hard_negatives, spanning_tree, usable

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def table_of(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "dim", "strip", "stripe", "positives", "row", "rank"):
        table = table.selectExpr("*", f"'x' AS {name}")
    return table


def by_definition(rows, positives=5, negatives=3):
    use = {}
    for i, v, label in sorted(rows, key=repr):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        row = (int(label), [math.floor(256 * float(np.float32(x))) for x in v])
        use[i] = min(use.get(i, row), row)
    out = []
    for a in (i for i in use if i % 50 == 0):
        label, vector = use[a]
        scores = {
            i: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(vector, v, strict=True))))
            for i, (_, v) in use.items()
            if len(v) == len(vector)
        }
        order = sorted((i for i in scores if i != a), key=lambda i: (-scores[i], i))
        for p in [i for i in order if use[i][0] == label][:positives]:
            fits = [i for i in order if use[i][0] != label and 50 * scores[p] <= 100 * scores[i] <= 95 * scores[p]]
            out += [(a, p, k + 1, i, scores[p], scores[i]) for k, i in enumerate(fits[:negatives])]
    return sorted(out, key=repr)


def random_rows(seed, many, dim=6, centres=4):
    draw = random.Random(seed)
    middle = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    rows = []
    for i in range(many):
        centre = draw.choice(middle)
        rows.append((i * 5, [x + draw.gauss(0, 0.2) for x in centre], draw.randrange(3)))
    return rows


def test_pairs_by_definition(spark):
    rows = random_rows(1, 400)
    got = rows_of(hard_negatives(table_of(spark, rows)), *COLUMNS)
    assert got == by_definition(rows)
    assert len(got) > 300


def test_grid_of_several_cells(spark):
    rows = random_rows(2, 300)
    got = hard_negatives(table_of(spark, rows), every=10, stripe_anchors=20, strip_candidates=5)
    want = hard_negatives(table_of(spark, rows), every=10)
    assert rows_of(got, *COLUMNS) == rows_of(want, *COLUMNS)


def test_hot_vector_and_ties(spark):
    rows = [(i, [1.0, 0.5, -0.25], 1 if i % 2 else 2) for i in range(300)] + random_rows(3, 40, dim=3)[61:]
    rows += [(301 + i, [0.7, 0.4, -0.2], i % 3) for i in range(40)]
    assert rows_of(hard_negatives(table_of(spark, rows)), *COLUMNS) == by_definition(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(4, 80, dim=2)
    rows += [(None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, 1.0], None), (3, [1.0, None], 1), (4, [nan, 1.0], 1)]
    rows += [(6, [inf, 1.0], 1), (50, [0.5, 0.5], 1), (50, [0.5, 0.5], 1), (50, [0.1, 0.5], 0), (8, [], 1), (450, [], 1)]
    rows += [(9, [1.0], 1), (500, [1.0, 2.0, 3.0], 0), (11, [3.0, 2.0, 1.0], 0), (12, [1.0, 2.0, 0.5], 1), (-50, [1.0, -1.0], -3)]
    rows += [(700, [0.0, 0.0], 1), (13, [0.0, 0.0], 2)]
    assert rows_of(hard_negatives(table_of(spark, rows)), *COLUMNS) == by_definition(rows)
    assert hard_negatives(table_of(spark, [])).count() == 0
    assert hard_negatives(table_of(spark, [(1, [1.0], 1)])).count() == 0


def test_scores_beyond_floats_are_exact(spark):
    big = float(2**23)  # products of more than 53 bits
    rows = [(0, [big, 1.0], 0), (1, [big, 0.5], 1), (2, [big * 0.75, 3.0], 2), (3, [big * 0.75, 5.0], 2), (4, [3e38, 1.0], 3)]
    got = rows_of(hard_negatives(table_of(spark, rows)), *COLUMNS)
    assert got == by_definition(rows)
    assert [row[3] for row in got] == [3, 2]
    rows = [(0, [3e38, 1.0], 0), (1, [3e38, 2.0], 1), (5, [2e30], 1), (50, [2e30], 1), (2, [big, 3.0], 2)]
    assert rows_of(hard_negatives(table_of(spark, rows)), *COLUMNS) == by_definition(rows)


def test_tree_spans_and_bounds_save_scores():
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(8, 16)) * 256
    anchors = np.floor(np.repeat(centres, 16, 0) + draw.normal(size=(128, 16)))
    parent, edge, order = spanning_tree(anchors)
    assert sorted(order) == list(range(128))
    assert all(p < 0 or order.index(p) < order.index(i) for i, p in enumerate(parent))
    for i, p in enumerate(parent):
        assert edge[i] >= np.linalg.norm(anchors[i] - (anchors[p] if p >= 0 else 0))
    tree, vectors = Tree(anchors), np.floor(np.repeat(centres, 50, 0) + draw.normal(size=(400, 16)))
    found = []
    every = np.ones(400, bool)
    exact = vectors @ anchors.T
    least = np.sort(exact, axis=0)[-20]
    tree.search(vectors, lambda n: (least[n], np.inf), lambda n: every, lambda n, hit, s: found.append((n, hit, s)))
    assert tree.scored < 0.5 * 128 * 400
    for node, hit, scores in found:
        assert hit.tolist() == np.flatnonzero(exact[:, node] >= least[node]).tolist()
        assert scores.tolist() == exact[hit, node].tolist()
    assert len(found) == 128


def test_no_cross_join_and_no_group_by_label(spark):
    plan = plan_of(hard_negatives(table_of(spark, random_rows(6, 60))))
    assert "Cartesian" not in plan
    assert "NestedLoop" not in plan
    assert usable(table_of(spark, [(7, [1.0], 9), (14, [1.0], 3)])).orderBy("vec_id").collect()[0]["label"] == 0
    assert negatives.POSITIVES == 5
