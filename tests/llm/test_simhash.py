from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from tests.llm.conftest import rows_of

from strandline.llm import simhash


def plain_fingerprint(text: str) -> int:
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes: dict[int, int], radius: int = 4) -> dict[int, int]:
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(codes)
    values = np.array([codes[i] for i in ids], np.uint64)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ values[k]) <= radius):
            a, b = find(i), find(ids[k + 1 + j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprints_by_the_letter():
    for text in ["", " \t", "One", "a B c", "a b c d", "a b c d e a b c d e É x y z", "the cat " * 9_000, "É Ä É Ä É Ä"]:
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text), text[:40]


def test_trees_find_what_all_pairs_find():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, np.uint64)
    codes = np.unique(base[rng.integers(0, 40, 900)] ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)))
    tree = rng.integers(0, 7, len(codes))
    forest = simhash.Forest(codes, tree)
    for radius in (0, 2, 4, 9):
        got = set(zip(*(x.tolist() for x in forest.within(codes, tree, radius)), strict=True))
        near = np.bitwise_count(codes[:, None] ^ codes[None]) <= radius
        want = set(zip(*(x.tolist() for x in np.nonzero(near & (tree[:, None] == tree[None]))), strict=True))
        assert got == want


def clusters(seed: int, n: int) -> list[int]:
    """Chains and clouds of codes around a few centres, and codes far from all."""
    rng = np.random.default_rng(seed)
    out = [0]
    for _ in range(6):
        code = int(rng.integers(0, 2**63))
        for _ in range(n):
            out.append(code)
            code ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False))
    return out + [int(x) for x in rng.integers(0, 2**63, n)]


def linked(spark, codes: list[int], *sizes: int) -> dict[int, int]:
    signed = sorted({c - 2**64 if c >= 2**63 else c for c in codes})
    table = spark.createDataFrame([(c,) for c in signed], "code long")
    found = simhash.components(simhash.links(table, *sizes))
    rows = found.collect()
    assert len({r["node"] for r in rows}) == len(rows)
    return {c: next((r["root"] for r in rows if r["node"] == c), c) for c in signed}


def test_components_equal_those_of_all_pairs(spark):
    codes = clusters(1, 60) + [2**64 - 1 - (1 << k) for k in range(12)]
    want = plain_components({k: c for k, c in enumerate(dict.fromkeys(codes))})
    classes = {}
    for k, c in enumerate(dict.fromkeys(codes)):
        classes.setdefault(want[k], set()).add(c - 2**64 if c >= 2**63 else c)
    for sizes in ((2_000, 50_000), (7, 50_000), (7, 11)):  # small: shards are split into parts, then into blocks
        by_root = {}
        for c, root in linked(spark, codes, *sizes).items():
            by_root.setdefault(root, set()).add(c)
        assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, classes.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(-5, -9), (7, 7)]
    got = simhash.components(spark.createDataFrame(edges, "a long, b long"))
    roots = dict(rows_of(got, "node", "root"))
    assert {roots[k] for k in range(41)} == {0} and {roots[k] for k in range(100, 160)} == {100} and roots[-5] == -9
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spanning_links_stay_few():
    codes = np.arange(1_500, dtype=np.int64)  # within few bits of each other
    rows = pd.DataFrame({"shard": 1, "part": 0, "block": 0, "code": codes, "member": True, "query": True})
    assert len(simhash.spanning_links(rows)) == 1_499


def test_query_rows_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in simhash.near_groups(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    codes = {i: simhash.fingerprint(t or "") % 2**64 for i, t in texts.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(codes)
    assert all(got[i]["fingerprint"] == f"{codes[i]:016x}" for i in codes)


def test_edges(docs_of):
    words = "w%d " * 50 % tuple(range(50))
    docs = docs_of([(4, words), (2, words.upper()), (9, None), (8, " "), (None, "alone here"), (None, words), (3, "z " * 100_000)])
    got = simhash.near_groups(docs)
    assert rows_of(got, "doc_id", "component_id") == sorted(
        [(2, 2), (3, 3), (4, 2), (8, 8), (9, 8), (None, 2), (None, None)], key=repr
    )
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == sorted([(2,), (3,), (8,), (None,)], key=repr)
    assert simhash.near_groups(docs_of([])).count() == 0


def test_a_text_is_not_lost_with_its_id(docs_of):
    words = "w%d " * 50 % tuple(range(50))
    rows = [(1, words), (2, words + "."), (2, "another text of its own"), (None, words), (None, "alone"), (None, "alone"), (7, "alone")]
    rows += [(8, "twice there"), (8, "twice there"), (9, None), (9, "")]
    kept = simhash.drop_near_copies(docs_of(rows).repartition(3))
    assert rows_of(kept, "doc_id", "text") == sorted(
        [(1, words), (2, "another text of its own"), (7, "alone"), (8, "twice there"), (9, "")], key=repr
    ) or rows_of(kept, "doc_id", "text") == sorted(
        [(1, words), (2, "another text of its own"), (7, "alone"), (8, "twice there"), (9, None)], key=repr
    )


def test_a_root_of_many_fingerprints_can_be_split(spark, docs_of):
    """Both sides of each join by root are read from what was written, so neither is bound to the other's dealing."""
    coded = spark.range(50).selectExpr("id AS doc_id", "id * 7 AS code")
    plan = simhash._with_components(coded)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan
    assert plan.count("Scan ExistingRDD") == 2
