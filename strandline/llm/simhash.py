"""Near-duplicates by SimHash: 64-bit fingerprints, BK-trees for the search, components of the links.

Different fingerprints are searched, not documents. Fingerprints within four bits of each other are equal in at
least two of six blocks of bits, so each pair of blocks and its bits is the key of a shard, and two fingerprints that
link meet in one of their fifteen shards at least. A shard's members form a BK-tree: children are keyed by their Hamming
distance to the parent, and a search follows only the edges within the radius of its own distance.
A broadcast of all trees would grow with the corpus, so a tree is built where its shard's rows arrive.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, importable, join_keys, map_texts, one_of_each, release, text_digest, text_of

RADIUS = 4
SHINGLE_WORDS = 4
HASH_SEED = 42
# Lowest bit and width of the blocks; RADIUS differing bits leave two of them untouched.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
# Members of one BK-tree. A larger shard is split, and its members are searched in all of its trees.
TREE_MEMBERS = 2_000
# Codes that one task searches in one tree, so that the rows it holds are bounded whatever the shard's size.
BLOCK_QUERIES = 50_000
# Rows of whole shards that one step of a task works on, and node visits it holds at one time.
STEP_ROWS = 200_000
STEP_VISITS = 1_000_000


def fingerprint(text: str) -> int:
    """Majority bits of the hashes of a text's word shingles, as a signed 64-bit number."""
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= SHINGLE_WORDS:
        starts, ends = starts[: len(words) - SHINGLE_WORDS + 1], ends[SHINGLE_WORDS - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], HASH_SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64
    )
    bits = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 8_192):
        part = hashes[low : low + 8_192]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` of the text and ``code`` (the fingerprint as long) of every row; a null text counts as empty, with code 0."""

    def start():
        return lambda doc_ids, digests, texts: zip(doc_ids, digests, map(fingerprint, texts), strict=True)

    read = docs.select("doc_id", text_digest().alias("digest"), text_of())
    return map_texts(read, "doc_id long, digest binary, code long", start)


# ------------------------------------------------------------------ BK-trees


class Forest:
    """BK-trees over ``codes``, one for each value of ``tree``, built and searched level by level.

    The codes of one tree are all different.
    """

    def __init__(self, codes: np.ndarray, tree: np.ndarray) -> None:
        self.codes = codes
        names, first, slot = np.unique(tree, return_index=True, return_inverse=True)
        self.roots = dict(zip(names.tolist(), first.tolist(), strict=True))
        parents, edges, children = [], [], []
        items, node = np.arange(len(codes)), first[slot]
        while True:
            below = items != node
            items, node = items[below], node[below]
            if not len(items):
                break
            edge = np.bitwise_count(codes[items] ^ codes[node]).astype(np.int64)
            _, at, slot = np.unique(node * 128 + edge, return_index=True, return_inverse=True)
            parents.append(node[at])
            edges.append(edge[at])
            children.append(items[at])
            node = items[at][slot]
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        keys = join(parents) * 128 + join(edges)
        order = np.argsort(keys, kind="stable")
        self.keys, self.children = keys[order], join(children)[order]

    def within(self, codes: np.ndarray, tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a position in ``codes`` and a member of its tree that differ in ``radius`` bits or fewer."""
        query = np.arange(len(codes))
        node = np.array([self.roots[name] for name in tree.tolist()], np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):
            far = np.bitwise_count(codes[query] ^ self.codes[node]).astype(np.int64)
            near = far <= radius
            found.append((query[near], node[near]))
            low = np.searchsorted(self.keys, node * 128 + np.maximum(far - radius, 1))
            high = np.searchsorted(self.keys, node * 128 + np.minimum(far + radius, 64), side="right")
            many = high - low
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            query, node = np.repeat(query, many), self.children[np.repeat(low, many) + step]
        return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the members of linked sets the smallest root among them; ``root`` is changed in place."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (again := root[root]).tobytes() != root.tobytes():
            root[:] = again


def spanning_links(rows: pd.DataFrame, radius: int = RADIUS) -> pd.DataFrame:
    """Links that connect what the trees of ``rows`` connect: ``shard``, ``part``, ``block``, ``code``, and whether it
    is a ``member`` of that tree and is searched in it (``query``).

    Each code is linked with the first one of its set at most once, so a dense shard of n codes gives n links
    and not n² pairs.
    """
    codes = rows["code"].to_numpy().view(np.uint64)
    tree = pd.factorize(pd.MultiIndex.from_frame(rows[["shard", "part", "block"]]))[0]
    member = np.flatnonzero(rows["member"].to_numpy())
    sizes = np.bincount(tree[member], minlength=tree.max() + 1)
    queries = np.flatnonzero((np.bincount(tree)[tree] > 1) & rows["query"].to_numpy())
    queries = queries[sizes[tree[queries]] > 0]
    if not len(queries):
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    forest = Forest(codes[member], tree[member])
    distinct, root_of = np.unique(codes, return_inverse=True)
    root = np.arange(len(distinct))
    visits = np.cumsum(sizes[tree[queries]])
    for part in np.split(queries, np.searchsorted(visits, np.arange(STEP_VISITS, visits[-1], STEP_VISITS))):
        at, node = forest.within(codes[part], tree[part], radius)
        unite(root, root_of[part[at]], root_of[member[node]])
    linked = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"a": distinct[root[linked]].view(np.int64), "b": distinct[linked].view(np.int64)})


# ------------------------------------------------------------------ search and components


def _shards(code: Column) -> Column:
    """The keys of the shards of a code: each pair of blocks with its bits."""
    bits = [F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << width) - 1)) for low, width in BLOCKS]
    pairs = enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - RADIUS))
    return F.array(*(F.lit(k).cast("bigint") * (1 << 22) + bits[i] * (1 << 11) + bits[j] for k, (i, j) in pairs))


def links(
    codes: DataFrame, tree_members: int = TREE_MEMBERS, block_queries: int = BLOCK_QUERIES
) -> DataFrame:
    """Links ``a``, ``b`` that connect the different ``code`` values exactly as all pairs within ``RADIUS`` would.

    A shard above ``tree_members`` is split into parts with a tree each. Its codes are members of one part
    and are searched in that and all later ones, so every pair is still compared, by several tasks. If they are more
    than ``block_queries`` they come in blocks, each with a copy of the tree's members.
    """
    keyed = codes.select("code", F.explode(_shards(F.col("code"))).alias("shard"))
    large = keyed.groupBy("shard").count().where(F.col("count") > tree_members)
    large = large.select(
        "shard",
        F.ceil(F.col("count") / tree_members).cast("int").alias("parts"),
        F.ceil(F.col("count") / block_queries).cast("int").alias("blocks"),
    )
    place = lambda many, seed: F.pmod(F.xxhash64("code", F.lit(seed)), many).cast("int")
    copies = "transform(sequence(0, blocks - 1), b -> struct(own AS part, b AS block, true AS member, b = mine AS query))"
    others = (
        "transform(filter(sequence(0, parts - 1), p -> p > own), "
        "p -> struct(p AS part, mine AS block, false AS member, true AS query))"
    )
    dealt = (
        keyed.join(large, "shard", "left")
        .withColumns({"parts": F.coalesce("parts", F.lit(1)), "blocks": F.coalesce("blocks", F.lit(1))})
        .withColumns({"own": place(F.col("parts"), 0), "mine": place(F.col("blocks"), 1)})
        .select("shard", "code", F.expr(f"inline(concat({copies}, {others}))"))
        .repartition("shard", "part", "block")
        .sortWithinPartitions("shard", "part", "block")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= STEP_ROWS:
                rows = pd.concat(held, ignore_index=True)
                key = rows[["shard", "part", "block"]]
                last = (key == key.iloc[-1]).all(axis=1)
                if not last.all():
                    yield spanning_links(rows[~last].reset_index(drop=True))
                    held = [rows[last]]
                else:
                    held = [rows]
        if held:
            yield spanning_links(pd.concat(held, ignore_index=True))

    return importable(dealt).mapInPandas(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (``a``, ``b``); roots are the same within a component.

    Stars are made in turns: every node hands its larger neighbours, then its smaller ones, to the smallest
    neighbour. Edges that repeat go before the next shuffle. The smallest neighbours are written before they are joined
    with the edges: so both sides of the join have a shuffle of their own, and AQE can split the edges of a
    node that is the centre of a large star. A turn that changes nothing is the last.
    """
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
        grown = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        grown = cut(grown.where("a <> b").distinct())
        down = cut(grown.groupBy("b").agg(F.min("a").alias("m")))
        edges = grown.join(down, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        edges = cut(edges.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        seen = now


def _with_components(coded: DataFrame, tree_members: int = TREE_MEMBERS) -> DataFrame:
    """``code``, ``root`` and ``component_id`` for every different fingerprint of ``coded``.

    Both sides of each join by ``root`` are written or shuffled by themselves, so AQE can split a root of very many fingerprints.
    """
    codes = cut(coded.groupBy("code").agg(F.min("doc_id").alias("least")))
    grouped = components(links(codes.select("code"), tree_members))
    rooted = codes.join(grouped, codes["code"] == grouped["node"], "left")
    rooted = cut(rooted.select("code", "least", F.coalesce("root", "code").alias("root")))
    least = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    return rooted.select("code", "root").join(least, "root")


def near_groups(docs: DataFrame, tree_members: int = TREE_MEMBERS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links of ``RADIUS`` bits or fewer reach. Texts without
    a word, and null ones, have fingerprint zero and link like any other. Rows with equal fingerprints are
    one node, so thousands of copies cost one search. Null ids count for nothing: a group of rows without any
    id has component null. Repeated ids give a row each; other columns are ignored; an empty table gives an empty result.
    """
    coded = cut(fingerprints(docs).drop("digest"))
    return coded.join(_with_components(coded, tree_members), "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, tree_members: int = TREE_MEMBERS) -> DataFrame:
    """One row of each group of ``docs`` that links of ``RADIUS`` bits or fewer connect, columns unchanged.

    It is the row of the group's smallest ``doc_id``; no id comes after all ids. Rows are told apart by id and text together: a text
    of another group is never lost with a row of its id, and rows without id are judged like all others. Of rows of the
    smallest id the one whose text has the smallest SHA-256 stays, and of rows that agree in both the smallest one, by
    its columns in order. Null and empty texts are one text; an empty table stays empty.
    """
    coded = cut(fingerprints(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("first")
    rooted = _with_components(coded, tree_members).select("code", "root")
    kept = cut(coded.join(rooted, "code").groupBy("root").agg(first).select("first.doc_id", "first.digest"))
    # More rows stay than go, so those that go are joined; they are counted from the narrow rows.
    keys = {"doc_id": coded["doc_id"], "digest": coded["digest"]}
    gone = join_keys(coded, kept, keys, "left_anti")
    left = join_keys(docs, gone, {"doc_id": docs["doc_id"], "digest": text_digest()}, "left_anti")
    repeated = coded.groupBy("doc_id", "digest").count().where("count > 1")
    return one_of_each(left, repeated, {"doc_id": left["doc_id"], "digest": text_digest()})
