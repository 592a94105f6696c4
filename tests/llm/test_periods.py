from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from tests.llm.conftest import rows_of

from strandline.llm.periods import Automaton, collapsed, find_runs, run_digests, runs_in, runs_of, with_periods
from strandline.llm.queries import QUERIES


def all_runs(words):
    """By definition: each period in turn, each stretch that keeps it, unless a smaller period does as well."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            end = i
            while end < n and words[end] == words[end - q]:
                end += 1
            start, length = i - q, end - i + q
            smaller = any(all(words[k] == words[k - d] for k in range(start + d, end)) for d in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((start, length, q))
            i = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed, many):
    draw = random.Random(seed)
    for _ in range(many):
        letters = draw.choice([1, 2, 2, 3, 6])
        words = [draw.randrange(letters) for _ in range(draw.randrange(60))]
        if draw.random() < 0.6:
            words = []
            for _ in range(draw.randrange(1, 4)):
                unit = [draw.randrange(letters + 2) for _ in range(draw.randrange(1, 7))]
                words += (unit * 9)[: draw.randrange(1, 40)] + [draw.randrange(20) for _ in range(draw.randrange(5))]
        yield words


def test_runs_by_definition():
    many = 0
    for words in texts(5, 1_500):
        want = all_runs(words)
        assert runs_in(words) == want
        assert runs_of([b"%d" % w for w in words]) == want
        many += len(want)
    assert many > 1_000


def test_automaton_knows_each_factor():
    words = [1, 2, 1, 1, 2, 1, 2, 2, 1]
    automaton = Automaton(words)
    strings = sum(automaton.length[s] - automaton.length[automaton.link[s]] for s in range(1, len(automaton.length)))
    assert strings == len({tuple(words[a:b]) for a in range(9) for b in range(a + 1, 10)})
    assert [automaton.length[s] for s in automaton.prefix] == list(range(1, 10))


def test_long_repetitive_texts():
    assert runs_of([b"a"] * 50_000) == [(0, 50_000, 1)]
    unit = [b"%d" % random.Random(1).randrange(10**6) for _ in range(1)] + [b"%d" % i for i in range(4_999)]
    assert runs_of([b"x"] + unit * 6) == [(1, 30_000, 5_000)]
    assert runs_of(unit * 3) == []


def planted(words, doc_id):
    """The law of the query, place by place."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_periods():
    for doc_id in range(300):
        words = [b"%d" % i for i in range(doc_id % 97)]
        assert with_periods(words, doc_id) == planted(words, doc_id)
    assert with_periods([b"a"], None) == [b"a"]


def digests(doc_id, text):
    words = planted((text or "").encode().split(), doc_id)
    runs = all_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_by_definition(docs_of):
    draw = random.Random(3)
    rows = [(i, " \t\n".join(f"é{w}" for w in words)) for i, words in enumerate(texts(9, 150))]
    rows += [(1000 + i, " ".join(f"w{draw.randrange(99)}" for _ in range(draw.randrange(90)))) for i in range(150)]
    got = run_digests(find_runs(docs_of(rows).repartition(3), planted=True))
    assert tuple(got.columns) == COLUMNS
    assert rows_of(got, *COLUMNS) == sorted((digests(*row) for row in rows), key=repr)


def test_nulls_repeats_and_empty_tables(docs_of):
    rows = [(None, "a a a a a a b"), (1, None), (1, None), (2, ""), (3, " \t "), (3, "a a a a a a"), (3, "a a a a a a")]
    got = find_runs(docs_of(rows))
    want = [(None, 7, 1, 0, 6, 1, 6000, "a b"), *[(1, 0, 0, *[None] * 4, "")] * 2, (2, 0, 0, *[None] * 4, ""),
            (3, 0, 0, *[None] * 4, ""), *[(3, 6, 1, 0, 6, 1, 6000, "a")] * 2]
    columns = ("doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "collapsed")
    assert rows_of(got, *columns) == sorted(want, key=repr)
    assert find_runs(docs_of([])).count() == 0
    assert run_digests(find_runs(docs_of([]), planted=True)).count() == 0


def test_collapse_of_runs_that_overlap():
    words = [b"a"] * 7 + [b"b"] + [b"a", b"a", b"b"] * 4
    runs = runs_of(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    assert len(runs) > 1
    assert collapsed(words, runs) == kept


@pytest.mark.parametrize("doc_id", [0, 7])
def test_query_on_given_table(spark, doc_id):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {row["doc_id"]: row["text"] for row in docs.collect()}
    got = {row["doc_id"]: tuple(row) for row in QUERIES["op13_periods"](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == text.keys()
    short = [i for i, t in text.items() if len((t or "").split()) < 500]
    assert len(short) > 100
    assert all(got[i] == digests(i, text[i]) for i in short[doc_id::9])
