from __future__ import annotations

import random
import re
from collections import Counter
from math import log2

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of
from tests.llm.conftest import rows_of

from strandline.llm import urls
from strandline.llm.common import sample_by_copies

PAGES = "page_id long, url string, html string, host string, verdict string, suffix string"
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def plain(url):
    """Host, path and rule, letter by letter."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest] + [len(rest)])]
    best = None
    for rule in RULES:
        at = rule.index("/")
        fits = (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:])
        if fits and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, None, "x", "y", "z") for i, u in rows], PAGES)


def made_urls(n):
    draw = random.Random(6)
    parts = ["http", "://", "://", "Example.ORG", "example.org", "a.example.org", "org", "xorg", "com", "b.com", "example.net", "/es/", "/en/1", "/en/",
             "/fr/x", "/de/", "/", "?a=1&b=2", "#top", "?", "é", ".html", "123", "-", "%20"]
    return [None, "", "://", "http://"] + ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 8))) for _ in range(n)]


def test_hosts_paths_and_rules_equal_those_of_brute_force(spark):
    rows = list(enumerate(made_urls(3_000)))
    got = urls.with_rule(urls.parsed(pages_of(spark, rows)))
    urls_of = dict(rows)
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"]) == plain(urls_of[r["page_id"]]), urls_of[r["page_id"]]
        assert r["decided"] == RULES.get(r["rule"])


def test_features_by_the_letter(spark):
    rows = [(1, "https://a.b-c.net/x/y1.html?p=1&q=2#f"), (2, None), (3, "aabb")]
    got = {r["page_id"]: r for r in urls.featured(urls.with_rule(urls.parsed(pages_of(spark, rows)))).collect()}
    one = got[1]
    assert [one[c] for c in ("labels", "depth", "hyphens", "parameters", "fragment", "extension_length", "secure")] == [3, 2, 1, 2, 1, 4, 1]
    url = rows[0][1]
    assert one["digit_ratio"] == pytest.approx(3 / len(url)) and one["suffix"] == "b-c.net"
    assert one["entropy"] == pytest.approx(-sum(n / len(url) * log2(n / len(url)) for n in Counter(url).values()))
    assert got[2]["entropy"] == 0 and got[3]["entropy"] == pytest.approx(1)


def test_rules_hold_and_trees_judge_the_rest(spark):
    draw = random.Random(8)
    rows = []
    for i in range(900):
        lang = draw.choice(["de", "fr", "en"])
        # Blocked pages have a query with many parameters, whatever the host.
        query = "?a=1&b=2&c=3&d=4" if lang == "de" else ""
        host = draw.choice(["site", "other"]) + (".com" if lang != "en" else ".net")
        if lang == "en":
            query = draw.choice(["", "?a=1&b=2&c=3&d=4"])
        rows.append((i, f"https://{host}/{lang}/{draw.randrange(10_000)}{query}"))
    urls_of = dict(rows)
    got = urls.judge(pages_of(spark, rows)).collect()
    assert len(got) == 900
    own = [r for r in got if r["rule"] is None]
    assert all(r["verdict"] == RULES[r["rule"]] for r in got if r["rule"])
    right = sum((r["verdict"] == "block") == ("d=4" in urls_of[r["page_id"]]) for r in own)
    assert len(own) > 200 and right / len(own) > 0.95


def test_samples_keep_hot_urls_and_the_ratio_of_verdicts(spark):
    # 2,000 blocked rows of their own URL, 1,000 allowed ones, and 3,000 allowed rows of one URL.
    rows = [("block", f"b{i}", 1) for i in range(2_000)] + [("allow", f"a{i}", 1) for i in range(1_000)] + [("allow", "hot", 3_000)]
    table = spark.createDataFrame(rows, "decided string, url string, copies long")
    got = sample_by_copies(table, "decided", 400, "url", "stands_for").collect()
    for verdict, total in (("block", 2_000), ("allow", 4_000)):
        own = [r for r in got if r["decided"] == verdict]
        assert 320 < len(own) < 480
        assert sum(r["stands_for"] for r in own) == pytest.approx(total, rel=0.2)
    assert [r["stands_for"] for r in got if r["url"] == "hot"] == [3_000]
    assert len(sample_by_copies(table, "decided", 2_000, "url", "stands_for").where("stands_for = copies").collect()) == 3_001


def test_verdicts_do_not_follow_the_size_of_the_sample(spark, monkeypatch):
    draw = random.Random(3)
    rows = []
    for i in range(4_400):  # of the URLs with a query a fourth is blocked, of those without none
        blocked = i % 11 == 0
        query = "?a=1&b=2" if blocked or draw.random() < 0.3 else ""
        rows.append((i, f"http://example.org/en/{1 if blocked else 2}{draw.randrange(10**5, 10**6)}{query}"))
    # No rule knows this host; its letters are those of the other, so that features are alike.
    rows += [(5_000 + i, f"http://example.gro/en/{1 + i % 2}{draw.randrange(10**5, 10**6)}?a=1&b=2") for i in range(50)]
    whole = dict(rows_of(urls.judge(pages_of(spark, rows)), "page_id", "verdict"))
    monkeypatch.setattr(urls, "FIT_ROWS", 400)  # all blocked URLs, a tenth of the allowed ones
    part = dict(rows_of(urls.judge(pages_of(spark, rows)), "page_id", "verdict"))
    own = [i for i in whole if i >= 5_000]
    assert sum(whole[i] != part[i] for i in own) <= 5
    assert sum(part[i] == "allow" for i in own) >= 45


def test_every_page_has_its_verdict(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = urls.judge(pages)
    assert rows_of(got, "page_id") == rows_of(pages, "page_id")
    assert {r["verdict"] for r in got.collect()} <= {"allow", "block"}


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "http://example.org/es/x"), (None, "http://x.org/"), (4, "http://" + "a" * 60_000 + ".net/"), (3, "HTTP://EXAMPLE.org/es/x")]
    got = urls.judge(pages_of(spark, rows))
    want = [(1, "", None, "allow"), (2, "", None, "allow"), (3, "example.org", "example.org/es/", "block"), (3, "example.org", "example.org/es/", "block"),
            (None, "x.org", "org/", "allow")]
    assert [r for r in rows_of(got, "page_id", "host", "rule", "verdict") if r[0] not in (1, 2, 4)] == sorted(want[2:], key=repr)
    assert got.count() == 6
    assert urls.judge(pages_of(spark, [])).count() == 0
    only = urls.judge(pages_of(spark, [(1, None), (2, "http://x.org/")]))  # one verdict alone teaches nothing
    assert rows_of(only, "page_id", "verdict") == [(1, "allow"), (2, "allow")]


def test_no_python_on_the_way(spark):
    pages = pages_of(spark, [(i, f"http://h{i}.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(60)])
    assert not re.search("Python|Pandas|Arrow", plan_of(urls.judge(pages).where(F.col("page_id") > 0)))


def test_a_hot_suffix_is_split_in_the_join(spark):
    rows = spark.range(200).selectExpr("concat('h', id % 5, '.com') AS suffix", "'block' AS decided")
    joined = rows.join(urls.suffix_statistics(rows), "suffix")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan  # the sums were written: both sides of the join have a shuffle of their own


def test_a_url_does_not_count_itself(spark, monkeypatch):
    """Of two URLs of one suffix, one blocked, each sees the other's verdict only."""
    seen = []
    real = urls.cut
    monkeypatch.setattr(urls, "cut", lambda df: seen.append(real(df)) or seen[-1])
    pages = [(1, "http://a.org/x"), (2, "http://example.org/es/y"), (3, "http://example.org/fr/z"), (4, "http://example.org/fr/z")]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"))
    assert got.count() == 4
    rows = {(r["label"], r["path_length"]): r["suffix_blocked"] for r in seen[-1].collect()}
    assert rows[1.0, 5.0] == pytest.approx((0 + 5) / (2 + 10))
    assert rows[0.0, 5.0] == pytest.approx((1 + 5) / (1 + 10))
