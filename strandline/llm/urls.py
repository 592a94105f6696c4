"""URL filter: rules by host and path, and boosted trees over lexical features for what no rule decides.

All of it is DataFrame work: the features are SQL functions, the trees are Spark's own, trained on the URLs that the
rules decide.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, sample_by_copies

# Verdict, host and path of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Different labelled URLs of each verdict that the fit reads.
FIT_ROWS = 6_000
TREES, DEPTH, SEED = 12, 4, 17

FEATURES = [
    "url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "hyphens", "entropy", "parameters",
    "query_length", "fragment", "extension_length", "secure", "suffix_frequency", "suffix_blocked",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null or a URL without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def parsed(pages: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    return pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))


def with_rule(rows: DataFrame, rules=RULES) -> DataFrame:
    """``rows`` with ``rule`` and ``decided``, its verdict; null where no rule fits. The longest rule wins."""
    rule = decided = F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits &= F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        decided = F.when(fits, F.lit(verdict)).otherwise(decided)
    return rows.withColumns({"rule": rule, "decided": decided})


def _count(text: str, pattern: str) -> Column:
    return F.regexp_count(F.col(text), F.lit(pattern)).cast("double")


def _entropy(text: str) -> Column:
    """Bits for each character of the text, from how often each occurs in it."""
    size = F.length(text)
    share = lambda c: (size - F.length(F.replace(F.col(text), c))) / size
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(letters, F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c)))


def featured(rows: DataFrame) -> DataFrame:
    """The features of each URL that follow from it alone, and ``suffix``, the last two labels of its host."""
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    size = F.greatest(F.length("url"), F.lit(1))
    return rows.withColumns(
        {
            "url_length": F.length("url").cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "labels": _count("host", r"[^.]+"),
            "depth": _count("path", r"/[^/]"),
            "digit_ratio": _count("url", r"[0-9]") / size,
            "hyphens": _count("host", "-"),
            "entropy": F.coalesce(_entropy("url"), F.lit(0.0)),
            "parameters": F.size(F.filter(F.split(query, "&"), lambda part: part != "")).cast("double"),
            "query_length": F.length(query).cast("double"),
            "fragment": F.contains("url", F.lit("#")).cast("double"),
            "extension_length": F.length(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).cast("double"),
            "secure": F.col("url").startswith("https:").cast("double"),
            "suffix": F.substring_index("host", ".", -2),
        }
    )


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """For each ``suffix``: how frequent it is, as a logarithm, and how many of its rows a rule decides, and blocks.

    Partial sums keep a hot suffix to a row for each task. The sums are written, so that in a join with them both sides are
    shuffled by themselves and AQE can split the rows of a hot suffix."""
    blocked = F.sum((F.col("decided") == "block").cast("long"))
    return cut(
        rows.groupBy("suffix").agg(
            F.log1p(F.count("*").cast("double")).alias("suffix_frequency"),
            F.coalesce(blocked, F.lit(0)).alias("n_blocked"),
            F.count("decided").alias("n_decided"),
        )
    )


def _blocked_share(blocked: Column, decided: Column) -> Column:
    """The smoothed share of blocked rows among the decided ones."""
    return ((blocked + 5.0) / (decided + 10.0)).alias("suffix_blocked")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (or null) and ``verdict`` for every row of ``pages``.

    A rule's verdict holds. Where none fits, boosted trees decide that have learnt from about ``FIT_ROWS`` different
    URLs of each verdict, drawn by a hash of the URL and weighted by the rows that they stand for, so that
    verdicts have the ratio of all decided rows and a URL on many rows its own share of them. If the rules give no two verdicts to learn from, such URLs are allowed.

    A null URL, and one without ``://``, has empty host and path, fits no rule and is judged by its features. Null
    and repeated ids and other columns change nothing; an empty table gives an empty result.
    """
    ruled = with_rule(parsed(pages), rules)
    rows = featured(ruled)
    suffixes = suffix_statistics(rows)
    rows = rows.join(suffixes, "suffix").withColumn("suffix_blocked", _blocked_share(F.col("n_blocked"), F.col("n_decided")))
    label = (F.col("decided") == "block").cast("double").alias("label")
    decided = ruled.where("decided IS NOT NULL").groupBy("url", "host", "path", "decided").agg(F.count("*").alias("copies"))
    known = featured(sample_by_copies(decided, "decided", FIT_ROWS, "url", "stands_for"))
    # A URL to learn from doesn't count itself: else the share of its suffix would tell its verdict.
    others = F.col("n_blocked") - F.when(F.col("decided") == "block", F.col("copies")).otherwise(0)
    share = _blocked_share(others, F.col("n_decided") - F.col("copies"))
    own = [name for name in FEATURES if name != "suffix_blocked"]
    known = cut(known.join(suffixes, "suffix").select(label, "stands_for", *own, share))
    columns = ["page_id", "host", "path", "rule"]
    if known.select("label").distinct().count() < 2:
        return rows.select(*columns, F.coalesce("decided", F.lit("allow")).alias("verdict"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=True, weightCol="stands_for")
    model = trees.fit(assembler.transform(known))
    judged = model.transform(assembler.transform(rows))
    own = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return judged.select(*columns, F.coalesce("decided", own).alias("verdict"))
