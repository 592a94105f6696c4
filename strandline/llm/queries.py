"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandline.llm import (
    bpe,
    decontaminate,
    exact,
    langid,
    licenses,
    negatives,
    periods,
    quality,
    secrets,
    shards,
    simhash,
    toxicity,
    urls,
)
from strandline.llm.common import table
from strandline.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows if there is one."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(pin_utc(spark), sf_dir.rstrip("/"))

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return run

    return register


def encoded(docs: DataFrame) -> DataFrame:
    """Token counts and digests of any documents, by the public 50k byte-level vocabulary."""
    return bpe.token_digests(bpe.encode_decode(docs, bpe.read_spec(public_tokenizers.path(TOKENIZER))))


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the 50k byte-level vocabulary and back."""
    return encoded(table(spark, sf_dir, "documents"))


@query()
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its predicted language."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licence notices in it."""
    return licenses.scan_notices(table(spark, sf_dir, "documents")).drop("spans")


@query()
def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the verdict on its URL."""
    return urls.judge(table(spark, sf_dir, "pages"))


@query(
    r"""
    WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
    i AS (SELECT item_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
    dg AS (
      SELECT DISTINCT id AS doc_id, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS p FROM d)
    ),
    ig AS (
      SELECT DISTINCT id AS item_id, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS p FROM i)
    ),
    n AS (SELECT item_id, count(*) AS n_shingles FROM ig GROUP BY item_id),
    s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM dg JOIN ig USING (g) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
    FROM s JOIN n USING (item_id) WHERE n_shared * 10 >= n_shingles * 8
    """
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the secrets in it."""
    docs = table(spark, sf_dir, "documents")
    return secrets.span_digests(secrets.find_secrets(docs, secrets.fit(docs)))


@query()
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest document it is linked with."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    r"""
    WITH d AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
    ), w AS (
      SELECT *, min(doc_id) OVER (PARTITION BY content) AS keep_id, count(*) OVER (PARTITION BY content) AS group_size
      FROM d
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM w
    """
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH r AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
    ), p AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT anchor_id, positive_id,
      CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank,
      other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
    """
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor's positives."""
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


# The least largest shard by dynamic programming over all ends of groups, for one shard more in each step.
MINIMAX_STEPS = "".join(
    f"""c{k} AS (
      SELECT s.e, min(greatest(c.m, s.e - c.e)) AS m FROM s JOIN c{k - 1} c ON c.e <= s.e GROUP BY s.e
    ),
    """
    for k in range(2, shards.SHARDS + 1)
)


@query(
    rf"""
    WITH RECURSIVE
    bits(b, c, k) AS (
      SELECT b, b, 0 FROM range(256) r(b)
      UNION ALL
      SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
    ),
    crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
    d AS (
      SELECT doc_id, sha256(coalesce(text, '')) AS digest, octet_length(encode(coalesce(text, ''))) + 1 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS data
      FROM documents
    ),
    g AS (SELECT digest, sum(size) AS bytes FROM d GROUP BY digest),
    s AS (SELECT digest, sum(bytes) OVER (ORDER BY digest) AS e FROM g),
    c1 AS (SELECT e, e AS m FROM s),
    {MINIMAX_STEPS}best AS (SELECT arg_max(m, e) AS capacity FROM c{shards.SHARDS}),
    cuts(n, place) AS (
      SELECT 0, CAST(0 AS HUGEINT)
      UNION ALL
      SELECT n + 1, (SELECT max(e) FROM s, best WHERE e <= place + capacity) FROM cuts WHERE n < {shards.SHARDS - 1}
    ),
    p AS (SELECT digest, (SELECT count(*) FROM cuts WHERE n > 0 AND place < e) AS shard FROM s)
    SELECT doc_id, size, xor(
        list_reduce(data, lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1]), 4294967295), 4294967295
      ) AS text_crc32, 'bytes' AS law, CAST(shard AS INT) AS shard,
      row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
    FROM d JOIN p USING (digest), crc
    """
)
def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot there."""
    return shards.shard_documents(table(spark, sf_dir, "documents"))


@query()
def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its runs, and with what is left without their repetitions."""
    return periods.run_digests(periods.find_runs(table(spark, sf_dir, "documents"), planted=True))
