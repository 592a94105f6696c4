from __future__ import annotations

import re

import corpus_pipeline
import pytest
from tests.llm.conftest import DOCS, rows_of
from tests.llm.test_decontaminate import plain as plain_contained
from tests.llm.test_simhash import plain_components, plain_fingerprint

from strandline.llm import toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def expected(spark):
    """What is left after each stage, by plain Python over what the stage before left."""
    docs, labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    scores = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    toxic = {r["doc_id"] for r in scores if r["predicted"]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = [{i: t for i, t in texts.items() if i not in toxic}]
    first = {}
    for i in sorted(left[-1]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", left[-1][i] or ""), i)
    left.append({i: texts[i] for i in first.values()})
    group = plain_components({i: plain_fingerprint(t or "") for i, t in left[-1].items()})
    left.append({i: t for i, t in left[-1].items() if group[i] == i})
    held = {i for i, *_ in plain_contained(left[-1].items(), [(r["item_id"], r["text"]) for r in items.collect()])}
    left.append({i: t for i, t in left[-1].items() if i not in held})
    return [set(x) for x in left]


def test_stages_one_by_one(spark, expected, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    sizes = [docs.count()]
    for (name, stage), want in zip(corpus_pipeline.STAGES, [*expected, expected[-1]], strict=True):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} == want, name
        assert name == "bpe" or docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > sizes[4] == sizes[5]


def test_run_gives_what_the_stages_give(spark, expected):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r["doc_id"] for r in got.collect()} == expected[-1] and got.count() == len(expected[-1])


def test_nulls_and_empty_tables_pass_every_stage(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e f", None, None, None), (3, "fine words", "en", None, 9)]
    for docs, want in ((spark.createDataFrame(rows, DOCS), [(1,), (3,), (None,)]), (spark.createDataFrame([], DOCS), [])):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = f"{tmp_path}/{len(want)}/{k}{name}"
            stage(spark, docs, str(tmp_path)).write.parquet(out)
            docs = spark.read.parquet(out)
        assert rows_of(docs, "doc_id") == sorted(want, key=repr)
