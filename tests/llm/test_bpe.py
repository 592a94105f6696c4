from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tests.llm.conftest import rows_of
from tokenizers import Tokenizer

from strandline.llm import bpe, common
from strandline.llm.common import map_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def judge():
    own = Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    return own


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_spec(PATH))


LETTERS = "ab e\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0　᠎​é中'sdlv1²½٣_-<|😀\x00"


def test_ids_equal_those_of_the_library(codec, judge):
    draw = random.Random(7)
    texts = ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(40))) for _ in range(4_000)]
    texts += [draw.choice("ab .-=1") * draw.randrange(5_000) for _ in range(40)]
    texts += ["<|endoftext|>", "a<|endoftext|> b", "<|endoftext|", "", "it's we'll 'S I'd", "the cat" * 3_000]
    for text, packed in zip(texts, codec.encode_all(texts), strict=True):
        want = judge.encode(text, add_special_tokens=False).ids
        assert list(memoryview(packed).cast("I")) == want, text[:80]
        assert codec.decode(packed) == judge.decode(want, skip_special_tokens=False)


def test_every_token_encodes_to_itself(codec):
    plain = {n: t for n, t in codec.text_of_id.items() if n in codec.width}
    octets = {t.decode("latin-1"): n for n, t in plain.items()}
    for piece, packed in codec.encode_pieces(octets):
        assert list(memoryview(packed).cast("I")) == [octets[piece]]


def test_memory_that_starts_anew_changes_nothing(judge, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_PIECES", 3)
    monkeypatch.setattr(bpe, "MEMORY_PAIRS", 3)
    own = bpe.Codec(bpe.read_spec(PATH))
    for text in ["one two three", "two four five six", "one two", "seven one"] * 3:
        assert list(memoryview(own.encode(text)).cast("I")) == judge.encode(text).ids


def test_bytes_that_are_no_text_decode_as_in_the_library(codec, judge):
    draw = random.Random(3)
    for _ in range(500):
        ids = [draw.randrange(50_257) for _ in range(6)]
        assert codec.decode(struct.pack("<6I", *ids)) == judge.decode(ids, skip_special_tokens=False)


def test_rows_digests_and_edges(docs_of, judge):
    texts = {1: "Hello  world", 2: None, 3: "", 4: "word " * 60_000, None: "x"}
    coded = bpe.encode_decode(docs_of(list(texts.items()) + [(1, texts[1])]), bpe.read_spec(PATH))
    got = {r["doc_id"]: r for r in bpe.token_digests(coded).collect()}
    assert coded.count() == 6
    for doc_id, text in texts.items():
        ids = judge.encode(text or "").ids
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    unpacked = coded.where("doc_id in (1, 3)").select("doc_id", bpe.unpack_ids(coded["ids"]).alias("ids"))
    assert rows_of(unpacked, "doc_id", "ids") == [(1, judge.encode("Hello  world").ids)] * 2 + [(3, [])]
    assert bpe.encode_decode(docs_of([]), bpe.read_spec(PATH)).count() == 0


def test_a_worker_gives_the_codec_back_when_another_operator_works_there(spark, docs_of):
    docs = docs_of([(k, f"text {k}") for k in range(8)]).repartition(4)
    bpe.encode_decode(docs, bpe.read_spec(PATH)).collect()
    held = map_texts(docs.select("doc_id"), "n long", lambda: lambda ids: [(len(common.KEPT),) for _ in ids])
    assert [row["n"] for row in held.collect()] == [0] * 8


def test_a_worker_keeps_one_thing():
    try:
        assert [common.kept("a", lambda: 1), common.kept("a", lambda: 2), common.kept("b", lambda: 3)] == [1, 1, 3]
        assert list(common.KEPT) == ["b"]
        common.release()
        assert not common.KEPT
    finally:
        common.KEPT.clear()
