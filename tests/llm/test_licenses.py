from __future__ import annotations

import random
import re
import time

import regex
from tests.llm.conftest import rows_of

from strandline.llm import licenses

PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain(text: str):
    """Base places by comparing all runs of words."""
    words = PLAIN_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    hits = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        hits += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def mixed_texts(n: int) -> list[str]:
    draw = random.Random(11)
    parts = [*PHRASES, "MIT License", "CC-BY", "cc  by", "ccby", "mit", "license", "gnu general public licence", "xmit license",
             "mit licenses", "É mit\nlicense É", "Mozilla Pubic License", "the", "of", "gnu", "general", "public", "-", "\t", "2.0",
             "redistribution and use in sauce and binary forms", "this programm is free software you can redistribute it"]
    return ["".join(draw.choice(parts) + draw.choice([" ", " ", ", ", "-", "\n"]) for _ in range(draw.randrange(25))) for _ in range(n)]


def test_base_places_equal_those_of_brute_force(docs_of):
    texts = mixed_texts(400)
    got = licenses.scan_notices(docs_of(list(enumerate(texts)))).collect()
    for r in got:
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain(texts[r["doc_id"]])


def test_seeds_find_what_matching_everywhere_finds():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    draw = random.Random(5)
    many = 0
    for text in mixed_texts(300):
        letters = list(text)
        for _ in range(draw.randrange(4)):  # damage some letters
            if letters:
                letters[draw.randrange(len(letters))] = draw.choice("aeiou ")
        text = "".join(letters)
        _, found = scanner.scan(text)
        line = f" {' '.join(PLAIN_WORD.findall(text.encode().lower().decode()))} "
        for notice in scanner.notices:
            own = [f for f in found if f.label == notice.label and f.length == len(notice.text)]
            somewhere = notice.pattern.search(line)
            assert bool(own) == bool(somewhere), (notice.text, line)
            many += bool(own)
    assert many > 100


def test_spans_edits_and_score(docs_of):
    text = "Ünder the GNU  General Pubic License, é. Also: Mozilla Public License"
    row = licenses.scan_notices(docs_of([(1, text)])).first()
    assert row["labels"] == "gpl,mpl" and row["base_labels"] == "" and row["n_base"] == 0
    spans = [s.split(":") for s in row["spans"]]
    assert [(label, text[int(a) : int(b)], int(e)) for label, a, b, e in spans] == [
        ("gpl", "GNU  General Pubic License", 1), ("mpl", "Mozilla Public License", 0)]
    assert row["score"] == 1.0
    assert licenses.scan_notices(docs_of([(1, "gnu general pubic license")])).first()["score"] == 1 - 1 / 26


def test_every_notice_is_found_with_all_its_edits():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    draw = random.Random(3)
    for notice in scanner.notices:
        assert regex.match(r"[a-z0-9 ]+$", notice.text) and len(licenses.pieces(notice.text, notice.edits)) == notice.edits + 1
        for _ in range(20):
            letters = list(notice.text)
            for at in draw.sample(range(1, len(letters) - 1), notice.edits):
                if letters[at] != " ":
                    letters[at] = "q"
            found = scanner.scan(f"so, {''.join(letters)} it is")[1]
            assert notice.label in {f.label for f in found}, "".join(letters)


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (3, "x " * 100_000 + "MIT license"), (None, "cc by"), (4, "--"), (4, "--")]
    got = licenses.scan_notices(docs_of(rows))
    assert rows_of(got, "doc_id", "n_words", "n_base", "first_word", "labels", "score") == sorted(
        [(1, 0, 0, None, "", 0.0), (2, 0, 0, None, "", 0.0), (3, 100_002, 1, 100_000, "mit", 1.0), (None, 2, 1, 0, "cc-by", 1.0),
         (4, 0, 0, None, "", 0.0), (4, 0, 0, None, "", 0.0)], key=repr)
    assert licenses.scan_notices(docs_of([])).count() == 0


def test_short_notices_are_searched_with_an_edit():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    count, found = scanner.scan("Apache licence or MIT licence, CC bye; the mitt licenses; gnu generel public license")
    assert sorted({f.label for f in found}) == ["apache", "gpl", "mit"]
    assert [f.label for f in found if f.base and not f.edits] == []
    assert count == 14
    _, found = scanner.scan("a permit license of its own, cc buy, apache lice")
    assert found == []


def test_base_columns_do_not_follow_the_edits(docs_of):
    rows = [(1, "apache licence mit license apache  license"), (2, "apache licence")]
    got = licenses.scan_notices(docs_of(rows))
    assert rows_of(got, "doc_id", "n_base", "base_labels", "labels", "first_word", "last_word") == [
        (1, 2, "apache,mit", "apache,mit", 2, 4), (2, 0, "", "apache", None, None)]


def test_a_text_full_of_notices_takes_linear_time():
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES)
    seconds = {}
    for text in ("cc by ", "mit license ", "mit licence ", "gnu general public license "):
        for many in (10_000, 40_000):
            start = time.perf_counter()
            _, found = scanner.scan(text * many)
            seconds[text, many] = time.perf_counter() - start
            assert len(found) == many
        assert seconds[text, 40_000] < 8 * max(0.05, seconds[text, 10_000])
    assert seconds["cc by ", 40_000] < 1.0
