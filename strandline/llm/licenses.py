"""Licence notices: exact seeds find candidates, bounded-error matching verifies them.

A notice that stands in a text with at most e edits, cut into e + 1 pieces, has one piece at least that is
unharmed. An automaton finds the pieces of all notices in one pass. Around each hit, the notice is matched with
at most e insertions, deletions or substitutions of letters. Notices without error are the phrases themselves.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass, field

import ahocorasick
import regex
from pyspark.sql import DataFrame

from strandline.llm.common import map_texts, text_of

# Base phrases with their labels, in lower case and words only.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further short notices with their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "this program is free software you can redistribute it": "gpl",
}
# Letters of a notice for each edit that it may have. Notices of fewer letters must stand there unharmed: one edit
# makes another word of them.
LETTERS_PER_EDIT = 10

SPACE = re.compile(" ")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Bytes of words stay, A-Z become lower case, all others a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def edits_of(notice: str) -> int:
    return len(notice) // LETTERS_PER_EDIT


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces of about equal length, with their places."""
    cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    base: bool
    edits: int
    pattern: regex.Pattern = field(compare=False)


@dataclass(frozen=True)
class Found:
    """A notice in a text: its words from ``first`` to before ``last``, and the edits it has."""

    label: str
    base: bool
    first: int
    last: int
    edits: int
    length: int


class Scanner:
    """Search of one set of notices."""

    def __init__(self, base: dict[str, str], notices: dict[str, str]) -> None:
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (text, label) in enumerate([*base.items(), *notices.items()]):
            edits = edits_of(text)
            fuzzy = regex.compile(rf"(?e)(?<= )(?:{regex.escape(text, literal_spaces=True)}){{e<={edits}}}(?= )")
            self.notices.append(Notice(text, label, number < len(base), edits, fuzzy))
            whole = f" {text} " if edits == 0 else text
            for place, piece in pieces(whole, edits):
                seeds[piece].append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[Found]]:
        """The number of words of ``text`` and all notices in it, by place.

        Every place where a base phrase stands unharmed is found. Of the places of a notice with edits that
        overlap, the first stays.
        """
        words = text.encode().translate(_WORD_BYTES).split()
        line = f" {b' '.join(words).decode()} "
        near: dict[int, set[int]] = defaultdict(set)
        for end, (length, owners) in self.automaton.iter(line):
            for number, place in owners:
                near[number].add(end + 1 - length - place)
        found, spaces = [], []
        for number, starts in near.items():
            notice = self.notices[number]
            size, spans = len(notice.text), set()
            if notice.base:  # exact check of each place to which a seed points
                for at in starts:
                    at += notice.edits == 0  # the piece of a notice without edits begins at the space before
                    if line[at - 1 : at + size + 1] == f" {notice.text} ":
                        spans.add((at, at + size, 0))
            taken, unharmed = -1, sorted(spans)
            for low, high in _windows(starts, size, notice.edits + 2):
                for match in notice.pattern.finditer(line, max(0, low), high, overlapped=False) if notice.edits else ():
                    a, b = match.span()
                    after = bisect_left(unharmed, (a, a, 0))  # unharmed places of one phrase are equally long
                    free = (after == len(unharmed) or b <= unharmed[after][0]) and (not after or unharmed[after - 1][1] <= a)
                    if a >= taken and free:
                        spans.add((a, b, sum(match.fuzzy_counts)))
                        taken = b
            if not notice.base and not notice.edits:
                spans |= {(at + 1, at + 1 + size, 0) for at in starts if line[at : at + size + 2] == f" {notice.text} "}
            if spans and not spaces:
                spaces = [m.start() for m in SPACE.finditer(line)]
            for a, b, edits in spans:
                first, last = bisect_left(spaces, a) - 1, bisect_left(spaces, b)
                found.append(Found(notice.label, notice.base, first, last, edits, size))
        return len(words), sorted(found, key=lambda f: (f.first, f.last, f.label, f.edits))


def _windows(starts: set[int], size: int, slack: int) -> list[tuple[int, int]]:
    """The stretches in which a notice may stand, given where its seeds say it starts; joined where they meet."""
    out: list[tuple[int, int]] = []
    for at in sorted(starts):
        low, high = at - slack, at + size + slack
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def scan_notices(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Notices in every row of ``docs``, from the whole text.

    ``doc_id``; ``n_words``; ``n_base``, the places of base phrases; ``first_word`` and ``last_word``, their smallest
    and largest start, or null; ``base_labels`` and ``labels``, distinct and sorted, comma-joined, empty if none;
    ``score``, 1 for an unharmed notice, less by the share of edited letters, 0 for none; ``spans``, an array of
    ``label:start:end:edits`` in characters of the text, end exclusive.

    Words are runs of digits, ASCII letters and all letters beyond ASCII, in lower case. A null text counts as
    empty. Null and repeated ids and other columns change nothing; an empty table gives an empty result.
    """

    def start():
        scanner = Scanner(base, notices)

        def work(doc_ids, texts):
            for doc_id, text in zip(doc_ids, texts, strict=True):
                n_words, found = scanner.scan(text)
                exact = [f for f in found if f.base and not f.edits]
                places = [f.first for f in exact]
                spans = []
                if found:
                    at = [m.span() for m in WORD.finditer(text.encode().lower().decode())]
                    spans = [f"{f.label}:{at[f.first][0]}:{at[f.last - 1][1]}:{f.edits}" for f in found]
                yield (
                    doc_id, n_words, len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted({f.label for f in exact})), ",".join(sorted({f.label for f in found})),
                    max((1 - f.edits / f.length for f in found), default=0.0), spans,
                )

        return work

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<string>"
    )
    return map_texts(docs.select("doc_id", text_of()), schema, start)
