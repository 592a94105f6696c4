"""Runs: stretches of words that repeat with a period at least four times, found by a suffix automaton.

Each word appended to a text has the path of its prefix in the tree of suffix links, from the longest suffix to the empty one. The
nodes of the path fall into segments whose strings ended last at one and the same word; the access
of the prefix recolours them with its own end. A segment of strings up to length l that ended last at e shows, at end i, a
square if i - e is no more than l: its l + (i - e) words have period i - e. That stretch can't begin earlier, as l is
the longest string that ended at e. The last square of a period and a start gives the run.

The access is that of a link-cut tree on the finished automaton. The paths of one access begin at the root, so on each heavy path of
the tree the segments form a stack, and an access takes off the ones it covers and puts one in their place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import map_texts, text_of

EXPONENT = 4
LEAST_LENGTH = 6
# Words that a run has in a row whose triple stands there already, at least.
LEAST_REPEATED = 3

Run = tuple[int, int, int]


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # ASCII white space only


# ------------------------------------------------------------------ suffix automaton


class Automaton:
    """Suffix automaton of a list of numbers: ``length`` and ``link`` of each state, and the state of each prefix."""

    def __init__(self, symbols: Iterable[int]) -> None:
        length, link, follow, prefix = [0], [-1], [{}], []
        last = 0
        for symbol in symbols:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            follow.append({})
            at = last
            while at >= 0 and symbol not in follow[at]:
                follow[at][symbol] = new
                at = link[at]
            if at >= 0:
                next_ = follow[at][symbol]
                if length[next_] == length[at] + 1:
                    link[new] = next_
                else:
                    twin = len(length)
                    length.append(length[at] + 1)
                    link.append(link[next_])
                    follow.append(dict(follow[next_]))
                    link[next_] = link[new] = twin
                    while at >= 0 and follow[at].get(symbol) == next_:
                        follow[at][symbol] = twin
                        at = link[at]
            prefix.append(new)
            last = new
        self.length, self.link, self.prefix = length, link, prefix

    def heads(self) -> list[int]:
        """For each state the top of its heavy path in the tree of links."""
        order = np.argsort(self.length, kind="stable").tolist()[1:]
        link = self.link
        size = [1] * len(link)
        for state in reversed(order):
            size[link[state]] += size[state]
        heavy: dict[int, int] = {}
        for state in order:
            above = link[state]
            if above not in heavy or size[state] > size[heavy[above]]:
                heavy[above] = state
        head = list(range(len(link)))
        for state in order:
            above = link[state]
            if above and heavy[above] == state:
                head[state] = head[above]
        return head


def squares(automaton: Automaton, exponent: int) -> dict[tuple[int, int], int]:
    """The last end of each ``(start, period)`` of which ``exponent`` periods or more were seen."""
    length, link, head = automaton.length, automaton.link, automaton.heads()
    stacks: dict[int, list[tuple[int, int]]] = {}
    ends: dict[tuple[int, int], int] = {}
    seen: dict[int, int] = {}
    for i, state in enumerate(automaton.prefix):
        while state > 0:
            top, covered = head[state], length[state]
            stack = stacks.setdefault(top, [])
            while stack:  # nearest to the root first
                deepest, e = stack[-1]
                longest, period = min(deepest, covered), i - e
                # Nearer to the root the same end stands again, with shorter strings.
                if (exponent - 1) * period <= longest and seen.get(period) != i:
                    seen[period] = i
                    ends[i - longest - period + 1, period] = i
                if deepest <= covered:
                    stack.pop()
                if deepest >= covered:
                    break
            stack.append((covered, i))
            state = link[top]
    return ends


def runs_in(symbols: list[int], exponent: int = EXPONENT, least: int = LEAST_LENGTH) -> list[Run]:
    """``start``, ``length`` and ``period`` of all runs of a list, by start, then period."""
    found = squares(Automaton(symbols), exponent)
    runs = ((start, end - start + 1, period) for (start, period), end in found.items())
    return sorted(((s, n, q) for s, n, q in runs if n >= max(least, exponent * q)), key=lambda r: (r[0], r[2]))


# ------------------------------------------------------------------ whole texts


def _codes(ids: np.ndarray) -> np.ndarray:
    """A number for each triple of neighbouring words, equal where the triples are."""
    many = int(ids.max()) + 1
    pairs = ids[:-1] * many + ids[1:]
    if many > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    return pairs[:-1] * many + ids[2:]


def repetitive(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (end exclusive) outside of which no word belongs to a run.

    In a run of length n and period q, the triples of n - q - 2 places in a row, 3 at least and no fewer than 3q - 2, stand q words
    earlier as well. So a run lies in the surroundings of such a row whose shortest distance is small enough.
    """
    if len(ids) < LEAST_LENGTH:
        return []
    codes = _codes(ids)
    order = np.argsort(codes, kind="stable")
    again = codes[order[1:]] == codes[order[:-1]]
    at = order[1:][again]
    if len(at) < LEAST_REPEATED:
        return []
    back = np.zeros(len(codes), np.int64)
    back[at] = at - order[:-1][again]
    rows = np.flatnonzero(np.diff(np.concatenate(([0], back > 0, [0])))).reshape(-1, 2)
    out: list[tuple[int, int]] = []
    for first, end in rows[rows[:, 1] - rows[:, 0] >= LEAST_REPEATED].tolist():
        longest = (end - first + 2) // (EXPONENT - 1)  # period
        if back[first:end].min() > longest:
            continue
        low, high = max(0, first - longest), end + 2
        while out and low < out[-1][1]:  # stretches that meet are one
            low = min(low, out.pop()[0])
        out.append((low, high))
    return out


def runs_of(words: list[bytes]) -> list[Run]:
    """All runs of a text's words with ``EXPONENT`` periods and ``LEAST_LENGTH`` words or more, by start, then period."""
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(word, len(numbers)) for word in words]
    found = []
    for low, high in repetitive(np.array(ids, np.int64)):
        found += [(low + start, length, period) for start, length, period in runs_in(ids[low:high])]
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def with_periods(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the registered query: those of every tenth document, by checksum of its id, repeat from a place on."""
    if doc_id is None or not words:
        return words
    checksum, n = zlib.crc32(str(doc_id).encode()), len(words)
    if checksum % 10:
        return words
    g = checksum // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def longest_exponent(runs: list[Run]) -> Run | None:
    """The run with the greatest length over period; of equal ones the first, then the one of the smaller period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def find_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """The runs of every row of ``docs``, from the whole text.

    ``doc_id``, ``n_words``, ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli`` (1000 · length / period, rounded down) of the run with the
    greatest exponent, or null; ``runs``, a list of ``start,length,period``; ``collapsed``, the words that no run
    repeats, joined by a space. Words are what ASCII white space separates. ``planted`` first makes every tenth text periodic.

    A null, empty or blank text has no words and no runs. Null and repeated ids and other columns change nothing (with ``planted``, a text
    without id stays as it is); an empty table gives an empty result. Memory follows the longest stretch of one
    text that repeats itself, about a kilobyte for each of its words.
    """

    def work(doc_ids, texts):
        for doc_id, text in zip(doc_ids, texts, strict=True):
            words = words_of(text)
            if planted:
                words = with_periods(words, doc_id)
            runs = runs_of(words)
            best = longest_exponent(runs)
            first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            kept = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
            yield doc_id, len(words), len(runs), *first, [f"{s},{n},{q}" for s, n, q in runs], kept

    schema = (
        "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs array<string>, collapsed string"
    )
    return map_texts(docs.select("doc_id", text_of()), schema, lambda: work)


def run_digests(found: DataFrame) -> DataFrame:
    """``find_runs`` with the SHA-256 of the runs, a line each, and of the collapsed text in their place."""
    lines = F.array_join(F.transform("runs", lambda run: F.concat(run, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
