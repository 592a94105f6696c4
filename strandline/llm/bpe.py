"""BPE encoding by dynamic programming over prefixes, and decoding.

For each prefix of a piece of text exactly one token can be the last one of its encoding. A token that ends there
(an automaton finds them all) is that one if it may follow the last token of the prefix before it. Whether a token
may follow another is decided by the merge rules alone. So one pass stores a token for every prefix, and
following them back from the end gives the ids; time grows linearly with a piece's length.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from hashlib import sha256

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import kept, map_texts, text_of

# Pieces of text whose ids a worker remembers before it starts anew, with the full memory as a second one, and the
# longest piece it does remember.
MEMORY_PIECES = 50_000
MEMORY_LENGTH = 48
# Pairs of tokens whose compatibility it remembers.
MEMORY_PAIRS = 200_000

# Fixed value: how the byte-level vocabulary cuts text into pieces before the merges.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

# The same cut for text within Latin-1, by the faster standard library: its letters, numbers and white space.
_LETTERS = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = r"\t-\r \x85\xa0"
LATIN_PIECES = re.compile(
    rf" ?[{_LETTERS}]+|'(?:[smdt]|re|ve|ll)| ?[{_NUMBERS}]+| ?[^{_LETTERS}{_NUMBERS}{_SPACES}]+"
    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
OUTSIDE_LATIN = re.compile(r"[^\x00-\xff]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 letters stand for themselves; the other bytes take the letters from 256 on, in order.
    """
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return letters


class SuffixStates:
    """An automaton whose state is the longest end of the text so far that begins some token.

    ``ends`` has, for each state, all tokens that end there with their lengths, longest first. States and steps
    are made when a text first needs them.
    """

    def __init__(self, tokens: dict[str, int]) -> None:
        self.tokens = tokens
        self.begun = {text[:k] for text in tokens for k in range(1, len(text) + 1)}
        self.numbers: dict[str, int] = {"": 0}
        self.names = [""]
        self.ends: list[tuple[tuple[int, int], ...]] = [()]
        self.steps: dict[tuple[int, str], int] = {}

    def step(self, state: int, letter: str) -> int:
        name = self.names[state] + letter
        while name not in self.begun:
            name = name[1:]
        if name not in self.numbers:
            self.numbers[name] = len(self.names)
            self.names.append(name)
            tails = [name[k:] for k in range(len(name))]
            self.ends.append(tuple((self.tokens[t], len(t)) for t in tails if t in self.tokens))
        self.steps[state, letter] = self.numbers[name]
        return self.numbers[name]


class Codec:
    """Encoder and decoder for one byte-level BPE vocabulary, from the text of its JSON file."""

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        model, letters = data["model"], byte_letters()
        self.text_of_id: dict[int, bytes] = {
            number: bytes(letters[c] for c in token) for token, number in model["vocab"].items()
        }
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.text_of_id |= {number: content.encode() for content, number in self.special.items()}
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pieces = regex.compile(PIECES)
        # A merge's rank is its place in the list. parts: of a token, the rank that makes it and its halves.
        self.merge: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        vocab = model["vocab"]
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            self.merge[vocab[left], vocab[right]] = rank
            self.parts.setdefault(made, (rank, vocab[left], vocab[right]))
        tokens = {n: self.text_of_id[n].decode("latin-1") for n in vocab.values()}
        tokens = {n: text for n, text in tokens.items() if len(text) == 1 or n in self.parts}
        self.width = {n: len(text) for n, text in tokens.items()}
        self.states = SuffixStates({text: n for n, text in tokens.items()})
        self.edges: dict[int, tuple[list, list]] = {}
        self.known: dict[int, bool] = {}
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _edges(self, token: int) -> tuple[list, list]:
        """The tokens along the left and the right edge of ``token``, from its byte up, each with the
        rank at which it is merged into the next one."""
        if token not in self.edges:
            sides: tuple[list, list] = ([], [])
            for side, edge in enumerate(sides):
                at, ends = token, float("inf")
                while True:
                    edge.append((at, ends))
                    if at not in self.parts:
                        break
                    ends, *halves = self.parts[at]
                    at = halves[side]
                edge.reverse()
            self.edges[token] = sides
        return self.edges[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of both texts together is just these two tokens.

        Merges happen in the order of their ranks. At any rank one token of ``left``'s right edge touches one
        of ``right``'s left edge. The two tokens stay apart unless a rule joins such a pair before one of
        them has been merged away; of equal ranks the place further left goes first.
        """
        before, after = self._edges(left)[1], self._edges(right)[0]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = before[i], after[j]
            rank = self.merge.get((x, y))
            if rank is not None and rank < x_ends and rank <= y_ends:
                apart = False
                break
            if i + 1 == len(before) and j + 1 == len(after):
                apart = True
                break
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        self.known[left << 20 | right] = apart
        return apart

    def encode_pieces(self, pieces: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each piece (its bytes as Latin-1 letters) with its packed ids.

        In sorted order a piece shares its first prefixes with the one before it; what is stored for those
        is used again.
        """
        known, steps, ends, widths = self.known, self.states.steps, self.states.ends, self.width
        states, last, before = [0], [-1], ""
        for piece in sorted(pieces):
            shared = 0
            for a, b in zip(piece, before, strict=False):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :], last[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, len(piece) + 1):
                letter = piece[end - 1]
                state = steps.get((state, letter)) or self.states.step(state, letter)
                for token, width in ends[state]:
                    if width == end:
                        break
                    pair = last[end - width] << 20 | token
                    if known[pair] if pair in known else self.may_follow(last[end - width], token):
                        break
                else:  # a vocabulary that lacks a byte
                    raise ValueError(f"no token ends the first {end} bytes of a piece")
                states.append(state)
                last.append(token)
            before, end, ids = piece, len(piece), []
            while end:
                token = last[end]
                ids.append(token)
                end -= widths[token]
            ids.reverse()
            yield piece, array("I", ids).tobytes()

    def _cut(self, text: str) -> list[str]:
        return (self.pieces if OUTSIDE_LATIN.search(text) else LATIN_PIECES).findall(text)

    def _split(self, text: str) -> list[str]:
        """Pieces and special tokens, in order."""
        if not self.specials or not self.specials.search(text):
            return self._cut(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [*self._cut(text[at : found.start()]), found.group()]
            at = found.end()
        return out + self._cut(text[at:])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each, lowest byte first. Special tokens in a text are one id each."""
        split = [self._split(text) for text in texts]
        if len(self.memory) >= MEMORY_PIECES:
            self.older, self.memory = self.memory, {}
        if len(self.known) >= MEMORY_PAIRS:
            self.known.clear()
        memory = self.memory
        new = set().union(*split).difference(memory)
        memory |= {piece: self.special[piece].to_bytes(4, "little") for piece in new if piece in self.special}
        memory |= {piece: self.older[piece] for piece in new if piece in self.older}
        new.difference_update(memory)
        octets = {piece if piece.isascii() else piece.encode().decode("latin-1"): piece for piece in new}
        memory.update((octets[piece], packed) for piece, packed in self.encode_pieces(octets))
        out = [b"".join(map(memory.__getitem__, pieces)) for pieces in split]
        for piece in new:
            if len(piece) > MEMORY_LENGTH:
                del memory[piece]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids, special tokens included. Bytes that are no UTF-8 become U+FFFD."""
        ids = memoryview(packed).cast("I")
        return b"".join(map(self.text_of_id.__getitem__, ids)).decode("utf-8", "replace")


def codec_name(spec: str) -> str:
    """Under which a worker keeps the codec of a vocabulary from task to task, until another operator works there."""
    return f"codec {sha256(spec.encode()).hexdigest()}"


def read_spec(path: str) -> str:
    """The text of a tokenizer's JSON file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_decode(docs: DataFrame, spec: str) -> DataFrame:
    """``doc_id``, ``ids`` (packed, four bytes each, lowest byte first) and ``decoded`` for every row of ``docs``.

    ``spec`` is the text of the vocabulary file (its size does not depend on the data) and goes to the
    executors once. Map-only: no shuffle, and the whole text of each row. A null text counts as empty and has no
    ids. Rows that repeat give rows that repeat; null ids stay null; other columns are ignored; an empty table gives an empty
    result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(spec)
    name = codec_name(spec)

    def start():
        own = kept(name, lambda: Codec(sent.value))

        def work(doc_ids, texts):
            packed = own.encode_all(texts)
            return zip(doc_ids, packed, map(own.decode, packed), strict=True)

        return work

    return map_texts(docs.select("doc_id", text_of()), "doc_id long, ids binary, decoded string", start, keeps=name)


def unpack_ids(packed: Column) -> Column:
    """Packed ids as an array of long."""
    steps = F.when(F.length(packed) > 0, F.sequence(F.lit(1), F.length(packed), F.lit(4)))
    return F.coalesce(F.transform(steps, lambda at: _word(packed, at)), F.array().cast("array<bigint>"))


def _word(packed: Column, at: Column) -> Column:
    byte = [F.conv(F.hex(packed.substr(at + k, F.lit(1))), 16, 10).cast("bigint") for k in range(4)]
    return byte[0] + byte[1] * 256 + byte[2] * 65_536 + byte[3] * 16_777_216


def token_digests(coded: DataFrame) -> DataFrame:
    """Number of tokens and SHA-256 of ids and decoded text, from the result of ``encode_decode``."""
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
