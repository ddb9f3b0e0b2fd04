"""A BPE vocabulary and exact encoding by dynamic programming over prefixes.

An automaton over the vocabulary reports, for every prefix of a word, each token that is a
suffix of it. Exactly one of them is the last token of the prefix's encoding: the one that
may follow the last token of what remains in front of it. Two tokens may follow each other
if no merge across their border comes before the merges that build them, which the chains
of their halves tell. Storing the last token of every prefix gives the ids by following
back-pointers, and the token count of every prefix as a by-product.
"""

from __future__ import annotations

import hashlib
import json
import re

import ahocorasick
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

# Fixed value: the characters that are white space for the tokenizers (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters that no normal form changes, and ASCII signs but the apostrophe.
LETTERS = r"A-Za-zÀ-ÖØ-öø-ÿ"
SIGNS = r"!-&(-@\[-`{-~"

# Pieces of a text whose encodings, one behind the other, are the encoding of the text.
# Where white space is dropped, a cut lies at white space and between letters and signs.
DROPPED = re.compile(
    rf"[{LETTERS}]+(?=[{SPACE}{SIGNS}]|\Z)|[{SIGNS}]+(?=[{SPACE}{LETTERS}]|\Z)|[^{SPACE}]+"
)
# Where a space belongs to the word behind it, a cut also lies before a single space between
# visible characters and before a single line feed; all else stays in one piece.
JOINED = re.compile(
    rf"(?: |(?<![{SPACE}])\n)?[{LETTERS}]+(?=[ \n][!-~{LETTERS}]|[{SIGNS}]|\Z)"
    rf"| ?[{SIGNS}]+(?=[ \n][!-~{LETTERS}]|[{LETTERS}]|\Z)"
    rf"|[\s\S]+?(?=(?<=[!-~{LETTERS}]) [!-~{LETTERS}]|\Z)"
)
PLAIN = re.compile(f"[{LETTERS}]+")
END = "\0"  # stands for the mark at the end of a word
NEVER = 1 << 60

CACHED_PIECES = 200_000
CACHED_PAIRS = 300_000


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _byte_letters()


class Vocabulary:
    """Encodes by prefixes; the library file gives vocabulary, merges and text cleaning."""

    def __init__(self, text: str):
        data = json.loads(text)
        model = data["model"]
        self.library = Tokenizer.from_str(text)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.strings = {i: s for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        self._splits = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.lowers = data["normalizer"] is not None
        self.pieces = DROPPED if self.lowers else JOINED
        self.joined_by = " " if data["decoder"] is None else None
        ids = {self._plain(s): i for s, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._halves: dict[int, tuple[int, int]] = {}
        self._rank: dict[int, int] = {}
        self._born: dict[int, int] = {}
        for rank, (left, right) in enumerate(pairs):
            a, b = ids[self._plain(left)], ids[self._plain(right)]
            made = ids[self._plain(left) + self._plain(right)]
            if made in self._halves or max(self._born.get(a, -1), self._born.get(b, -1)) >= rank:
                raise ValueError(f"merge {rank} does not build a new token from earlier ones")
            self._halves[made], self._born[made] = (a, b), rank
            self._rank[a << 32 | b] = rank
        self._automaton = ahocorasick.Automaton()
        self._sound: dict[int, bool] = {}
        for string, i in ids.items():
            if self._builds_itself(i):
                self._automaton.add_word(string, (i, len(string)))
        self._automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self.most_pairs = CACHED_PAIRS
        self._cache: dict[str, object] = {}

    def _plain(self, string: str) -> str:
        """A vocabulary string with the word-end mark as one letter."""
        if self.suffix and string.endswith(self.suffix) and len(string) > len(self.suffix):
            return string[: -len(self.suffix)] + END
        return string

    def _chain(self, token: int, side: int, until: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge of a token while it is built, and their ends."""
        out = [(token, until)]
        while token in self._halves:
            until, token = self._born[token], self._halves[token][side]
            out.append((token, until))
        return out

    def _crossed(self, left: int, right: int, until: int) -> bool:
        """Whether a merge across the border comes before both sides are built."""
        ends = self._chain(right, 0, until)
        for x, x_until in self._chain(left, 1, until):
            for y, y_until in ends:
                rank = self._rank.get(x << 32 | y)
                # Of equal merges the leftmost comes first: one inside the left token wins,
                # one inside the right token loses.
                if rank is None or rank >= x_until:
                    continue
                if rank < y_until or rank == y_until < until:
                    return True
        return False

    def _builds_itself(self, token: int) -> bool:
        """Whether the encoding of a token's string is that token."""
        known = self._sound.get(token)
        if known is None:
            if token not in self._halves:
                known = True
            else:
                left, right = self._halves[token]
                known = (
                    self._builds_itself(left)
                    and self._builds_itself(right)
                    and not self._crossed(left, right, self._born[token])
                )
            self._sound[token] = known
        return known

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= self.most_pairs:
                self._pairs.clear()
            known = self._pairs[key] = not self._crossed(left, right, NEVER)
        return known

    def last_tokens(self, word: str) -> list[tuple[int, int] | None]:
        """For each prefix of a word (in byte letters) its last token and that one's length."""
        last: list[tuple[int, int] | None] = [None] * (len(word) + 1)
        pairs = self._pairs
        for end, found in self._automaton.iter(word):
            if last[end + 1] is None:
                before = end + 1 - found[1]
                if before == 0:
                    last[end + 1] = found
                elif (left := last[before]) is not None:
                    fits = pairs.get(left[0] << 32 | found[0])
                    if fits is None:
                        fits = self.may_follow(left[0], found[0])
                    if fits:
                        last[end + 1] = found
        return last

    def word_ids(self, word: str) -> list[int]:
        """The ids of one word, by back-pointers."""
        if self.suffix:
            word += END
        last, at, out = self.last_tokens(word), len(word), []
        while at:
            token, size = last[at]
            out.append(token)
            at -= size
        return out[::-1]

    def words(self, piece: str) -> list[str]:
        """Words of a piece, in byte letters, as the library cleans and splits it."""
        if self.lowers and PLAIN.fullmatch(piece):
            shown = piece.lower()
            return [shown if piece.isascii() else "".join(_SHOWN[b] for b in shown.encode())]
        if self.library.normalizer is not None:
            piece = self.library.normalizer.normalize_str(piece)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(piece)]

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """Parts of a text between special tokens, and those tokens with their ids."""
        if not any(s in text for s in self.special):
            return [(text, None)]
        return [(p, self.special.get(p)) for p in self._splits.split(text) if p]

    def cached(self, pieces: list[str], make) -> list:
        """``make(ids)`` of each piece; each distinct piece is encoded once while it is kept."""
        cache = self._cache
        try:
            return [cache[p] for p in pieces]
        except KeyError:
            pass
        if len(cache) >= CACHED_PIECES:
            cache.clear()
        out = []
        for piece in pieces:
            value = cache.get(piece)
            if value is None:
                ids = [i for w in self.words(piece) for i in self.word_ids(w)]
                value = make(ids)
                if len(piece) < 256:
                    cache[piece] = value
            out.append(value)
        return out

    def ids(self, text: str) -> list[int]:
        """The ids of a whole text, without added tokens."""
        out: list[int] = []
        for part, special in self.segments(text):
            if special is not None:
                out.append(special)
                continue
            for piece in self.pieces.findall(part):
                for word in self.words(piece):
                    out += self.word_ids(word)
        return out


_loaded: dict[tuple[str, str], Vocabulary] = {}


def share(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file, read by the driver and sent to every executor."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def load(shared: Broadcast, use: str) -> Vocabulary:
    """The vocabulary in this worker; ``use`` keeps the caches of operators apart."""
    key = (hashlib.sha256(shared.value.encode()).hexdigest(), use)
    if key not in _loaded:
        _loaded[key] = Vocabulary(shared.value)
    return _loaded[key]
