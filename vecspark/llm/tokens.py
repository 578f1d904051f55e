"""Token ids of whole texts by a given tokenizer file, with caches per worker.

The tokenizers used here never merge across white space, nor across the pieces
that their pattern cuts a word into. A text's ids are therefore those of its
words, and a word's ids those of its pieces, one after the other. Pieces repeat
a lot: a worker remembers them, and the library's own model merges each new
one. Whatever the split could treat unlike the library
(special strings, the four separators that only Python counts as white space,
characters outside the Latin blocks) is encoded whole by the library.
"""

from __future__ import annotations

import os
import re
import struct

from .worker import kept

REMEMBERED = 300_000        # pieces of each of two generations in a worker
LONGEST = 48                # longer pieces and words are encoded but not remembered

# The letters and numbers of the Latin blocks, the pieces of the two patterns.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_FORMS = "'s|'t|'re|'ve|'m|'ll|'d"
PIECES_DROPPED = re.compile(rf"{_FORMS}|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
PIECES_SPACED = re.compile(rf"{_FORMS}| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")

_WORDS_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_STOPS = frozenset(",.;:!?)")
_BEYOND_LATIN = re.compile("[^\t\n\x0b\x0c\r -~¡-įı-ɏ‐-‧‰-⁞€]")

#: Byte-level models name a byte by a character: the printable ones by themselves, the rest from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_NAMES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
BLANK_NAME = chr(BYTE_NAMES[32])


class Remembered:
    """A bounded map of two generations: what is used lately stays."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.young, self.old = most, {}, {}

    def get_all(self, keys: list) -> tuple[list, list[int]]:
        """The value of every key, and the places of those that are not known."""
        found = list(map(self.young.get, keys))
        if None not in found:
            return found, []
        missing = [i for i, v in enumerate(found) if v is None]
        if self.old:
            unknown = []
            for i in missing:
                value = self.old.get(keys[i])
                if value is None:
                    unknown.append(i)
                else:
                    found[i] = value
                    self.put(keys[i], value)
            missing = unknown
        return found, missing

    def put(self, key: str, value) -> None:
        if len(key) > LONGEST:
            return
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[key] = value


class Known(dict):
    """The value of every key, by ``value`` where it is not known; bounded like ``Remembered``, and as quick to ask as a dict."""

    def __init__(self, value, most: int = REMEMBERED):
        super().__init__()
        self.value, self.most, self.old = value, most, {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.value(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class UnitEncoder:
    """Encodes texts piece by piece.

    ``spaced``: a single space before a word belongs to the word (the byte-level
    tokenizer); else white space only separates, and words are lower-cased.
    ``value`` turns a list of ids into what is remembered, ``joined`` puts such
    values together. ``frequent`` is a first tier of known pieces. Where white
    space only separates, whole words are remembered too, and only unknown ones
    are cut into pieces.
    """

    def __init__(self, path: str, spaced: bool, value, joined, frequent: dict | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.spaced, self.value, self.joined = spaced, value, joined
        self.pattern = PIECES_SPACED if spaced else PIECES_DROPPED
        self.frequent = frequent or {}
        self.pieces = Remembered()
        self.words = Known(self.pieces_of)

    def encode(self, text: str | None):
        """The joined value of a whole text; null counts as empty."""
        if not text:
            return self.joined([])
        if _ODD_SPACE.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        cased = text if self.spaced else text.lower()
        if _BEYOND_LATIN.search(cased) is None:
            return self.joined(self.values(self.pattern.findall(cased)) if self.spaced else map(self.words.__getitem__, cased.split()))
        words = _WORDS_SPACED.findall(text) if self.spaced else text.split()
        return self.joined([self.word(w) for w in words])

    def whole(self, text: str):
        return self.value(self.library.encode(text, add_special_tokens=False).ids)

    def word(self, word: str):
        cased = word if self.spaced else word.lower()
        if _BEYOND_LATIN.search(cased):
            return self.whole(word)
        return self.joined(self.values(self.pattern.findall(cased))) if self.spaced else self.words[cased]

    def pieces_of(self, word: str):
        """The value of a word's pieces, which are words themselves."""
        if word.isalpha():
            return self.merged(word)
        if word[:-1].isalpha() and word[-1] in _STOPS:
            return self.joined((self.words[word[:-1]], self.words[word[-1]]))
        pieces = self.pattern.findall(word)
        return self.merged(word) if len(pieces) == 1 else self.joined(map(self.words.__getitem__, pieces))

    def merged(self, piece: str):
        """The value of one piece, by the library's model."""
        # printable ASCII is named by itself but for the blank
        named = (piece.replace(" ", BLANK_NAME) if piece.isascii() and piece.isprintable()
                 else piece.encode().decode("latin-1").translate(BYTE_NAMES))
        return self.value([t.id for t in self.model.tokenize(named)])

    def values(self, pieces: list[str]) -> list:
        if self.frequent:
            found = list(map(self.frequent.get, pieces))
            if None not in found:
                return found
            rest = [i for i, v in enumerate(found) if v is None]
            for i, value in zip(rest, self.remembered([pieces[i] for i in rest])):
                found[i] = value
            return found
        return self.remembered(pieces)

    def remembered(self, pieces: list[str]) -> list:
        found, missing = self.pieces.get_all(pieces)
        for i in missing:
            found[i] = value = self.merged(pieces[i])
            self.pieces.put(pieces[i], value)
        return found


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def ids_of(text: str | None, path: str) -> bytes:
    """A text's ids (as ``id_bytes``), no special tokens added."""
    return kept(f"ids {path}", lambda: UnitEncoder(path, False, id_bytes, b"".join)).encode(text)
