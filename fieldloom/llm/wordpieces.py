"""Ids of a public tokenizer for whole texts, each distinct word encoded once per worker."""

from __future__ import annotations

import re
import struct

import numpy as np

#: A word of unaccented or Latin-1 letters and the ASCII signs behind it: its ids are those of its
#: lower-case letters followed by those of the signs, whatever stands around it.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LONGEST_KEPT = 64
_MOST_KEPT = 600_000


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the pieces of a byte-level model."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(moved)}


_BYTE_LETTERS = _byte_letters()

_ENCODERS: dict[str, WordEncoder] = {}


class _Known(dict):
    """Ids by word; a word that is missing is handed to ``make``, which may put it in."""

    def __init__(self, make):
        super().__init__({"": b""})
        self.make = make

    def __missing__(self, word: str) -> bytes:
        return self.make(word)


class WordEncoder:
    """The ids that ``tokenizers`` gives, from ids per word.

    The tokenizer's pieces never span a blank or a line feed, so a text's ids are
    those of its parts between them.  Parts, their letters and their signs are kept in a bounded
    dictionary; a full one becomes the older one, from which what is met again comes back.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize
        self.type = "<u2" if self.tokenizer.get_vocab_size() < 1 << 16 else "<u4"
        self.code = "H" if self.type == "<u2" else "I"
        self.known = _Known(self._word)
        self.older: dict[str, bytes] = {}

    def _fresh(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype=self.type).tobytes()

    def _stem(self, stem: str) -> bytes:
        """The ids of lower-case letters, which are one piece of the text to the tokenizer."""
        if not stem.isascii():
            stem = stem.encode().decode("latin-1").translate(_BYTE_LETTERS)
        ids = [t.id for t in self.pieces(stem)]
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _word(self, word: str) -> bytes:
        if (ids := self.older.get(word)) is None:
            letters = word.rstrip(_SIGNS)
            if not (letters.isascii() and letters.isalpha() or _LETTERS.fullmatch(letters)):
                ids = self._fresh(word)
            elif (stem := letters.lower()) == word:
                ids = self._stem(word)
            else:
                ids = self.known[stem] + self.known[word[len(letters):]]
        if len(word) <= _LONGEST_KEPT:
            if len(self.known) >= _MOST_KEPT:
                self.older, self.known = self.known, _Known(self._word)
            self.known[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
