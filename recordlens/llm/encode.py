"""Whole-text tokenization with a public tokenizer file, one cache per worker.

A text is cut at single spaces and line breaks between other characters, where
the tokenizer's own pre-tokenizer also cuts; each distinct piece is encoded once
by the ``tokenizers`` library and its ids are reused.  The ids are those of the
whole text: a text with any other white space is encoded whole.
"""

from __future__ import annotations

import os
import sys
from array import array

import numpy as np

#: Memory of one generation of a worker's pieces (two are kept), and the characters up to which a piece is kept.
GENERATION_BYTES = 128 << 20
LONGEST_KEPT = 64
#: What a kept piece takes beside its characters and ids.
ENTRY_BYTES = 200

#: A piece of letters may end in one of these; the pre-tokenizer cuts before it.
_TAIL = frozenset(".,!?;:")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the others follow from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(b) if b in visible else chr(256 + rest.index(b)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()


def _plain(word: str) -> bool:
    """Letters of the Latin blocks only: one pre-token, unchanged by normalization (but for case)."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250" and "\u0130" not in word)


class _Pieces(dict):
    """Ids of pieces as bytes; a piece that is not known yet is encoded on its first use.

    The pieces met since the last turn are the dict itself, those of the turn before are ``old``: a piece that is
    used stays, one that was not used for a whole turn goes.
    """

    def __init__(self, encoder: "PieceEncoder", lead: str):
        self.encoder, self.lead, self.old, self.held = encoder, lead, {}, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._new(piece)
        if len(piece) <= LONGEST_KEPT:
            self.held += ENTRY_BYTES + len(piece) + len(ids)
            if self.held > GENERATION_BYTES:
                self.old, self.held = dict(self), 0
                self.clear()
            self[piece] = ids
        return ids

    def _new(self, piece: str) -> bytes:
        tail = self.encoder.tail.get(piece[-1:], b"")
        core = piece[:-1] if tail else piece
        if not _plain(core):
            return self.encoder.whole(self.lead + piece)
        known = self.get(core) if tail else None
        return (known or self.encoder.word(core, self.lead)) + tail


class PieceEncoder:
    """Encodes texts to ids. ``spaces`` tells whether a piece keeps its leading space."""

    def __init__(self, path: str, spaces: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True   # their strings in a text are ordinary text
        self.tokenize = self.tokenizer.model.tokenize  # each access to the model makes a new object of it
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.spaces = spaces
        self.first = _Pieces(self, "")
        self.later = _Pieces(self, " ") if spaces else self.first
        self.letter = "".join(_BYTE_LETTERS[b] for b in b" ")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.newline = self.whole("\n")
        self.tail = {c: self.whole(c) for c in _TAIL}

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def whole(self, text: str) -> bytes:
        """Ids of any text, by the library alone."""
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str, lead: str) -> bytes:
        """Ids of one pre-token of letters."""
        if not self.spaces:
            word = word.lower()
        if word.isascii():                              # letters stand for themselves
            letters = self.letter + word if lead else word
        else:
            letters = (lead + word).encode().decode("latin-1").translate(_BYTE_LETTERS)
        return self._bytes([t.id for t in self.tokenize(letters)])

    def _encode(self, text: str) -> bytes:
        later = self.later.__getitem__
        if not self.spaces:
            return b"".join([later(p) for line in text.split("\n") for p in line.split(" ") if p])
        out, words = [], 0
        for line in text.split("\n"):
            pieces = line.split(" ")
            if "" in pieces:                            # other white space than single spaces between words
                return self.whole(text)
            words += len(pieces)
            out.append(b"".join([self.first[pieces[0]], *map(later, pieces[1:])]))
        if len("".join(text.split())) != len(text) - words + 1:     # a piece holds white space of another kind
            return self.whole(text)
        return self.newline.join(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self._encode(t) if t else b"", dtype=self.dtype) for t in texts]


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaces: bool) -> PieceEncoder:
    """The worker's encoder of a tokenizer file."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = PieceEncoder(path, spaces)
    return _ENCODERS[path, spaces]
