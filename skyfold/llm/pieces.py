"""Token ids of texts from a word-end BPE file of the tokenizers library, with the pieces' ids kept.

The file's normaliser (NFC, white space to blanks, lower case) and pre-tokenizer act within white-space-separated
chunks, and BPE within pieces of those. Texts of Latin letters, digits, ASCII and common punctuation are therefore
looked up chunk by chunk; the library's model codes each piece once per worker. Any other text, and any that holds a
special token's opening, goes through the library as a whole.
"""

from __future__ import annotations

import re

import numpy as np
import regex
from tokenizers import Tokenizer

#: The pre-tokenizer's pattern.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN = re.compile("[\t-\r -~\xa1-įı-ɏ‐-‧€]*")
ODD_BLANKS = re.compile("[\x1c-\x1f]")
KEPT = 400_000


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Bounded(dict):
    """Computes missing values and starts anew when it holds ``KEPT`` of them."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= KEPT:
            self.clear()
        self[key] = value
        return value


class Coder:
    """Little-endian 32-bit ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.pieces = Bounded(self._piece)
        self.chunks = Bounded(self._chunk)

    def _piece(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self.pieces[p] for p in PIECE.findall(chunk)])

    def ids(self, text: str) -> bytes:
        plain = not ODD_BLANKS.search(text) if text.isascii() else PLAIN.fullmatch(text)
        if not plain or "<|" in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        chunks = self.chunks
        return b"".join([chunks[c] for c in text.lower().split()])


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's coder for a tokenizer file."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]
