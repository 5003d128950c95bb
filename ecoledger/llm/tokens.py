"""Token ids of whole texts, with each distinct piece of text encoded once per worker.

A byte-level vocabulary starts a new word at every space that is followed by a visible
character, and a vocabulary of whole words drops white space. Text can therefore be cut
there, and the ids of its pieces put together are the ids of the text. Texts where that
does not hold (runs of spaces, unusual separators) are encoded in one piece.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array

from ecoledger.llm.common import worker_state

# Pieces of each of two generations that a worker keeps: when the younger is full it
# becomes the older, and the older goes. A piece in use stays.
KEPT_PIECES = 300_000
_ODD_SPACE = re.compile(r" (?![\w!-/:-@\[-`{-~])")
_LINE_SPACE = ("\n", "\t", "\r")
_MARKS = ".,;:!?#$%&*"


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + n)
    return table


class _Pieces(dict):
    """Piece of text -> its ids as little-endian bytes, encoded when first asked for."""

    def __init__(self, tokenizer, dtype: str, lead: str, whole_words: bool, kept: int):
        super().__init__()
        self.kept = kept
        self.tokenizer, self.lead, self.whole_words = tokenizer, lead, whole_words
        self.code = "H" if dtype == "<u2" else "I"
        self.tokens_of = tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.shown_lead = lead.translate(self.letters)
        self.older: dict[str, bytes] = {}
        self.line_starts = self

    def _bytes(self, ids) -> bytes:
        held = array(self.code, ids)
        if sys.byteorder == "big":
            held.byteswap()
        return held.tobytes()

    def ids_of(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str, plain: bool) -> bytes:
        """Ids of a piece of letters only: it is one word, so the model alone is asked."""
        if self.whole_words:
            word = word.lower() if plain else unicodedata.normalize("NFC", word).lower()
        # letters of ASCII stand for their own bytes
        shown = word if plain else word.encode().decode("latin-1").translate(self.letters)
        return self._bytes([token.id for token in self.tokens_of(self.shown_lead + shown)])

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        # lower case beyond the Latin letters may depend on neighbours; those take the full path
        if ids is None and ((plain := piece.isascii()) or not self.whole_words or max(piece) < "\u0130"):
            if piece.isalpha():
                ids = self._word(piece, plain)
            else:
                # marks after a word are one word of their own
                stem = piece.rstrip(_MARKS)
                if stem != piece and stem.isalpha():
                    again = stem in self
                    ids = self[stem] + self.line_starts[piece[len(stem) :]]
                    # with its marks a word is kept once it comes again
                    if not again:
                        return ids
                else:
                    # one line break between visible characters is a word of its own
                    left, newline, right = piece.partition("\n")
                    if left and right and not left[-1].isspace() and not right[0].isspace():
                        return self[left] + self.line_starts[newline] + self.line_starts[right]
        if ids is None:
            ids = self.ids_of(self.lead + piece)
        if len(self) >= self.kept:
            self.older = self.copy()
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of texts by one vocabulary file; ``dtype`` is the narrowest that holds every id.

    ``kept`` pieces of each generation stay in memory, KEPT_PIECES if it is not given.
    """

    def __init__(self, path: str, kept: int | None = None):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # words are kept here; the library's own cache of them would cost a lock and a copy a word
        tokenizer.model._resize_cache(0)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.dtype = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.whole_words = bool(spec["model"].get("end_of_word_suffix"))
        self.first = _Pieces(tokenizer, self.dtype, "", self.whole_words, kept or KEPT_PIECES)
        self.spaced = self.first if self.whole_words else _Pieces(tokenizer, self.dtype, " ", False, kept or KEPT_PIECES)
        self.spaced.line_starts = self.first

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text as little-endian bytes; nothing for null or empty."""
        if not text:
            return b""
        if self.whole_words:
            for space in _LINE_SPACE:
                text = text.replace(space, " ")
            return b"".join(map(self.first.__getitem__, text.split(" ")))
        if _ODD_SPACE.search(text):
            return self.first.ids_of(text)
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.spaced.__getitem__, rest))


def encoder(path: str, kept: int | None = None) -> Encoder:
    """This worker's encoder for a vocabulary file, which keeps ``kept`` pieces of a generation."""
    return worker_state(f"encoder:{path}:{kept}", lambda: Encoder(path, kept))
