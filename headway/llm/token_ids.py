"""Token ids of whole texts by the tokenizers library, as bytes.

Byte-pair vocabularies split a text into pieces before they merge inside each piece, so
equal pieces have equal ids. For the two kinds of splitting known here, texts of common
Latin characters are cut into the same pieces by a pattern; the library's model encodes
each piece when a worker first meets it, and the worker remembers it. All other texts, texts
that hold an added token of the vocabulary, and all texts under other kinds of splitting, are
encoded by the library in one go, called with ``add_special_tokens=False`` and nothing else.

Ids are little-endian unsigned 32-bit integers. A null text counts as empty and has no ids.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np
from tokenizers import Tokenizer

#: Pieces that a worker remembers of each of two generations, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 350_000, 48

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_SPACES = " \t\n\r\x0b\x0c"
#: Texts of these characters only are cut by pattern. All letters among them are composed
#: and have a lower case of one character.
_COMMON = re.compile(f"[\x00-\x1b\x20-\x7f{_LETTERS}]*")
#: The endings that both kinds of splitting set apart.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Pieces with the space before them, as in byte-level vocabularies.
_SPACED = re.compile(
    f" ?[{_LETTERS}]+|{_ENDINGS}| ?[0-9]+| ?[^{_SPACES}{_LETTERS}0-9]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
#: Pieces without white space and with single digits, in lower case.
_WORDS = re.compile(f"[{_LETTERS}]+|{_ENDINGS}|[0-9]|[^{_SPACES}{_LETTERS}0-9]+")
#: Texts that must come out equal both ways before a file is read by pattern.
_PROBES = ["", " ", "It's  a\n\ntest, isn't it? 1234 x", "ÉTÉ d'été !!  <|endoftext|>\t", "a  b \n c'd've'S 'Ll"]


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if it is printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Known(dict):
    """Ids by piece. A piece not met lately is encoded when it is asked for."""

    def __init__(self, model) -> None:
        super().__init__()
        self.model, self.older = model, {}
        self.characters = _byte_characters()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            if piece.isascii() and piece.isprintable():  # of these, only the space is written otherwise
                symbols = piece.replace(" ", self.characters[32])
            else:
                symbols = piece.encode("utf-8").decode("latin-1").translate(self.characters)
            found = [t.id for t in self.model.tokenize(symbols)]
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """A tokenizer file with the ids of the pieces met so far."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        added = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.known = Known(self.library.model)
        with open(path, encoding="utf-8") as file:
            self.lower = bool(json.load(file).get("normalizer"))
        self.pattern = _WORDS if self.lower else _SPACED
        if self.encode(_PROBES) != self.whole(_PROBES):
            self.pattern = None

    @property
    def width(self) -> int:
        """Bytes that hold every id of the vocabulary: 2 or 4."""
        return 2 if max(self.library.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids by the library alone."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        others = []
        ids_of = self.known.__getitem__
        for i, text in enumerate(texts):
            if self.pattern is None or not _COMMON.fullmatch(text) or (self.added and self.added.search(text)):
                others.append(i)
                continue
            pieces = self.pattern.findall(text.lower() if self.lower else text)
            out[i] = b"".join(map(ids_of, pieces))
        if others:
            for i, ids in zip(others, self.whole([texts[i] for i in others])):
                out[i] = ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
