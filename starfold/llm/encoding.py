"""Token ids of whole texts by a tokenizer file, with the ids of repeated pieces kept per worker.

The library encodes every piece; a piece is never cut where a token or a
pre-token could span. Pieces of a text with white space other than blanks, tabs
and line ends are not told apart: the whole text is one.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np

#: Pieces and characters in a worker's store; beyond either a new one starts, and the one before is kept to copy from.
#: Bare words come back sooner than byte-level pieces, which differ by the white space before them.
KEPT_BYTE_LEVEL, KEPT_WORDS = (500_000, 12_000_000), (150_000, 4_000_000)

_ODD = re.compile("[" + "".join(map(chr, [11, 12, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]")
_SEPARATORS = re.compile("[\x1c-\x1f]")
# white space goes with what follows; a run of Latin letters ends before a common mark
_PIECE = re.compile("[ \n\r\t]*[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+(?=[ \n\r\t,.;:!?]|\\Z)|[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
# a pre-token of letters ends before any ASCII mark or digit, whatever follows
_WORD = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+(?=[\\s!-@\\[-`{-~]|\\Z)|\\S+")
_WIDE = re.compile("[^\x00-\xff\u2010-\u2027]")  # of other characters lower case does not change the length, nor the normal form
_LATIN = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+\\Z")
# byte-level vocabularies write a byte as a letter: itself if it can be seen, else the next one from 256 on
_SEEN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_LETTER = [chr(b) if b in _SEEN else chr(256 + sum(x not in _SEEN for x in range(b))) for b in range(256)]


class _Store(dict):
    """Ids by piece; a piece asked for the first time is taken over from the store before, or encoded."""

    def __init__(self, direct: Callable[[str], bytes], older: dict[str, bytes]):
        self.direct, self.older, self.chars = direct, older, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.direct(piece)
        self[piece] = ids
        self.chars += len(piece)
        return ids


class Encoder:
    """``byte_level``: a piece goes with the white space before it; else white space and case are dropped by the tokenizer."""

    def __init__(self, path: str, byte_level: bool, kind=np.uint32):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.normalizer, self.split, self.model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.byte_level, self.kind = byte_level, np.dtype(kind)
        self.most_pieces, self.most_chars = KEPT_BYTE_LEVEL if byte_level else KEPT_WORDS
        self.kept = _Store(self.direct, {})

    def pieces(self, text: str) -> list[str]:
        if self.byte_level:
            return [text] if _ODD.search(text) else _PIECE.findall(text)
        if _SEPARATORS.search(text):
            return [text]
        return _WORD.findall(text if _WIDE.search(text) else text.lower())

    def direct(self, text: str) -> bytes:
        """Ids of one piece by the tokenizer's own steps: normalise, split, merge."""
        bare = text[1:] if self.byte_level and text[:1] == " " else text
        if _LATIN.match(bare):  # one pre-token
            plain = text if self.byte_level else text.lower()
            plain = plain.replace(" ", "\u0120") if plain.isascii() else "".join([_LETTER[b] for b in plain.encode()])
            ids = [t.id for t in self.model.tokenize(plain)]
        else:
            normal = text if self.normalizer is None else self.normalizer.normalize_str(text)
            ids = [t.id for part, _ in self.split.pre_tokenize_str(normal) for t in self.model.tokenize(part)]
        return array(self.kind.char, ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null is empty."""
        out = []
        for text in texts:
            kept = self.kept
            if len(kept) > self.most_pieces or kept.chars > self.most_chars:
                kept.older = {}
                kept = self.kept = _Store(self.direct, kept)
            ids = b"".join(map(kept.__getitem__, self.pieces(text))) if text else b""
            out.append(np.frombuffer(ids, self.kind))
        return out


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, byte_level: bool, kind=np.uint32) -> Encoder:
    """The worker's encoder for these settings; loaded once."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
    at = (path, byte_level, np.dtype(kind).str)
    if at not in _encoders:
        _encoders[at] = Encoder(path, byte_level, kind)
    return _encoders[at]
