"""Token ids of whole texts, from vocabulary files of the tokenizers library.

``Encoder`` gives the ids of ``Tokenizer.encode(text, add_special_tokens=False)``
for vocabularies that lower-case, split off white space, letters, single digits
and other signs, and mark word ends. Such a vocabulary never merges across two
pieces, so ids are looked up piece by piece; each distinct piece is given to the
library once per Python worker. Texts outside plain Latin letters are cut at
blanks only, and any text that might name a special token goes to the library
as a whole.
"""

import functools
import re

import numpy as np

#: Pieces kept per worker; beyond it the store is emptied and filled anew.
KEPT_PIECES = 1_000_000

_UNUSUAL = re.compile("[^\\x20-\\x7e\\t\\n\\r\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\\xdf-\\xf6\\xf8-\\xff]+|[0-9]|[^\\sa-z0-9\\xdf-\\xf6\\xf8-\\xff]+")
_LETTERS = re.compile("[a-z\\xdf-\\xf6\\xf8-\\xff]+")


def _byte_letters():
    """Byte to the sign that byte-level vocabularies write for it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + n) for n, b in enumerate(others)}}


class Encoder(dict):
    """Piece of text to its ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, path):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.by_pieces = self._splits_as_assumed()

    def _splits_as_assumed(self):
        """Whether the file's own rules are those the piece patterns follow."""
        import json

        rules = json.loads(self.library.to_str())
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        split = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        return (steps == ["NFC", "Replace", "Lowercase"]
                and split == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __missing__(self, piece):
        if len(self) >= KEPT_PIECES:
            self.clear()
        if self.by_pieces and _LETTERS.fullmatch(piece):
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            found = [t.id for t in self.model.tokenize(spelled)]
        else:
            found = self._whole(piece)
        self[piece] = packed = np.array(found, "<u4").tobytes()
        return packed

    def _whole(self, text):
        return self.library.encode(text, add_special_tokens=False).ids

    def pieces(self, text):
        """Keys of this store whose ids, joined, are those of the text."""
        if not self.by_pieces or "<|" in text:
            return [text] if text else []
        if _UNUSUAL.search(text):
            return text.split(" ")
        return _PIECES.findall(text.lower())

    def ids(self, text):
        """The text's ids as bytes; none for a null or empty text."""
        if not text:
            return b""
        if not self.by_pieces or "<|" in text:
            return np.array(self._whole(text), "<u4").tobytes()
        return b"".join(map(self.__getitem__, self.pieces(text)))


@functools.lru_cache(maxsize=2)
def encoder(path):
    """The encoder of a vocabulary file, one per Python worker."""
    return Encoder(path)
