"""Token ids of texts by a public tokenizer file.

The tokenizers used here never join characters across ASCII white space, so a text's ids are the ids of its
white-space separated pieces, one after another. A worker keeps the ids of pieces it has met lately, which
saves most of the encoding; the memory for them is bounded and no result depends on it.

`ids` encodes one text, `column` a column of them: each distinct piece of the column once, and the plain ones together.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT_PIECES = 300_000
_KEPT_BYTES = 64
# Distinct words whose parts are found together.
_TOGETHER = 1 << 16
# Texts of these letters and signs are their own NFC form and have one lower-case letter for each upper-case one.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿŒœ]*")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿœ]+|[0-9]|[^0-9a-zß-öø-ÿœ]+")
# The same for lines of one piece each; a line's end is a part of its own.
_LINES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿœ]+|[0-9]|[^\n0-9a-zß-öø-ÿœ]+")


def byte_letters() -> dict[int, str]:
    """The visible character that byte-level tokenizers write for each byte: itself, or the next free one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Recent(dict):
    """Values made by `make`, the latest one to two times `size` of them kept."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= _KEPT_BYTES:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class TextEncoder:
    """Ids of UTF-8 texts as little-endian bytes, two or four bytes an id."""

    def __init__(self, file: str, kept: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.letter = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.letter == "H" else "<u4")
        self.shown = byte_letters()
        # Only a lower-casing tokenizer that splits into letters, digits and signs is encoded part by part.
        self.by_parts = "Lowercase" in repr(self.tokenizer.normalizer) and r"[\p{L}]+|[\p{N}]|" in repr(
            self.tokenizer.pre_tokenizer
        )
        self.parts = Recent(self._part, kept)
        self.pieces = Recent(self._piece, kept)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def _part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.shown)
        return self._packed([t.id for t in self.model.tokenize(shown)])

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        if self.by_parts and _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: bytes | None) -> bytes:
        return b"".join(map(self.pieces.__getitem__, text.split())) if text else b""

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a binary column of UTF-8 texts (null: none), one text after another, and where each one's end."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, b"").view(pa.string()))
        coded = words.values.view(pa.binary()).dictionary_encode()
        taken = self._distinct(coded.dictionary).take(coded.indices)
        size = self.dtype.itemsize
        at = _offsets(taken)
        ids = np.frombuffer(taken.buffers()[2] or b"", self.dtype, at[-1] // size)
        return ids, at[_offsets(words)[1:]] // size

    def _distinct(self, words: pa.Array) -> pa.Array:
        """Packed ids of each word of a binary column without nulls."""
        if not self.by_parts:
            return pa.array(map(self.pieces.__getitem__, words.to_pylist()), pa.binary())
        some = [self._plain(words.slice(i, _TOGETHER)) for i in range(0, len(words), _TOGETHER)]
        return pa.concat_arrays(some) if some else pa.array([], pa.binary())

    def _plain(self, words: pa.Array) -> pa.Array:
        """The same for a tokenizer that encodes by parts: the parts of all plain words are found together."""
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b"\n")
        texts = lines[0].as_py().decode("utf-8", "replace").split("\n")
        other = {}
        for i, text in enumerate(texts):
            if "<|" in text or not _PLAIN.fullmatch(text):
                other[i] = self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
                texts[i] = ""
        parts = _LINES.findall("\n".join(texts).lower())
        known = self.parts
        ids = [b"" if p == "\n" else known[p] for p in parts]
        # A word's parts lie between the ends of two lines.
        ends = [0, *(i for i, p in enumerate(parts) if p == "\n"), len(parts)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        found = joined(np.frombuffer(b"".join(ids), np.uint8), np.diff(np.append(0, np.cumsum(sizes))[ends]))
        if not other:
            return found
        mask = np.zeros(len(words), bool)
        mask[list(other)] = True
        return pc.replace_with_mask(found, pa.array(mask), pa.array(list(other.values()), pa.binary()))


def joined(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose rows hold so many of the values, one row after another."""
    at = pa.array(np.append(0, np.cumsum(lengths)) * values.itemsize, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, at.buffers()[1], pa.py_buffer(values)])


def _offsets(values: pa.Array) -> np.ndarray:
    """Where the values of an unsliced binary or list array begin, and the end."""
    if not len(values):
        return np.zeros(1, np.int32)
    return np.frombuffer(values.buffers()[1], np.int32, len(values) + 1)


@lru_cache(maxsize=4)
def text_encoder(file: str, kept: int = KEPT_PIECES) -> TextEncoder:
    """One encoder per worker and tokenizer file."""
    return TextEncoder(file, kept)


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)
