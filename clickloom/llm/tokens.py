"""Token ids of whole texts with public tokenizers, inside tasks."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Words an encoder remembers, about 250 bytes each. Others are encoded anew.
REMEMBERED = 450_000
#: Bytes of text whose different words are looked up together; the larger, the fewer
#: look-ups. About 12 bytes of memory each.
PORTION = 3 * 1024 * 1024


class Encoder:
    """Encodes texts word by word and remembers the ids of words.

    Both tokenizers cut a text before every single space or line break, and between
    letters and a sign, so the ids of a text are those of its words in a row. Texts with
    other white space go to the tokenizer whole. Ids are unsigned 32-bit little-endian
    bytes.
    """

    def __init__(self, name: str, remembered: int = REMEMBERED, portion: int = PORTION):
        self.portion = portion
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words = _Words(self._whole, self._letters, remembered)
        self.model = self.tokenizer.model
        self.space = " " if self._whole(" a") != self._whole("a") else ""
        self.breaks = len(self._whole("\n")) // 4
        self.lower = self._whole("A") == self._whole("a")

    def _whole(self, text: str) -> bytes:
        ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        return ids.tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a word of Latin letters behind a space: the model alone, for speed."""
        word = self.space + (word.lower() if self.lower else word)
        known = word.encode().decode("latin-1").translate(_ALPHABET)
        return array("I", [token.id for token in self.model.tokenize(known)]).tobytes()

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text])))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of every text, null as empty; about a portion of text at once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + self.portion, "right")))
            yield from self._portion(texts.slice(at, end - at))
            at = end

    def _portion(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)
        # a line break in front makes the first word like any other
        spaced = pc.replace_substring(plain, "\n", " \n")
        front, nothing = (pa.scalar(x, pa.large_string()) for x in ("\n", ""))
        pieces = pc.split_pattern(pc.binary_join_element_wise(front, spaced, nothing), " ")
        words = pieces.flatten().dictionary_encode()
        known = list(map(self.words.__getitem__, words.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // 4
        ids = np.frombuffer(b"".join(known), "<u4")
        index = words.indices.to_numpy()
        counts = sizes[index]
        ends = np.cumsum(counts, dtype=np.int32)  # a text has less than 2**31 bytes
        first = (np.cumsum(sizes, dtype=np.int32) - sizes)[index] - (ends - counts)
        at = np.repeat(first, counts)
        at += np.arange(ends[-1], dtype=np.int32)
        found = ids[at]
        borders = np.concatenate([[0], ends])[pieces.offsets.to_numpy()]
        for i in range(len(texts)):
            if odd[i]:
                yield self._whole(texts[i].as_py())
            else:
                yield found[borders[i] + self.breaks : borders[i + 1]].tobytes()


def _alphabet() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes in order for
    characters from 256 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (byte for byte in range(256) if byte not in visible)
    return {byte: 256 + place for place, byte in enumerate(others)}


_ALPHABET = _alphabet()
#: Letters below this one are the same in all versions of Unicode.
_LATIN_END = "\u0250"
#: White space but for blanks and line breaks, or two in a row.
_ODD_SPACE = (
    r"[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]"
)


def _letters_only(word: str) -> bool:
    """Letters, in lower case too: a dotted capital I becomes a letter and a mark."""
    return word.isalpha() and word.lower().isalpha()


#: Signs that are a word of their own behind letters.
_SIGNS = ".,;:!?"


class _Words(dict):
    """Ids of words that follow a space or start with a line break."""

    def __init__(self, encode, letters, remembered: int):
        self.encode, self.letters, self.remembered = encode, letters, remembered
        self.signs = {sign: encode(sign) for sign in _SIGNS}

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            plain = word.isascii() or (max(word) < _LATIN_END and word.lower().isalpha())
            ids = self.letters(word) if plain else self.encode(" " + word)
        elif word[-1:] in self.signs and _letters_only(word[:-1]):
            ids = self[word[:-1]] + self.signs[word[-1]]
        else:
            ids = self.encode(word if word[:1] == "\n" else " " + word)
        if len(self) < self.remembered:
            self[word] = ids
        return ids


@cache
def encoder(name: str, remembered: int = REMEMBERED, portion: int = PORTION) -> Encoder:
    """One encoder for a Python worker."""
    return Encoder(name, remembered, portion)
