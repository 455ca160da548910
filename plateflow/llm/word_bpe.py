"""Vocabulary, normalisation and pre-tokens of a word-end BPE tokenizer file.

The file is read on the driver and travels with the job, so executors need no path. Classes and
case follow the tokenizers library: where ``regex`` or Python have another Unicode version, the code
points that differ are listed below; a test compares every code point.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import regex


#: Fixed values, found by comparing every code point with the tokenizers library: what ``regex`` has as letters, and as
#: numbers, and the library as neither (first and last of each range).
NO_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
NO_NUMBERS = (
    (0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6),
)
#: Capitals that the library lower-cases and this Python does not (first, last, distance to the small letter).
MORE_CAPITALS = ((0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
                 (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27))


def _set(ranges) -> str:
    return "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b, *_ in ranges) + "]"


@dataclass(frozen=True)
class TokenizerFile:
    """The content of a tokenizer file; ``load`` builds its tables once per worker."""

    content: str

    def load(self) -> Vocabulary:
        return _tables(self.content)


def read_tokenizer(path: str) -> TokenizerFile:
    with open(path, encoding="utf-8") as file:
        return TokenizerFile(file.read())


@lru_cache(maxsize=2)
def _tables(content: str) -> Vocabulary:
    return Vocabulary(json.loads(content))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable in Latin-1, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tables of one tokenizer file: normaliser NFC, white space, lower case; BPE with word ends."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("not a word-end BPE tokenizer file")
        if any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
            raise ValueError("added tokens with options are not supported")
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token_of = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + end] for c in letters], np.int32)
        #: (left id, right id) -> (rank, id of the merged token)
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.end = end
        self.byte_of = {c: b for b, c in enumerate(letters)}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(split).findall
        # Texts with code points of the lists above are rare; they take a slower pattern.
        self._listed = re.compile(_set(NO_LETTERS)[:-1] + _set(NO_NUMBERS)[1:-1] + _set(MORE_CAPITALS)[1:]).search
        exact = split.replace(r"\p{L}", "[\\p{L}--" + _set(NO_LETTERS) + "]").replace(r"\p{N}", "[\\p{N}--" + _set(NO_NUMBERS) + "]")
        self._exact_words = regex.compile(exact, regex.V1).findall
        self._capitals = {c: c + far for a, b, far in MORE_CAPITALS for c in range(a, b + 1)}
        # Longest first, as the strings may begin alike.
        marks = sorted(map(regex.escape, self.specials), key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(marks) + ")") if marks else None

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a whole text in order; a special string is one of them, as it stands."""
        if self._special is None or not any(s in text for s in self.specials):
            return self._plain(text)
        out: list[str] = []
        for i, part in enumerate(self._special.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out += self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # Letter by letter: a final sigma is no special case here.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self._listed(text):
                return self._exact_words(text.translate(self._capitals).lower())
        return self._words(text.lower())

    def symbols(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids that pre-tokens start from, one after the other, and how many each has.

        There is one per byte, the last with the word end; a special string is one id.
        """
        coded = [b"\0" if w in self.specials else w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        data = np.frombuffer(b"".join(coded), np.uint8)
        out, last = self.inner[data], np.cumsum(sizes) - 1
        out[last] = self.final[data[last]]
        for i, word in enumerate(words):
            if word in self.specials:
                out[last[i]] = self.specials[word]
        return out, sizes

    def word_of(self, token: str) -> str | None:
        """The pre-token that a token with word end spells, if its bytes are text."""
        if not token.endswith(self.end) or len(token) == len(self.end):
            return None
        try:
            return bytes(self.byte_of[c] for c in token[: -len(self.end)]).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            return None
