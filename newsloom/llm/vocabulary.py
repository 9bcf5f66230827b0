"""Encoding with the tokenizers library, each distinct pre-token once.

A text of common characters is cut into pre-tokens by the vocabulary's own pattern, written for
Python's `re` over those characters, and each pre-token is encoded by the library's model and
remembered. Any other text (other scripts, control characters, marks that combine, strings of
added tokens) goes to the library whole. The tests hold both ways against the library.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

_LETTERS = "A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ž"  # each is one code point under NFC and under lower-casing
_PLAIN = re.compile(rf"[\t\n\x0b\x0c\r\x20-\x7e{_LETTERS}]*\Z")
_SUFFIXES = "'s|'t|'re|'ve|'m|'ll|'d"
_OTHERS = rf"[^\s0-9{_LETTERS}]+"
#: The two vocabularies' own patterns, over plain characters only.
_SPACED = re.compile(rf"{_SUFFIXES}| ?[{_LETTERS}]+| ?[0-9]+| ?{_OTHERS}|\s+(?!\S)|\s+")
_WORDS = re.compile(rf"{_SUFFIXES}|[{_LETTERS}]+|[0-9]|{_OTHERS}")

MEMO = 600_000


def _byte_alphabet() -> dict[int, str]:
    """Code point to the byte-level alphabet's characters for its UTF-8 bytes, for plain characters."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    shown = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0x17F)}


class Encoder(dict):
    """Pre-token to the ids of its tokens, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, memo: int = MEMO):
        from tokenizers import Tokenizer

        super().__init__()
        self.path, self.memo = path, memo
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.alphabet = _byte_alphabet()
        config = json.load(open(path, encoding="utf-8"))
        self.added = [token["content"] for token in config["added_tokens"]]
        before = config["pre_tokenizer"]
        steps = [step["type"] for step in (config["normalizer"] or {}).get("normalizers", [])]
        split = before.get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        if before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not steps:
            self.pattern, self.lower = _SPACED, False
        elif steps == ["NFC", "Replace", "Lowercase"] and split == (
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        ):
            self.pattern, self.lower = _WORDS, True
        else:
            self.pattern, self.lower = None, False  # an unknown kind: all texts go to the library whole

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.memo:
            self.clear()
        found = self.model.tokenize(piece.translate(self.alphabet))
        self[piece] = ids = array("I", [token.id for token in found]).tobytes()
        return ids

    def pieces(self, text: str) -> list[str] | None:
        """The text's pre-tokens, or None if only the library can tell."""
        if self.pattern is None or not _PLAIN.match(text) or any(token in text for token in self.added):
            return None
        return self.pattern.findall(text.lower() if self.lower else text)

    def library(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def ids(self, text: str | None) -> bytes:
        """The ids of the whole text; none for a null or empty one."""
        if not text:
            return b""
        pieces = self.pieces(text)
        if pieces is None:
            return array("I", self.library(text)).tobytes()
        return b"".join(map(self.__getitem__, pieces))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each vocabulary and worker process."""
    return Encoder(path)
