"""Encoding with public byte-pair tokenizers, with each distinct word encoded once.

Byte-pair merges never cross a pre-token, so a text's ids are the joined ids
of its pre-tokens. For the two pre-tokenizers whose split we can state exactly
over code points below 256, texts of such code points are split here and each
distinct pre-token goes to the tokenizers library once per cache fill. Other
texts, those that hold an added token (which the library splits off first), and other tokenizer files, are encoded by the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

#: Letters and numbers (general categories L and N) below U+0100, as regex classes.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Fixed value: white space below U+0100 by the Unicode property, which leaves out \x1c-\x1f.
SPACES = "\\t-\\r \x85\xa0"
#: Fixed value: the split pattern of the word-end tokenizer's file.
WORD_END_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Distinct pre-tokens in a generation of a worker's cache; it keeps the newest generation and the one before.
CACHE_WORDS = 350_000


class _Words(dict):
    """Pre-tokens with their ids as bytes; one that is missing comes from the generation before or the library."""

    def __init__(self, encode: Callable[[str], bytes], before: dict[str, bytes]):
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        found = self.before.get(word)
        self[word] = found = self.encode(word) if found is None else found
        return found


class Encoder:
    """encode(text) gives the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lower, self.split = self._split(spec)
        contents = {form for t in spec.get("added_tokens") or [] for form in (t["content"], t["content"].lower())}
        self.added = re.compile("|".join(map(re.escape, sorted(contents)))) if contents else None
        self.cache = _Words(self._library, {})

    @staticmethod
    def _split(spec: dict) -> tuple[bool, re.Pattern | None]:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if spec.get("post_processor") and spec["post_processor"].get("type") != "ByteLevel":
            return False, None
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return False, re.compile(
                rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
            )
        parts = pre.get("pretokenizers") or [{}]
        kinds = [n.get("type") for n in (norm or {}).get("normalizers", [])]
        if kinds == ["NFC", "Replace", "Lowercase"] and parts[0].get("pattern") == {"Regex": WORD_END_SPLIT} and parts[0].get("invert"):
            return True, re.compile(rf"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
        return False, None

    def _library(self, text: str) -> bytes:
        ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        if self.split is None or not (text.isascii() or max(text) < "Ā"):
            return self._library(text)
        small = text.lower() if self.lower else text
        if self.added and (self.added.search(text) or (self.lower and self.added.search(small))):
            return self._library(text)
        if len(self.cache) > CACHE_WORDS:
            self.cache = _Words(self._library, dict(self.cache))
        return b"".join(map(self.cache.__getitem__, self.split.findall(small)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(path)


def tokenizer_path(name: str) -> str:
    """Where the host has the public tokenizer file of that name."""
    import public_tokenizers

    return public_tokenizers.path(name)
