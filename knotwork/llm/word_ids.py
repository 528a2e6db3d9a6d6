"""Token ids of whole texts from public tokenizer files, with each word looked up in a bounded cache.

The ids are those of the tokenizers library for the whole text. Texts are cut
only where no token can cross: at ASCII white space for tokenizers that drop
white space, before a single space for byte-level ones. A text that holds the
string of a special token goes to the library whole, which gives that token.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from knotwork.llm.common import RELEASES

CACHED_WORDS = 250_000
#: Latin letters that no normalizer changes but for their case, then signs without the apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,./:;<=>?@\[\\\]^_`{|}~-]*)")


def byte_letters(text: str) -> str:
    """A text as byte-level vocabularies write it, one letter for each byte."""
    return text.encode("utf-8", "surrogatepass").decode("latin-1").translate(_letters())


@lru_cache(maxsize=1)
def _letters() -> dict[int, str]:
    """The letter of each byte that occurs in UTF-8, as the library writes characters that hold it."""
    level = ByteLevel(add_prefix_space=False, use_regex=False)
    samples = [*range(0x800), *range(0x800, 0xD000, 0x100), *range(0xE000, 0x110000, 0x1000)]
    return {b: x for c in samples for b, x in zip(chr(c).encode(), level.pre_tokenize_str(chr(c))[0][0])}


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Words(dict):
    """Ids of a word as little-endian unsigned 32-bit numbers, computed at first sight.

    At ``limit`` words the dictionary becomes the former one and an empty one is begun; words
    that are met again come back from there, so frequent ones are never computed twice.
    """

    def __init__(self, path: str, limit: int) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.limit, self.parts, self.former = self.tokenizer.model, limit, {}, {}
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # any case, as some tokenizers look for them after lower-casing; signs that all begin with are sought first
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))), re.IGNORECASE) if added else None
        self.signs = re.match(r"[^\w\s]*", os.path.commonprefix(added))[0]

    def ids(self, text: str) -> bytes:
        """Ids of a whole text."""
        if self.added is not None and self.signs in text and self.added.search(text):
            return self.encode(text)
        return self.plain_ids(text)

    def encode(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def part(self, letters: str) -> bytes:
        """Ids of one pre-token."""
        found = self.parts.get(letters)
        if found is None:
            if len(self.parts) >= self.limit:
                self.parts.clear()
            found = packed([t.id for t in self.model.tokenize(byte_letters(letters))])
            self.parts[letters] = found
        return found

    def __missing__(self, key):
        found = self.former.get(key)
        if found is None:
            found = self.compute(key)
        if len(self) >= self.limit:
            self.former = dict(self)
            self.clear()
        self[key] = found
        return found


class DroppedSpace(_Words):
    """For tokenizers that lower case and drop white space; words are bytes."""

    def compute(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        if plain := _PLAIN.fullmatch(text):
            return self.part(plain[1].lower()) + (self.part(plain[2]) if plain[2] else b"")
        return self.encode(text)

    def plain_ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "surrogatepass").split()))


class LeadingSpace(_Words):
    """For byte-level tokenizers whose words begin with their space; words are what follows a space."""

    _RUN = re.compile(r" \s")
    #: The end of one line and the first word of the next.
    _LINES = re.compile(rf"{_PLAIN.pattern}\n{_PLAIN.pattern}")

    def compute(self, word: str) -> bytes:
        if plain := _PLAIN.fullmatch(word):
            return self.part(" " + plain[1]) + (self.part(plain[2]) if plain[2] else b"")
        if lines := self._LINES.fullmatch(word):
            before, signs, after, more = lines.groups()
            return b"".join(map(self.part, filter(None, (" " + before, signs, "\n", after, more))))
        return self.encode(" " + word)

    def plain_ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self._RUN.search(text):  # runs of white space are tokens of their own
            return self.encode(text)
        first, *rest = text.split(" ")
        return (self.encode(first) if first else b"") + b"".join(map(self.__getitem__, rest))


@lru_cache(maxsize=4)
def word_ids(path: str, kind: type[_Words], limit: int = CACHED_WORDS) -> _Words:
    """The cache of a worker process, kept from task to task."""
    return kind(path, limit)


RELEASES.append(word_ids.cache_clear)
