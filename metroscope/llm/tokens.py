"""Token ids by the ``tokenizers`` library, word by word through a bounded cache.

Both public vocabularies split a text at white space before any merge, so the ids of a text are the
ids of its words in order. Each task encodes a word when it first meets it; texts with white space
other than single spaces and line ends inside lines, or with the spelling of a special token, take
the library's path over longer pieces or the whole text.
"""

from __future__ import annotations

import re
import unicodedata
from array import array

import numpy as np

_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_PIECES = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: White space in Python, not in the library.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
CACHED_WORDS = 1_000_000


def vocabulary(name: str) -> str:
    """The file of a public vocabulary; any path of a file of the same kind serves as well."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


class _Words(dict):
    """Ids of words; a word that is not there is learned."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        return self.learn(word)


class Encoder:
    """``ids(text)`` as little-endian unsigned 32-bit bytes, equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.lower = '"Lowercase"' in str(self.library.normalizer) or "Lowercase" in repr(self.library.normalizer)
        self.letters = _byte_letters()
        self.merged = self.library.model.tokenize
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.first: dict[str, bytes] = _Words(lambda word: self._learn(word, self.first, ""))
        self.rest: dict[str, bytes] = self.first if self.lower else {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text and any(s in text for s in self.specials):
            return self.whole(text)
        if len(self.first) + len(self.rest) > CACHED_WORDS:
            self.first.clear()
            self.rest.clear()
        if self.lower and not any(c in text for c in _SEPARATORS):
            # White space only separates here, so words need no lines.
            return b"".join(map(self.first.__getitem__, text.split()))
        out: list[bytes] = []
        for k, line in enumerate(text.split("\n")):
            words = line.split()
            if not words or " ".join(words) != line:
                return self.odd(text)
            if k and not self.lower:
                out.append(self.first.get("\n") or self._learn("\n", self.first, ""))
            out.append(self.first.get(words[0]) or self._learn(words[0], self.first, ""))
            found = list(map(self.rest.get, words[1:]))
            if None in found:
                lead = "" if self.lower else " "
                found = [f or self.rest.get(w) or self._learn(w, self.rest, lead) for f, w in zip(found, words[1:])]
            out += found
        return b"".join(out)

    def odd(self, text: str) -> bytes:
        """Texts with other white space."""
        if self.lower:
            return self.whole(text)
        out = []
        for piece in _PIECES.findall(text):
            cache, lead, word = (self.rest, " ", piece[1:]) if piece[0] == " " and len(piece) > 1 and piece[1] not in " \t\n" else (self.first, "", piece)
            out.append(cache.get(word) or self._learn(word, cache, lead))
        return b"".join(out)

    def _learn(self, word: str, cache: dict[str, bytes], lead: str) -> bytes:
        # One full stop or comma after a letter or digit is a part of its own.
        if len(word) > 1 and word[-1] in ",." and (word[-2].isalpha() or word[-2] in "0123456789"):
            found = (cache.get(word[:-1]) or self._learn(word[:-1], cache, lead)) + (self.first.get(word[-1]) or self._learn(word[-1], self.first, ""))
        else:
            found = self._one(word, lead)
        cache[word] = found
        return found

    def _one(self, word: str, lead: str) -> bytes:
        if word.isascii() and word.isalpha():
            # Each letter is its own spelling.
            if self.lower and not word.islower() and (word := word.lower()) in self.first:
                return self.first[word]
            return array("I", [t.id for t in self.merged(self.letters[0x20] + word if lead else word)]).tobytes()
        plain = word.isalpha() and (word.isascii() or unicodedata.is_normalized("NFC", word))
        if self.lower:
            # A capital sigma's small form depends on its place in Python, not in the library.
            plain = plain and "Σ" not in word and word.lower().isalpha()
            if plain and (word := word.lower()) in self.first:
                return self.first[word]
        if plain:
            # Letters only: one part for the merges, spelled byte by byte.
            spelled = (lead + word).encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.merged(spelled)]).tobytes()
        return self.whole(lead + word)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
