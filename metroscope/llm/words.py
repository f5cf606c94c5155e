"""Hashing of words and shingles inside Arrow tasks, vectorised with numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D in the UTF-8 text. A word's hash is
its polynomial modulo 2**64, mixed; a shingle's hash is a mixed linear form of its words' hashes.
Hashes depend on the text only, so every process and every run agrees.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_ODD = np.array([pow(0xD1342543DE82EF95, k, 1 << 64) for k in range(1, 65)], dtype=np.uint64)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_SEGMENT = 1 << 19
_powers = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
NONE = np.zeros(0, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def segments(raw: bytes):
    """Cut between words, so that no table has to be as long as a very long text."""
    at = 0
    while len(raw) - at > _SEGMENT:
        end = at + _SEGMENT
        while end < len(raw) and not _WHITE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:] if at else raw


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """One hash per word, in order; A-Z count as a-z when ``lower``."""
    if not text:
        return NONE
    raw = text.encode("utf-8", "replace")
    found = [_hash_segment(part) for part in segments(raw.lower() if lower else raw)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def _hash_segment(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return NONE
    white = _WHITE[data]
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edges = np.concatenate(([0], edges))
    if not white[-1]:
        edges = np.concatenate((edges, [len(data)]))
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; fewer words count as one run; none give none."""
    if not len(words):
        return NONE
    if len(words) < size:
        return mix(np.array([np.sum(words * _ODD[: len(words)]) + np.uint64(len(words))], dtype=np.uint64))
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * _ODD[k]
    return mix(total)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    return np.unique(shingles(word_hashes(text), size))
