"""Word hashes and rolling window hashes in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

from patronscope.llm.common import fmix64

#: Odd multipliers of the two window hashes; 3 modulo 4, so that swapped words differ.
FIRST, SECOND = 0x9E3779B97F4A7C17 | 3, 0xC2B2AE3D27D4EB4F | 3
_WRAP = 1 << 64
KEPT_WORDS = 300_000


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``KEPT_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_known = WordHashes()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64, kept for the longest ``n`` so far."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return known[:n]


def window_hashes(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of each ``width`` neighbouring values, modulo 2 ** 64.

    The hash is the sum of ``value * base ** offset``; differences of one running sum give
    all windows, and a power of the inverse of ``base`` makes them free of their position.
    """
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=total[1:])
    inverse = pow(base, -1, _WRAP)
    return (total[width:] - total[:-width]) * powers(inverse, n - width + 1)


_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text that are hashed at once; a piece ends with a word.
PIECE = 1 << 18
#: A second odd base, 3 modulo 4, for the bytes within a word.
BYTES = 0xD6E8FEB86659FD93


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        end = _SPACE.search(text, at + PIECE)
        if end is None:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:]


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and a 64-bit hash of each word, in order; words end at ASCII white space.

    The hash are sums of ``(byte + 1) * base ** offset``, taken from one running sum over the bytes, then
    mixed: no Python object per word.
    """
    found, at = [], 0
    for piece in _pieces(text):
        raw = np.frombuffer(piece, np.uint8)
        space = np.ones(len(raw) + 2, bool)
        space[1:-1] = (raw == 32) | (raw - np.uint8(9) <= 4)
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edges[::2], edges[1::2]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * powers(BYTES, len(raw)), out=total[1:])
        inverse = powers(pow(BYTES, -1, _WRAP), len(raw))
        found.append((starts + at, ends + at, fmix64((total[ends] - total[starts]) * inverse[starts])))
        at += len(piece)
    return found[0] if len(found) == 1 else tuple(np.concatenate(x) for x in zip(*found))


def word_hashes(text: bytes) -> np.ndarray:
    """The hash of each word, in order."""
    return word_places(text)[2]
