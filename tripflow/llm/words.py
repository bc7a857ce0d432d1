"""Words and their hashes inside a task: plain text in, numpy arrays out.

A word is a run of bytes other than space and \\x09-\\x0D, which is what `bytes.split()` cuts.
Words become 64-bit hashes and windows of words become polynomial hashes of those, so that a
batch of documents is worked on as a few long arrays.
"""

from __future__ import annotations

import numpy as np
import xxhash

U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def encode(text: str | None) -> bytes:
    """The bytes of a text; null is the empty text."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


class _Numbers(dict):
    """Words to numbers in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def number_words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word numbers of all texts in a row, words per text, and the words by number."""
    numbers = _Numbers()
    parts, sizes = [], np.empty(len(texts), np.int64)
    for at, text in enumerate(texts):
        words = (text.lower() if lower else text).split()
        sizes[at] = len(words)
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return ids, sizes, list(numbers)


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place, the input is given up)."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values ^= values >> U64(shift)
        values *= U64(factor)
    values ^= values >> U64(33)
    return values


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each position on; one value less per further word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    out = hashes[:n].copy()
    for step in range(1, size):
        out *= U64(_MULTIPLIER)
        out += hashes[step:step + n]
    return mix(out)


class Prefix:
    """Hashes of word ranges in constant time per range."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        powers = np.full(n, _MULTIPLIER, U64)
        powers[0] = 1
        self.sums = np.zeros(n, U64)
        np.cumsum(hashes * np.cumprod(powers)[:-1], out=self.sums[1:])
        inverse = np.full(n, _INVERSE, U64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)

    def ranges(self, starts: np.ndarray, size: int) -> np.ndarray:
        return mix((self.sums[starts + size] - self.sums[starts]) * self.inverse[starts])


def starts_of(sizes: np.ndarray) -> np.ndarray:
    """First position of each text, and the end."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def whole_windows(sizes: np.ndarray, size: int) -> np.ndarray:
    """For each position: does a window from here on end inside its text?"""
    ends = np.repeat(starts_of(sizes)[1:], sizes)
    return np.arange(len(ends)) + size <= ends
