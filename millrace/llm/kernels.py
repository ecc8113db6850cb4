"""Vectorised text kernels shared by the operators of this subpackage.

All of them work on a slice of texts at a time: the texts are joined into one
code point array and everything else is NumPy over that array. Slices are
bounded by characters, so a worker's memory does not depend on the batch.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Characters per slice: about 100 bytes of working memory each.
SLICE_CHARS = 1_000_000

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C15 | 1
SKIP = np.uint32(0xFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection with good avalanche."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``limit`` characters (or one longer text)."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        n = len(t) + 1
        if chars and chars + n > limit:
            yield start, i
            start, chars = i, 0
        chars += n
    if start < len(texts):
        yield start, len(texts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@lru_cache(maxsize=1)
def alnum_table() -> np.ndarray:
    """True for letters and digits, by code point."""
    table = np.zeros(sys.maxunicode + 1, dtype=bool)
    top = 0x33480  # nothing is assigned between here and the tags
    table[:top] = [chr(c).isalnum() for c in range(top)]
    return table


@lru_cache(maxsize=1)
def fold_table() -> tuple[np.ndarray, dict[int, list[int]]]:
    """The skip-and-fold table of outward form.

    Entry ``SKIP`` for white space and punctuation (class P), else the folded
    code point. Code points that fold to several (such as sharp s) carry the
    first one here and all of them in the dictionary.
    """
    table = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    several: dict[int, list[int]] = {}
    top = 0x33480
    for c in range(top):
        ch = chr(c)
        if ch.isspace() or unicodedata.category(ch)[0] == "P":
            table[c] = SKIP
            continue
        folded = ch.casefold()
        if folded != ch:
            table[c] = ord(folded[0])
            if len(folded) > 1:
                several[c] = [ord(x) for x in folded]
    return table, several


class WordSlice:
    """Words of a slice of texts.

    A word is a longest run of letters or digits after lower-casing. ``hash``
    has one 64-bit value per word, ``first[i]:first[i + 1]`` are the words of
    text ``i``; ``start`` and ``end`` are places in ``lowered``, whose code points
    are ``codes``.
    """

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.lowered = "\0".join([t.replace("\0", " ") for t in texts]).lower()
        codes = code_points(self.lowered)
        self.codes = codes
        inside = alnum_table()[codes]
        flags = np.zeros(len(codes) + 2, dtype=np.int8)
        flags[1:-1] = inside
        edges = np.flatnonzero(np.diff(flags))
        self.start, self.end = edges[::2], edges[1::2]
        size = self.end - self.start
        self.hash = _segments(codes[inside], size)
        breaks = np.flatnonzero(codes == 0)
        self.first = np.concatenate([[0], np.searchsorted(self.start, breaks), [len(self.start)]]).astype(np.int64)
        if self.n == 0:
            self.first = np.zeros(1, dtype=np.int64)

    def rows(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(self.n), np.diff(self.first))

    def word(self, i: int) -> str:
        return self.lowered[self.start[i] : self.end[i]]


_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of the polynomial base modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS)), _BASE, dtype=np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


def _segments(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Polynomial hash of consecutive segments of ``codes``."""
    if not len(size):
        return np.zeros(0, dtype=np.uint64)
    first = np.cumsum(size) - size
    place = np.arange(len(codes)) - np.repeat(first, size)
    terms = mix(codes.astype(np.uint64) + _GOLD) * powers(int(size.max()) + 1)[place]
    return mix(np.add.reduceat(terms, first) + size.astype(np.uint64))


def shingles(words: WordSlice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and the text of each."""
    have = np.maximum(np.diff(words.first) - (n - 1), 0)
    if not have.sum():
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(words.n), have)
    at = np.repeat(words.first[:-1], have) + (np.arange(len(row)) - np.repeat(np.cumsum(have) - have, have))
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        value = mix(value * _U(3) + words.hash[at + k])
    return value, row


def sequence_hash(words: WordSlice, seed: int) -> np.ndarray:
    """One order-sensitive hash per text over its words."""
    count = np.diff(words.first)
    out = np.full(words.n, mix(np.array([seed], dtype=np.uint64))[0], dtype=np.uint64)
    some = count > 0
    if some.any():
        place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], count)
        terms = mix(words.hash + _U(seed)) * powers(int(count.max()) + 1)[place]
        out[some] = mix(np.add.reduceat(terms, words.first[:-1][some]) + count[some].astype(np.uint64))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's LongType."""
    return x.view(np.int64)
