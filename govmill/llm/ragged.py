"""Ragged numpy arrays of text pieces: pre-tokens, words and 64-bit keys, without a Python object per piece.

A piece is a half-open range of a flat array (code points or bytes). Its key is a polynomial hash modulo 2^64 with an odd
base, taken from one cumulative sum: key = (sum up to the end - sum up to the start) * base^-start. Equal pieces have
equal keys; different pieces share one with probability 2^-64 a pair (10 million different pieces: 3 in a million).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: Code points with the Unicode property White_Space (fixed values of the standard).
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CHUNK = 1 << 20  #: code points or bytes that are worked on at a time; a longer text makes a longer chunk of its own

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _power_store() -> dict[str, np.ndarray]:
    return {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of the base and of its inverse."""
    store = _power_store()
    if not store or len(store["up"]) < n + 1:
        size = max(n + 1, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            store[name] = np.multiply.accumulate(row)
    return store["up"], store["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x632BE59BD9B4E019)
    x ^= x >> np.uint64(32)
    x *= _MIX
    x ^= x >> np.uint64(29)
    x *= _MIX
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mixed(np.arange(256, dtype=np.uint64))


def piece_keys(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit keys of the pieces [start, end) of a flat array of code points or bytes."""
    up, down = powers(len(flat))
    value = _byte_values()[flat] if flat.dtype == np.uint8 else mixed(flat)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(value * up[: len(flat)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start])


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point as the pre-token pattern sees it: letter, number, white space or other."""
    kind = {"L": LETTER, "N": NUMBER}
    kinds = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    kinds[WHITE_SPACE] = SPACE
    return kinds


#: Suffixes that the pattern splits off after an apostrophe (fixed values of the public pattern).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def pretoken_starts(points: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in code points; `fresh` marks the first code point of every text.

    The pattern is that of the public byte-level vocabularies: contractions, then letters, numbers or other signs with
    one blank before them, then white space, of which the last character is left to what follows.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= fresh
    opens = start.copy()
    opens[kind == SPACE] = False
    opens[0] = False
    at = np.flatnonzero(opens & ~fresh)
    at = at[kind[at - 1] == SPACE]
    start[at - 1] = True
    start[at[points[at - 1] == 32]] = False
    quote = np.flatnonzero((points == 39) & start)
    quote = quote[quote + 1 < n]
    for suffix in sorted(CONTRACTIONS, key=len):
        if not len(quote):
            break
        k = len(suffix)
        fits = quote + k < n
        for j, letter in enumerate(suffix, 1):
            where = np.minimum(quote + j, n - 1)
            fits &= (points[where] == ord(letter)) & ~fresh[where]
        hit = quote[fits]
        start[hit + 1] = False
        after = hit + k + 1
        after = after[after < n]
        start[after[kind[after] == LETTER]] = True
        quote = quote[~fits]
    return np.flatnonzero(start)


def gather(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces one after another, and the offsets of each (one more than pieces)."""
    length = end - start
    offset = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offset[1:])
    index = np.arange(offset[-1]) + np.repeat(start - offset[:-1], length)
    return flat[index], offset


def chunks(texts: list[str | None], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` characters in all, at least one text each."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > limit:
            yield first, i
            first, size = i, 0
        size += len(text or "")
    if first < len(texts):
        yield first, len(texts)


def utf8(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of code points, and the byte offset of each code point (one more than code points)."""
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    offset = np.zeros(len(points) + 1, np.int64)
    np.cumsum(width, out=offset[1:])
    return np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8), offset


class Pieces:
    """Pre-tokens of some texts: `key` of each, the text it belongs to, and the bytes of any of them."""

    def __init__(self, texts: list[str]):
        self.points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.concatenate([[0], np.cumsum(length)])
        fresh = np.zeros(len(self.points) + 1, bool)
        fresh[first[:-1][length > 0]] = True
        self.start = pretoken_starts(self.points, fresh[:-1])
        self.end = np.append(self.start[1:], len(self.points)) if len(self.start) else self.start
        self.key = piece_keys(self.points, self.start, self.end)
        #: Pieces of text i are those from bound[i] to bound[i + 1].
        self.bound = np.searchsorted(self.start, first)
        self._bytes: tuple[np.ndarray, np.ndarray] | None = None

    def bytes_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self._bytes is None:
            self._bytes = utf8(self.points)
        flat, offset = self._bytes
        return gather(flat, offset[self.start[which]], offset[self.end[which]])


def text_sums(values: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Sums of values[bound[i]:bound[i + 1]] for every i; 0 for empty ranges."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64))
    np.cumsum(values, out=total[1:])
    return total[bound[1:]] - total[bound[:-1]]


def distinct(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Different keys, the first place of each, and the number of its key for every place."""
    code, words = pd.factorize(keys)
    first = np.empty(len(words), np.int64)
    first[code[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return words.tolist(), first, code


class Memo:
    """Key to value, in two generations of bounded size: what is not asked for any more goes."""

    def __init__(self, limit: int = 100_000):
        self.limit, self.young, self.old = limit, {}, {}

    def find(self, keys: list[int]) -> list:
        out = list(map(self.young.get, keys))
        if self.old:
            for i in [i for i, value in enumerate(out) if value is None]:
                if (value := self.old.get(keys[i])) is not None:
                    out[i] = self.young[keys[i]] = value
        return out

    def keep(self, keys: list[int], values: list) -> None:
        if len(self.young) + len(keys) > self.limit:
            self.old, self.young = self.young, {}
        self.young.update(zip(keys, values, strict=True))
