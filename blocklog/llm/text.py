"""Words, hashes and the hold-out rule shared by the text operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _ASCII_UPPER, _ASCII_UPPER.lower())


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space (0x09-0x0D and 0x20), as UTF-8."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """`words` with A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def held_out(doc_id, parts: int, rest: int) -> bool:
    """Whether crc32 of the id, written as text, leaves `rest` modulo `parts`; a null id is written as empty."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts == rest


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id, written as text, modulo `parts`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(parts))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose outputs look random (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse; kept for the next call."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, _INVERSE)):
            table = np.full(max(n, 1 << 16), base, np.uint64)
            table[0] = 1
            _POWERS[k] = np.cumprod(table)
    return _POWERS[0][:n], _POWERS[1][:n]


class Rolling:
    """Hashes of any stretch of a sequence of numbers from one cumulative sum, modulo 2**64.

    `of(start, end)` takes arrays; equal stretches have equal hashes wherever they stand.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self._powers, down = _powers(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * down[:n], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._powers[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class HashedWords:
    """Words (see `words`) of some texts in a row: 64-bit hashes, line in the text, and where each text's begin."""

    first: int  # number of the first text
    bounds: np.ndarray  # of words, one more than texts
    hashes: np.ndarray
    lines: np.ndarray


def hashed_words(texts: list[str | None], *, lower: bool = False, chunk: int = 1 << 20) -> Iterator[HashedWords]:
    """All words of the texts, in chunks of about `chunk` bytes; a longer text is handled alone."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        if k > at and size + len(text or "") > chunk:
            yield _hash_chunk(texts[at:k], at, lower)
            at, size = k, 0
        size += len(text or "")
    if texts:
        yield _hash_chunk(texts[at:], at, lower)


def _hash_chunk(texts: list[str | None], first: int, lower: bool) -> HashedWords:
    data = [(t or "").encode() for t in texts]
    joined = b"\n".join(data)
    symbols = np.frombuffer(joined.lower() if lower else joined, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[symbols], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([0] + [len(d) + 1 for d in data])
    bounds = np.searchsorted(starts, begins)
    line = np.searchsorted(np.flatnonzero(symbols == 10), starts) if len(starts) else starts
    text_lines = np.cumsum([0] + [d.count(b"\n") + 1 for d in data])[:-1]
    return HashedWords(first, bounds, Rolling(symbols).of(starts, ends), line - np.repeat(text_lines, np.diff(bounds)))
