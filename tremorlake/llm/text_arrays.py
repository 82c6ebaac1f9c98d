"""Words and n-grams of a batch of texts as numpy arrays over one UTF-8 buffer.

Used inside mapInArrow: a string column is a byte buffer with offsets, so words
are found and hashed without making a Python string of any of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Words(NamedTuple):
    """Words (runs of digits, ASCII letters and non-ASCII) in order: hash of the ASCII-lower-cased bytes, place, text."""

    hash: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    doc: np.ndarray


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``limit`` bytes; null counts as empty."""
    column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset:]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, in place on a fresh array."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            grown = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
            grown[0] = 1
            _powers[k] = np.cumprod(grown, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Cuts of a buffer into blocks of about ``limit`` bytes that part no word, so a long text needs no larger arrays."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + limit)
        while end < n and _IS_WORD[data[end]]:  # on to the word's end, or to a text's
            ahead = np.flatnonzero(~_IS_WORD[data[end:end + 4096]])
            border = offsets[np.searchsorted(offsets, end)]
            step = int(ahead[0]) if len(ahead) else min(4096, n - end)
            if border <= end + step:
                end = int(border)
                break
            end += step
        yield at, end
        at = end


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, limit: int = PIECE_BYTES) -> Words:
    parts = []
    for at, end in blocks(data, offsets, limit):
        inner = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end, side="right")] - at
        value, start, stop = _block_words(data[at:end], inner, lower)
        parts.append((value, start + at, stop + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, none)
    value, start, stop = (np.concatenate(x) for x in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]
    return Words(value, start, stop, np.searchsorted(offsets, start, side="right") - 1)


def _block_words(data: np.ndarray, borders: np.ndarray, lower: bool):
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[borders] = True
    is_word = _IS_WORD[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1] | edge[1:n]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | edge[1:n]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _power(n)
    sums = np.cumsum(((_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) * power)
    value = sums[stop - 1]
    inner = start > 0
    value[inner] -= sums[start[inner] - 1]
    value *= inverse[start]
    return mix(value), start, stop


def word_hashes(text: str, lower: bool = True) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words(data, np.array([0, len(data)]), lower).hash


def runs_of(doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Offsets of each document's entries in a sorted document array."""
    return np.searchsorted(doc, np.arange(n_docs + 1))
