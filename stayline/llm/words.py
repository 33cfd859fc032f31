"""Texts of an Arrow batch as flat byte arrays, and hashes of their words.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. All functions work on whole batches in numpy, so no
Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=U64)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_VALUES = _BYTE_VALUES[_LOWER]
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least ``n`` of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        table = np.full(max(n, 1 << 20), base, dtype=U64)
        table[0] = 1
        have = np.cumprod(table, dtype=U64)
        if len(have) <= 1 << 23:
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind, size = (np.int64, 8) if wide else (np.int32, 4)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind, len(column) + 1, column.offset * size).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(
    data: np.ndarray, offs: np.ndarray, size: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, text after the last, bytes, offsets), about ``size`` bytes each; a text stays whole."""
    at, n = 0, len(offs) - 1
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + size, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in ``data``, and the n + 1 word offsets of the texts."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    space = SPACE[data]
    first = ~space
    last = first.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    full = offs[1:] > offs[:-1]
    heads, tails = offs[:-1][full], offs[1:][full] - 1
    first[heads] = ~space[heads]
    last[tails] = ~space[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A 64-bit hash for each word; ``lower`` reads A-Z as a-z."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    values = (_LOWER_VALUES if lower else _BYTE_VALUES)[data]
    values *= _power_table(_BASE, len(data))[: len(data)]
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(values, out=total[1:])
    h = total[ends]
    h -= total[starts]
    h *= _power_table(_INVERSE, len(data))[starts]
    return mix(h + (ends - starts).astype(U64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes: entry i is of words i to i + k - 1."""
    if len(h) < k:
        return np.zeros(0, U64)
    n = len(h) - k + 1
    out = np.zeros(n, U64)
    for i in range(k):
        out = (out + h[i : i + n]) * U64(0x9FB21C651E98DF25)
        out ^= out >> U64(29)
    return mix(out)
