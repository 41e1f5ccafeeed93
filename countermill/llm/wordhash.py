"""Word hashes of whole text columns with numpy, for use inside Arrow tasks.

Texts are taken in slices of about ``SLICE_BYTES`` at document borders, so memory follows
the longest document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

#: Words end at ASCII white space.
BY_SPACE = np.zeros(256, dtype=bool)
BY_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words are ASCII letters and digits and everything beyond ASCII.
BY_PUNCTUATION = np.zeros(256, dtype=bool)
BY_PUNCTUATION[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        for at, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all 64 bits (finaliser of a public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of some consecutive rows; row i has words ``first[i]:first[i + 1]``."""

    row: int
    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return at - at[0], raw


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE_BYTES``, one row at least."""
    begin, rows = 0, len(offsets) - 1
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, begin + 1), rows)
        yield begin, end
        begin = end


def words(column: pa.Array, separators: np.ndarray = BY_SPACE) -> Iterator[Words]:
    """Words of all rows, with A-Z lower-cased, slice by slice."""
    offsets, raw = text_buffers(column)
    for begin, end in slices(offsets):
        at = offsets[begin : end + 1] - offsets[begin]
        data = _LOWER[raw[offsets[begin] : offsets[end]]]
        inside = ~separators[data]
        border = np.zeros(len(data) + 1, dtype=bool)
        border[at] = True
        opens, closes = inside.copy(), inside.copy()
        if len(data):
            opens[1:] &= ~inside[:-1] | border[1:-1]
            closes[:-1] &= ~inside[1:] | border[1:-1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        up, down = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        yield Words(begin, hashes, np.searchsorted(starts, at), starts, ends, data)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows of one array of word hashes; fewer words than n
    make one window of the whole sequence, none make none."""
    if len(hashes) == 0:
        return hashes
    size = min(n, len(hashes))
    count = len(hashes) - size + 1
    out = np.full(count, np.uint64(size), dtype=np.uint64)
    for i in range(size):
        out += hashes[i : i + count] * _STEP[i]
    return mix(out)


def ngram_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct window hashes) of every row."""
    for part in words(column):
        for i in range(len(part.first) - 1):
            found = ngrams(part.hashes[part.first[i] : part.first[i + 1]], n)
            found.sort()
            if len(found) > 1:
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
            yield part.row + i, found
