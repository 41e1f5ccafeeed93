"""CRC-32 of words of a text, and of joined byte strings from the checksums of their parts, for whole arrays."""

from __future__ import annotations

import zlib

import numpy as np

POLYNOMIAL = 0xEDB88320
#: Bytes by which a checksum is moved with one table read; longer moves are made in steps.
STEP = 64
#: Words of up to so many bytes are read together, byte by byte; longer ones each at once.
SHORT = 32
_ENDS = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


TABLE = _byte_table()


def _moves() -> np.ndarray:
    """[n, k, b], flat: byte k of a checksum with value b, moved by n zero bytes."""
    now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    moves = [now]
    for _ in range(STEP):
        now = TABLE[now & 255] ^ (now >> 8)
        moves.append(now)
    return np.stack(moves).ravel()


MOVES = _moves()


def moved(crc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Checksums after ``count`` more zero bytes each, without the marks at both ends."""
    crc, left = crc.astype(np.uint32), count.astype(np.int64)
    while True:
        now = np.minimum(left, STEP)
        at = now * 1024
        crc = (
            MOVES.take(at + (crc & 255))
            ^ MOVES.take(at + ((crc >> 8) & 255) + 256)
            ^ MOVES.take(at + ((crc >> 16) & 255) + 512)
            ^ MOVES.take(at + (crc >> 24) + 768)
        )
        left = left - now
        if not left.any():
            return crc


def joined(first: np.ndarray, second: np.ndarray, second_bytes: np.ndarray) -> np.ndarray:
    """Checksums of first + second, given those of both and the bytes of the second."""
    return moved(first, second_bytes) ^ second.astype(np.uint32)


def followed(crc: np.ndarray, byte: int) -> np.ndarray:
    """Checksums with one more byte behind each."""
    now = crc ^ _ENDS
    return TABLE.take((now ^ np.uint32(byte)) & 255) ^ (now >> 8) ^ _ENDS


def checksums(data: bytes, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of the words of ``data`` that begin at ``starts``."""
    raw = np.frombuffer(data, np.uint8)
    size = np.minimum(length, SHORT + 1).astype(np.uint8)
    order = np.argsort(size, kind="stable")[::-1]
    at = starts[order]
    longer = len(size) - np.cumsum(np.bincount(size, minlength=SHORT + 2))
    now = np.full(len(size), _ENDS)
    for k in range(SHORT):
        n = longer[k]
        if not n:
            break
        part = now[:n]
        now[:n] = TABLE.take(part.astype(np.uint8) ^ raw[at[:n] + k]) ^ (part >> 8)
    found = np.empty(len(size), np.uint32)
    found[order] = now ^ _ENDS
    for i in order[: longer[SHORT]]:
        found[i] = zlib.crc32(data[starts[i] : starts[i] + length[i]])
    return found
