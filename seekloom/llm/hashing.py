"""64-bit hashes of words and of byte ranges, computed for many texts at once with numpy.

A range's hash is the sum of random byte values times powers of an odd radix modulo 2**64,
taken from one running sum over all texts, so the cost per byte does not depend on the
number of words. All values are the same on every machine and in every run.
"""

from __future__ import annotations

import zlib

import numpy as np

WHITESPACE = b" \t\n\x0b\x0c\r"
_RADIX = 0x9E6C63D0876A3F35
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range; a bijection."""
    x = values + _GOLDEN
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(WHITESPACE)] = True


#: So many powers are kept at most; a longer buffer's are made for it alone.
KEPT_POWERS = 1 << 22
_kept = (np.empty(0, dtype=np.uint64),) * 2


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the radix and of its inverse, ``size`` or more of each."""
    global _kept
    if size <= len(_kept[0]):
        return _kept
    up, down = np.full(size, _RADIX, dtype=np.uint64), np.full(size, pow(_RADIX, -1, 2**64), dtype=np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    if size <= KEPT_POWERS:
        _kept = up, down
    return up, down


def range_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each range of bytes; equal bytes have equal hashes wherever they stand."""
    size = 1 << max(20, int(len(buffer)).bit_length())
    up, down = _powers(size)
    sums = np.empty(len(buffer) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[buffer] * up[: len(buffer)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the bounds of each text's words.

    Words are maximal runs without ASCII white space, with A-Z lower-cased. Text ``i`` has
    the words ``bounds[i]:bounds[i + 1]``.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    edges = np.flatnonzero(np.diff(_IS_SPACE[joined], prepend=True))
    starts, ends = edges[::2], edges[1::2]
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    text_ends = np.cumsum(lengths + 1)
    bounds = np.concatenate([[0], np.searchsorted(starts, text_ends)]).astype(np.int64)
    return range_hashes(_LOWER[joined], starts, ends), bounds


def fold(value: object) -> int:
    """crc32 of a value as text, unsigned."""
    return zlib.crc32(str(value).encode())
