"""64-bit hashes of the words of many texts at once, with numpy.

A byte gets a fixed random 64-bit value and a word the sum of its bytes' values
times powers of an odd number, modulo 2**64.  One cumulative sum over a buffer
gives every word's sum; a word's own power is divided out again.
"""

from __future__ import annotations

import numpy as np

#: Bytes that one call may hash: the tables of powers have this many entries.
MOST_BYTES = 1 << 21

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _POWERS:
        for base in (_BASE, _INVERSE):
            steps = np.full(MOST_BYTES + 1, np.uint64(base & (1 << 64) - 1))
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a fixed public finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of buffer[start:end]; the buffer holds at most MOST_BYTES bytes."""
    power, inverse = _powers()
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTES[buffer] * power[: len(buffer)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def long_span(raw: bytes) -> np.uint64:
    """The hash of one word of any length, by parts."""
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(raw))
