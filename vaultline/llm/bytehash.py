"""Vectorised 64-bit hashes of many pieces of one byte buffer."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Odd multipliers, fixed so that every task names equal bytes alike.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=4)
def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    def row(x: int) -> np.ndarray:
        steps = np.full(count, x, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return row(base), row(pow(base, -1, 1 << 64))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of uint64 values over all bits (one to one)."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * _MIX
    return values ^ (values >> np.uint64(32))


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """Hash of ``data[start:end]`` (uint8) for each pair, by prefix sums of a polynomial over 2^64."""
    size = 1 << max(16, len(data).bit_length())
    power, inverse = _powers(base, size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def windows(data: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of every ``length`` consecutive bytes; ``length`` is a power of two."""
    out, have, power = data.astype(np.uint64) + np.uint64(1), 1, base
    while have < length:
        out = out[:-have] * np.uint64(power) + out[have:]
        have, power = 2 * have, power * power % (1 << 64)
    return mixed(out)
