"""Polynomial hashes of many byte ranges at once, modulo 2**64."""

from __future__ import annotations

import numpy as np

_TABLE = np.random.default_rng(20240607).integers(1, 2**63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    known = _powers.get(which)
    if known is None or len(known[0]) < size:
        size = max(size, 1 << 20)
        out = []
        for base in (_BASE[which], pow(_BASE[which], -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        known = _powers[which] = (out[0], out[1])
    return known


def mixed(h: np.ndarray) -> np.ndarray:
    """``h`` with all bits depending on all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Ranges:
    """Hashes of ranges of ``data``; ``which`` picks one of two independent functions."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        powers, self.inverse = _power(which, len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[which][data] * powers[: len(data)], out=self.prefix[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.inverse[start])
