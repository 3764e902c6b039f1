"""64-bit hashes of many byte spans at once."""

from __future__ import annotations

import numpy as np

_BYTE_MIX = np.random.default_rng(13).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 … base^n, modulo 2^64."""
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class SpanHasher:
    """Polynomial hashes from prefix sums. Keeps its tables of powers."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def hashes(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash for the bytes `starts` … `ends` - 1 of each span."""
        if len(codes) >= len(self.up):
            self.up, self.down = powers(_BASE, 2 * len(codes)), powers(_BASE_INVERSE, 2 * len(codes))
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_MIX.take(codes, mode="clip") * self.up[: len(codes)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.down[starts]
        found ^= found >> np.uint64(31)
        return found * _STEP
