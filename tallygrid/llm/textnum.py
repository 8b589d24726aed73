"""Byte texts as numpy arrays: words, hashes of spans."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    return out


class SpanHasher:
    """64-bit hashes of any spans of a byte array; equal spans have equal hashes wherever they stand."""

    def __init__(self) -> None:
        self.up = self.down = powers(1, 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            n = 2 * len(data)
            self.up, self.down = powers(_BASE, n), powers(_INVERSE, n)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self.up[: len(data)], out=sums[1:])
        inner = (sums[ends] - sums[starts]) * self.down[np.minimum(starts, len(self.down) - 1)]
        return mixed(inner + (ends - starts).astype(np.uint64))


def keep_memory() -> None:
    """Has the C library keep up to 62 MB of freed memory for the next arrays, as it does from when a block of 31 MB was freed.

    Otherwise each step of some MB gives its memory back and faults it in anew, which takes longer than its sums.
    """
    np.empty(31 << 20, dtype=np.uint8)  # never touched, so it takes no memory


def raw(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def lowered(data: bytes) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[np.frombuffer(data, dtype=np.uint8)]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without ASCII white space."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)
