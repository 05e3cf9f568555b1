"""Word hashes of many texts at once."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(6_172_023)
_OF_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        out = out * _STEP + hashes[k : k + len(out)]
    return mix(out)


class Words:
    """Words (runs of other than ASCII white space) of some texts, A-Z lowered.

    ``hash``, ``start`` and ``end`` (byte places in the joined texts) are by word;
    the words of text i are ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, texts: list[bytes]) -> None:
        flat = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.cumsum(size + 1) - size - 1
        upper = (flat >= 65) & (flat <= 90)
        self.bytes = flat + (upper * np.uint8(32))
        blank = (flat == 32) | ((flat >= 9) & (flat <= 13))
        edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1))
        self.start, self.end = edge[0::2], edge[1::2]
        # Sum of byte values times powers of an odd base; the power of the start is
        # divided out by multiplying with the missing power up to a common one.
        # Of the arrays with eight bytes for each byte of text, two at a time are kept.
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.take(_OF_BYTE, self.bytes, out=sums[1:], mode="clip")
        sums[1:] *= _powers(_BASE, len(flat))
        np.cumsum(sums, out=sums)
        raw = sums[self.end] - sums[self.start]
        del sums
        raw *= _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), len(flat))[self.start]
        self.hash = mix(raw + (self.end - self.start).astype(np.uint64))
        self.first = np.append(np.searchsorted(self.start, self.begin), len(self.start))

    def runs(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on (across texts, too)."""
        return runs_of(self.hash, n)

    def shingles(self, n: int) -> list[np.ndarray]:
        """Sorted distinct hashes of each text's shingles of ``n`` words.

        A text with fewer words has one, all of its words; one without has none.
        """
        runs, out = self.runs(n), []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            if b - a >= n:
                out.append(np.unique(runs[a : b - n + 1]))
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for k in range(a, b):
                    whole = mix(whole * _STEP + self.hash[k : k + 1])
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
        return out
