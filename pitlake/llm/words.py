"""Words of documents as arrays of 64-bit hashes, in the Python workers."""

from __future__ import annotations

import numpy as np
import xxhash

#: fixed values: odd multiplier of the rolling hash, its inverse modulo 2^64, two mixing constants
BASE = 0x9E3779B97F4A7C15
MIX1, MIX2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
#: distinct words remembered at a time
REMEMBERED = 200_000

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class WordHashes(dict):
    """Word -> 64-bit hash; forgets everything when it holds REMEMBERED words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The same hashes, each worked out anew: faster where distinct words are many."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.translate(LOWER) if lower else raw).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of all runs of ``width`` word hashes, modulo 2^64: the sum of
    word times BASE^place over a run, by differences of running sums."""

    def __init__(self, width: int, base: int = BASE):
        self.width, self.base = width, base | 1
        self._powers(1024)

    def _powers(self, n: int) -> None:
        inverse = pow(self.base, -1, 1 << 64)
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, self.base, np.uint64)], dtype=np.uint64)
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)], dtype=np.uint64)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        n = len(h) - self.width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        if len(self.up) < len(h):
            self._powers(2 * len(h))
        total = np.cumsum(np.r_[np.uint64(0), h * self.up[:len(h)]], dtype=np.uint64)
        return mixed((total[self.width:] - total[:n]) * self.down[:n])
