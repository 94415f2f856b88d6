"""Integers packed into bytes, so that arrays travel in one row."""

from __future__ import annotations

import numpy as np


def planes(a: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each integer, byte plane by byte plane (equal bytes lie together and compress)."""
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(raw: list[bytes], width: int) -> np.ndarray:
    out = []
    for b in raw:
        m = np.zeros((len(b) // width, 8), np.uint8)
        m[:, :width] = np.frombuffer(b, np.uint8).reshape(width, -1).T
        out.append(m.view("<u8").ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def cuts(keys: np.ndarray):
    """Bounds of the runs of equal values in a sorted array."""
    if not len(keys):
        return []
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    return zip(at[:-1].tolist(), at[1:].tolist())


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of n for each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(n[order], starts) if len(keys) else n[:0]
