"""Whole groups out of a sorted stream of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Places at which a new run of equal keys begins."""
    n = len(table)
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        c = table.column(k).combine_chunks()
        if n > 1:
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def whole_runs(batches, keys: list[str], rows: int = 20_000):
    """Tables of about ``rows`` rows that hold whole runs of equal keys (non-null, sorted)."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        last = int(starts(table, keys)[-1])
        if last:
            yield table.slice(0, last)
            held = table.slice(last).combine_chunks().to_batches()
        n -= last
    if held:
        yield pa.Table.from_batches(held)
