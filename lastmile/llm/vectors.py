"""Vectors of an Arrow batch as numpy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def rows(column: pa.Array) -> list[np.ndarray | None]:
    """Each row as float64, or None if it takes no part: null, empty, all zeros, or with a null
    or non-finite component."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    nulls = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    values[nulls] = np.nan
    present = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(present, np.diff(column.offsets.to_numpy()), 0)
    ends = np.cumsum(lengths)
    out: list[np.ndarray | None] = []
    for end, n in zip(ends, lengths):
        v = values[end - n : end]
        out.append(v if n and np.isfinite(v).all() and v.any() else None)
    return out
