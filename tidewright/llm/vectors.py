"""Arrow columns of vectors as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def usable(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Which vectors are neither null nor empty nor hold null or non-finite components."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros(len(column), dtype=bool)
    if not len(column):
        return out
    offsets = np.asarray(column.offsets)
    values = column.values.cast(pa.float64())
    x = np.where(values.is_valid().to_numpy(zero_copy_only=False), values.fill_null(0).to_numpy(zero_copy_only=False), np.nan)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
    out[:] = (bad[offsets[1:]] == bad[offsets[:-1]]) & (offsets[1:] > offsets[:-1])
    return out & column.is_valid().to_numpy(zero_copy_only=False)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of usable vectors of one length as float64 [rows, length]."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
