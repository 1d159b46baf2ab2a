"""Vectors of whole numbers, for code that runs inside Spark tasks on Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def scaled(column: pa.Array | pa.ChunkedArray, size: int, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``size`` components, none null or non-finite; and floor(scale * x) of those rows' components.

    Components beyond ``limit`` count as that limit, so that products and distances keep inside 64 bits.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    right = np.asarray(pc.fill_null(pc.list_value_length(column), -1)) == size
    values = np.asarray(pc.fill_null(column.values.cast(pa.float64()), np.nan))
    starts = np.asarray(column.offsets)[:-1][right].astype(np.int64)
    held = values[starts[:, None] + np.arange(size)] if len(values) else np.zeros((len(starts), size))
    finite = np.isfinite(held).all(axis=1)
    right[right] = finite
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(scale * held[finite]), -limit, limit)
    return right, whole.astype(np.int64)


def listed(rows: np.ndarray) -> pa.Array:
    """A matrix as an Arrow array of int lists."""
    n, size = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * size, size or 1, dtype=np.int32)[:n + 1]), pa.array(rows.ravel().astype(np.int32)))


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """The reverse of ``listed``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), size).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``: in floating point where that holds every sum."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    for kind, exact in ((np.float32, 1 << 24), (np.float64, 1 << 53)):
        if most < exact:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return a @ b.T
