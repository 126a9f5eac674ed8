"""Vectors of array columns as numpy matrices, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_vector(vec: Column) -> Column:
    """Not null, not empty, and no component null, NaN or infinite."""
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.coalesce(bad, F.lit(True))


def matrices(column: pa.Array | pa.ChunkedArray, values: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix in double precision, null as NaN) for the
    vectors of each length, at most about ``values`` components at a time.
    Null and empty vectors are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == d)
        step = max(1, values // d)
        for i in range(0, len(at), step):
            rows = at[i:i + step]
            low, high = int(starts[rows[0]]), int(starts[rows[-1]]) + d
            part = flat.slice(low, high - low).cast(pa.float64()).to_numpy(zero_copy_only=False)
            yield d, rows, part[(starts[rows] - low)[:, None] + np.arange(d)]


def grid(m: np.ndarray, most: int) -> np.ndarray:
    """floor(64 * x) of double components as long; beyond +-``most`` it stays there."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(64.0 * m), -most, most).astype(np.int64)
