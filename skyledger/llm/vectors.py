"""Vectors of a table as numpy blocks, and which of them can be compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector that is not null or empty and holds no null, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """A list column whose lists all have ``dims`` numbers as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two below their largest component: no digit changes, and squares stay in range.

    No row may be zero. Without this the norm of a row of 1e-200 would be 0, and that of 1e200 infinite.
    """
    return rows / np.exp2(np.floor(np.log2(np.abs(rows).max(1, keepdims=True))))
