"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)),
    )
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(flat), -1)
