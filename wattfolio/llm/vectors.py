"""Vector columns: which rows count, and lists as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector that is not null and holds no null, NaN or infinite component."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)
