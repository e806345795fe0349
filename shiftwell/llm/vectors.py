"""Which vectors take part in a search or a join, and how tasks read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is not NULL, not zero and holds finite numbers only."""
    value = F.col(vector)
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(
        value.isNotNull() & finite & F.exists(value, lambda x: x != 0), F.lit(False)
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows brought to length one; scaled first, so that no square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
