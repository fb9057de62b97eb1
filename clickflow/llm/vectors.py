"""What the two vector operators share: which vectors take part, and vectors of an Arrow batch as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null or empty, no null or non-finite component, not zero."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & good & F.exists(v, lambda x: x != 0), F.lit(False))


def dimension(vectors: DataFrame, vector: str) -> int:
    """The most frequent length of usable vectors (the smallest of them at a tie); 0 without any. Vectors of another length take no part."""
    row = vectors.where(usable(vector)).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return int(row["d"]) if row else 0


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """[rows, dim] in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def lists(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel()))
