"""Vector columns: usable rows, and numpy matrices from Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` (long), ``v`` (array<double>) of the rows whose vector is not null and holds
    finite entries only; other columns are not read."""
    v = F.col(f"`{vector}`").cast("array<double>")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & whole)


def dimension(vectors: DataFrame) -> int:
    """Entries of the longest vector, 0 without any; shorter ones count as padded with zeros."""
    return vectors.agg(F.max(F.size("v"))).first()[0] or 0


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """The lists as rows of a float matrix with ``d`` columns, short ones padded with zeros."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == n * d:
        return flat.reshape(n, d)  # no list is longer than d
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((n, d))
    out[np.arange(d) < sizes[:, None]] = flat
    return out


def lists(rows: np.ndarray) -> pa.Array:
    """A float matrix as an Arrow column of lists."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * np.int32(d), pa.array(np.ascontiguousarray(rows).ravel()))
