"""Vector columns as numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(column: str) -> Column:
    """True for vectors without null or non-finite components; null vectors and null components give false."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(column).isNotNull() & ~bad, F.lit(False))


def doubles(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v array<double>)."""
    return df.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """rows x dim block of a list column whose rows all have dim components."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), dim)


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def unblob(b, dtype, *shape: int) -> np.ndarray:
    a = np.frombuffer(b, dtype=dtype)
    return a.reshape(*shape) if shape else a
