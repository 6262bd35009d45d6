"""Vectors of a table as arrays, and which of them can be compared by angle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """True for vectors that are not null or empty, hold no null or non-finite component and are not zero."""
    big = F.lit(float("inf"))
    wrong = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == big))
    return F.coalesce(F.col(column).isNotNull() & ~wrong & F.exists(column, lambda x: x != 0), F.lit(False))


def cast_vectors(df: DataFrame, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """(vec_id, vector, others) with doubles; float components keep their exact value."""
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), *others)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def by_length(column: pa.Array):
    """(rows, matrix) for every vector length in the column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, matrix(column.take(pa.array(rows)))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that their largest component is between a half and one and no square is lost; angles stay as they are."""
    _, exponent = np.frexp(np.abs(x).max(1, keepdims=True, initial=0.0))
    return np.ldexp(x, -exponent)


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))
