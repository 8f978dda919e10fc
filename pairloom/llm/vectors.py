"""Vector columns shared by operators 4 and 10."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Whether a vector has components, all of them finite, and not all zero."""
    wrong = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~wrong & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column in double precision, short ones filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(sizes) * width and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bounded_sample(rows: DataFrame, id_col: str, columns: list[str], n: int) -> list:
    """At most n rows, those with the smallest hash of the id: alike on every run."""
    order = F.xxhash64(F.col(id_col))
    return rows.select(*columns, order.alias("_order"), id_col).orderBy("_order", id_col).limit(n).drop("_order").collect()
