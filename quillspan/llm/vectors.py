"""Embeddings as packed vectors, and the cells in which queries meet candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(embedding: Column) -> Column:
    """True for vectors that aren't null and hold neither null nor non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return embedding.isNotNull() & ~F.coalesce(F.exists(embedding, bad), F.lit(True))


def valid(embeddings: DataFrame, zero: bool) -> DataFrame:
    """vec_id and v, an array of doubles, of the rows that take part. zero: vectors of zeros, and empty ones, do too."""
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & finite(F.col("v")))
    return rows if zero else rows.where(F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """A list column as a matrix of doubles; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, width))
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False).astype(float)[offsets[0] : offsets[-1]]
    width = max(width, int(lengths.max()))
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat
    return out


def widened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with the columns of the wider one."""
    w = max(a.shape[1], b.shape[1])
    pad = lambda m: np.pad(m, ((0, 0), (0, w - m.shape[1])))
    return pad(a), pad(b)
