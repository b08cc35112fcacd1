"""Integer vectors from embedding columns, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def kept_vectors(rows: DataFrame, scale: int, limit: int, id_col: str, vector_col: str, label_col: str, label: Column | None = None) -> DataFrame:
    """(id long, label, v array<int>) of the rows whose vector is neither null nor
    holds a null or non-finite component: each component x as floor(scale * x),
    values beyond ``limit`` in size as ``limit``."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-float(limit)), F.least(F.lit(float(limit)), x.cast("double") * scale))).cast("int"))
    return rows.where(vector.isNotNull() & finite).select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) if label is None else label).alias("label"), whole.alias("v"))


def width_of(vectors: DataFrame) -> int:
    """Components of the longest vector."""
    return vectors.agg(F.max(F.size("v"))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row of ``width`` integers for each vector; shorter ones end in zeros."""
    offsets = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat[offsets[0] : offsets[-1]]
    return out
