"""Reading vector columns: whole vectors, and Arrow lists as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, vector, label) of rows whose vector has components, none of
    them null, NaN or infinite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    whole = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & whole)


def integer_matrix(column: pa.Array, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of lists of one length, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(len(column), -1) * scale).astype(np.int64)
