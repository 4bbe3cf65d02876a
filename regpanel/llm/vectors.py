"""Vectors as integers, shared by the operators that need exact sums over a table of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_vectors(vectors: DataFrame, vector: str, factor: int, limit: int, *keep: Column) -> tuple[DataFrame, int]:
    """``keep`` and ``x`` (array of long, ``floor(factor * component)``) of the vectors that take part, and their width.

    A vector that is null, empty or holds a null, a non-finite component or one whose integer is not within
    ``limit`` takes no part, nor one of another width than most (the larger of equals).
    """
    rows = vectors.select(*keep, F.col(vector).cast("array<double>").alias("_v"))
    fits = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * factor < limit))
    rows = rows.where(F.col("_v").isNotNull() & (F.size("_v") > 0) & fits)
    width = rows.groupBy(F.size("_v").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("w")).first()
    rows = rows.where(F.size("_v") == (width["w"] if width else -1))
    return rows.select(*rows.columns[:-1], F.transform("_v", lambda c: F.floor(c * factor)).alias("x")), width["w"] if width else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of one width as a matrix, one row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
