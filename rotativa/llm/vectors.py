"""Vectors that can be compared by cosine, and their exact copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def comparable(vector: Column) -> Column:
    """Not NULL, every component finite, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe against overflow and underflow of squares."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision."""
    return np.einsum("...d,...d->...", a, b) / (np.linalg.norm(a, axis=-1) * np.linalg.norm(b, axis=-1))


def first_copies(rows: DataFrame, id_: str, vector: str, copies: int) -> DataFrame:
    """One row per distinct vector with its ``copies`` smallest ids, in order.

    The limit is applied in every task before the shuffle, so a vector with very
    many copies brings a few rows of each task.
    """
    of_vector = Window.partitionBy(vector).orderBy(id_)
    return (
        rows.select(id_, vector)
        .distinct()
        .withColumn("_n", F.row_number().over(of_vector))
        .where(F.col("_n") <= copies)
        .groupBy(vector)
        .agg(F.sort_array(F.collect_list(id_)).alias("ids"))
    )
