"""What the operators on embeddings share: which vectors take part, and their bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kept_type(rows: DataFrame, vector: str) -> str:
    """The type that a column of vectors is read as: single precision only where it is given in that."""
    own = rows.schema[vector].dataType
    return "array<float>" if isinstance(own, T.ArrayType) and isinstance(own.elementType, T.FloatType) else "array<double>"


def usable(vector: str) -> Column:
    """True for vectors that are not null, empty or zero and hold neither null nor non-finite components."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~odd & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    """The rows of a column of equally long arrays, in double precision."""
    return np.array([np.asarray(x, dtype=np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def normalised(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, safe for very large and very small components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
