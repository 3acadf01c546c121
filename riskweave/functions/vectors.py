"""Vector similarity over float arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity inside the JVM; 0.0 when a vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def _stack(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in s])


@F.pandas_udf(T.DoubleType())
def cosine_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    """Cosine similarity of two vector columns, one Arrow batch at a time."""
    if len(a) == 0:
        return pd.Series([], dtype="float64")
    left, right = _stack(a), _stack(b)
    norms = np.linalg.norm(left, axis=1) * np.linalg.norm(right, axis=1)
    dots = np.einsum("ij,ij->i", left, right)
    return pd.Series(np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0))
