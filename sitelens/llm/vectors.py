"""What the two vector operators share: usable vectors and exact cosines."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(col: str = "embedding") -> Column:
    """Not NULL, not empty, no NULL or non-finite component, not all zero."""
    x = F.transform(F.col(col), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col(col).isNotNull() & (F.size(col) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def as_doubles(col: str = "embedding") -> Column:
    return F.col(col).cast("array<double>")


def matrix(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so no norm over- or underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the least hash of ``key`` (the same on every run)."""
    return df.orderBy(F.xxhash64(F.lit("sample"), F.col(key)), key).limit(rows)
