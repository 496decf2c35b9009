"""Joins whose keys may be NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, a NULL being equal to a NULL; the keys appear once, as the left side has them."""
    other = right.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys]
    return left.join(other, on, how).drop(*[f"_j_{k}" for k in keys])
