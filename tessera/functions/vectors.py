"""Vector functions on ARRAY<FLOAT|DOUBLE> columns.

Everything is summed in double (the test embeddings are float32) with
higher-order functions, so the same arithmetic runs in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: str | Column, b: str | Column) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def l2sq(a: str | Column, b: str | Column) -> Column:
    """squared Euclidean distance."""
    return _sum(
        F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double"))
                   * (x.cast("double") - y.cast("double")))
    )


def l2_norm(a: str | Column) -> Column:
    """Euclidean norm."""
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def normalize(a: str | Column) -> Column:
    """Unit vector (a zero vector stays zero). The squared norm is the
    accumulator of one pass; the finish step divides, so the norm is
    computed once per row, not once per element."""
    arr = _c(a)
    return F.aggregate(
        arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda acc: F.transform(arr, lambda x: F.when(acc > 0, x.cast("double") / F.sqrt(acc))
                                .otherwise(F.lit(0.0))))


def cosine_distance(a: str | Column, b: str | Column) -> Column:
    """1 - dot(a/|a|, b/|b|)."""
    return F.lit(1.0) - dot(normalize(a), normalize(b))
