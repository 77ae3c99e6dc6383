"""Squash functions and their derivatives (F16-F19, F21), as Columns.

Rules kept on purpose: HLIM is a step function; TANH uses Spark's ``tanh``
(the exp form overflows to NaN for large x); JS ``Math.round`` is
``floor(x + 0.5)`` (differs from Spark ``round`` for negative halves).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def logistic(x, deriv: bool = False) -> Column:
    fx = F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))
    return fx * (F.lit(1.0) - fx) if deriv else fx


def tanh(x, deriv: bool = False) -> Column:
    t = F.tanh(_c(x))
    return F.lit(1.0) - t * t if deriv else t


def identity(x, deriv: bool = False) -> Column:
    return F.lit(1.0) if deriv else _c(x).cast("double")


def hlim(x, deriv: bool = False) -> Column:
    return F.lit(1.0) if deriv else F.when(_c(x) > 0, 1.0).otherwise(0.0)


def relu(x, deriv: bool = False) -> Column:
    if deriv:
        return F.when(_c(x) > 0, 1.0).otherwise(0.0)
    return F.when(_c(x) > 0, _c(x).cast("double")).otherwise(0.0)


SQUASH = {"LOGISTIC": logistic, "TANH": tanh, "IDENTITY": identity, "HLIM": hlim, "RELU": relu}


def round_js(x) -> Column:
    """JS Math.round: floor(x + 0.5)."""
    return F.floor(_c(x) + F.lit(0.5))


def clamp(x, lo, hi) -> Column:
    """greatest(lo, least(hi, x))."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


def manhattan10(r1, c1, r2, c2) -> Column:
    """Manhattan distance times 10 (the grid search heuristic)."""
    return (F.abs(_c(r1) - _c(r2)) + F.abs(_c(c1) - _c(c2))) * 10
