"""Array functions (F20-F23, G8, G13) as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.activations import round_js


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def one_hot(i, n: int) -> Column:
    """array of n doubles, 1 at index i (zero-based)."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda k: F.when(k == _c(i), 1.0).otherwise(0.0))


def threshold(a, t: float = 0.5) -> Column:
    """1 where the value is above t, else 0."""
    return F.transform(_c(a), lambda x: F.when(x > t, 1).otherwise(0))


def argmax(a) -> Column:
    """First index of the maximum; -1 when no value is above 0."""
    arr = _c(a)
    return F.when(F.array_max(arr) > 0, F.array_position(arr, F.array_max(arr)) - 1).otherwise(
        F.lit(-1).cast("long"))


def argmax_equal(a, b) -> Column:
    return argmax(a) == argmax(b)


def rounded_equal(a, b) -> Column:
    """Every element equal after JS rounding."""
    return F.forall(F.zip_with(_c(a), _c(b), lambda x, y: round_js(x) == round_js(y)),
                    lambda v: v)


def symbol_index(c, mapping: dict) -> Column:
    """symbol -> index through a literal map (null when unknown)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), _c(c))


def slice_from(a, start: int, length: int) -> Column:
    """``length`` elements from position ``start`` (from 1)."""
    return F.slice(_c(a), start, length)


def reversed_array(a) -> Column:
    """the elements in reverse order."""
    return F.reverse(_c(a))


def push(a, *values) -> Column:
    """the array with values at its end."""
    return F.concat(_c(a), F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]))


def check_size(a, n: int) -> Column:
    """fail the task when an array does not have n elements."""
    return F.when(F.size(_c(a)) == n, _c(a)).otherwise(
        F.raise_error(F.lit(f"array size differs from {n}")))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def cost_mse(t, o) -> Column:
    """Mean over outputs of squared error."""
    return _sum(F.zip_with(_c(t), _c(o), lambda x, y: F.pow(x - y, 2))) / F.size(_c(o))


def cost_cross_entropy(t, o) -> Column:
    """Summed cross-entropy with the 1e-15 nudge."""
    return -_sum(F.zip_with(
        _c(t), _c(o),
        lambda x, y: x * F.log(y + F.lit(1e-15)) + (F.lit(1.0) - x) * F.log(F.lit(1.0 + 1e-15) - y)))


def cost_binary(t, o) -> Column:
    """Outputs whose JS round(2x) differs from the target's."""
    return F.aggregate(
        F.zip_with(_c(t), _c(o), lambda x, y: F.when(round_js(x * 2) != round_js(y * 2), 1).otherwise(0)),
        F.lit(0), lambda acc, v: acc + v)


COSTS = {"MSE": cost_mse, "CROSS_ENTROPY": cost_cross_entropy, "BINARY": cost_binary}
