"""A perceptron fitted by whole-table gradient steps.

Layers are fully connected, logistic by default. A step scores all rows, block by
block in the tasks (numpy), adds up the gradient of each task there, and Spark
sums the tasks' gradients by weight: the driver gets one row for each weight,
whatever the number of rows. The same pass gives the mean cost of the weights
before the step, so that fitting stops when it has reached the error target.

An output's responsibility is target minus output (the gradient of the
cross-entropy), a hidden neuron's is the slope of its squash times what it passes
on; a weight moves by ``rate`` times the mean of responsibility times input. The
cost function only decides when to stop. Rows with a null or non-finite feature
or target take no part.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import network
from tessera.operators.prep import require_columns

_TINY = 1e-15  # fixed value: keeps logarithms finite

#: mean cost of each row of (targets, outputs)
COSTS: dict[str, Callable] = {
    "MSE": lambda t, o: ((t - o) ** 2).mean(axis=1),
    "CROSS_ENTROPY": lambda t, o: -(t * np.log(o + _TINY) + (1 - t) * np.log(1 + _TINY - o)).sum(axis=1),
    "BINARY": lambda t, o: (np.floor(2 * t + 0.5) != np.floor(2 * o + 0.5)).sum(axis=1).astype(float),
}

Layers = list[tuple[np.ndarray, np.ndarray]]  # (weights: neuron x input, bias) of each layer


def first_weights(sizes: Sequence[int], seed: int = 42) -> Layers:
    """Uniform weights in [-1, 1) for layers of ``sizes`` (inputs first)."""
    rng = np.random.default_rng(seed)
    return [(rng.uniform(-1, 1, (n, m)), rng.uniform(-1, 1, n)) for m, n in zip(sizes, sizes[1:])]


def gradient(layers: Layers, x: np.ndarray, t: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(sums of responsibility times input for each layer's weights and bias,
    outputs) of some rows."""
    acts = [x]
    for w, b in layers:
        acts.append(1 / (1 + np.exp(-(acts[-1] @ w.T + b))))
    out: list[np.ndarray] = []
    resp = t - acts[-1]
    for (w, _), a in zip(layers[::-1], acts[-2::-1]):
        out = [resp.T @ a, resp.sum(axis=0), *out]
        resp = (resp @ w) * a * (1 - a)
    return out, acts[-1]


@dataclass
class Perceptron:
    layers: Layers
    features: list[str]
    targets: list[str]
    costs: list[float] = field(default_factory=list)  # mean cost before each step, and of the result
    reached: bool = False  # the error target

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``out_<target>`` (a projection without Python)."""
        spec = [{"weights": w.tolist(), "bias": b.tolist(), "squash": "LOGISTIC"} for w, b in self.layers]
        scored = network.score_network(df, [F.col(f"`{c}`").cast("double") for c in self.features], spec, out_prefix="_out")
        return scored.withColumnsRenamed({f"_out{i}": f"out_{c}" for i, c in enumerate(self.targets)})

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {"layers": [[w.tolist(), b.tolist()] for w, b in self.layers], "features": self.features, "targets": self.targets}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(path: str) -> Perceptron:
        meta = json.loads(SparkSession.getActiveSession().read.text(path).first()[0])
        return Perceptron([(np.array(w), np.array(b)) for w, b in meta["layers"]], meta["features"], meta["targets"])


def _step(rows: DataFrame, layers: Layers, n_in: int, cost: Callable) -> tuple[np.ndarray, float, int]:
    """(sum of the gradients of all weights, sum of the costs, rows)."""

    def run(batches):
        total, spent, n = None, 0.0, 0
        for batch in batches:
            both = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            parts, out = gradient(layers, both[:, :n_in], both[:, n_in:])
            flat = np.concatenate([p.ravel() for p in parts])
            total = flat if total is None else total + flat
            spent, n = spent + float(cost(both[:, n_in:], out).sum()), n + batch.num_rows
        if n:
            value = np.concatenate([total, [spent, n]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value))), pa.array(value)], names=["i", "v"])

    sums = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").toPandas()["v"].to_numpy()
    return sums[:-2], float(sums[-2]), int(sums[-1])


def fit_perceptron(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], hidden: Sequence[int] = (), *, rate: float = 0.5, iterations: int = 500,
    error: float = 0.005, cost: str | Callable = "MSE", seed: int = 42, start: Layers | None = None,
    progress: Callable[[int, float], object] | None = None,
) -> Perceptron:
    """Fit until the mean cost of a row is at most ``error``, for at most
    ``iterations`` steps. ``cost``: a name of ``COSTS`` or a function of (targets,
    outputs) arrays that returns each row's cost. ``progress(step, mean cost)`` is
    called before each step; False ends the fit."""
    features, targets = list(features), list(targets)
    require_columns(df, features + targets)
    measure = COSTS[cost] if isinstance(cost, str) else cost
    layers = start or first_weights([len(features), *hidden, len(targets)], seed)
    both = F.array(*[F.col(f"`{c}`").cast("double") for c in features + targets])
    rows = df.select(both.alias("v")).where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).checkpoint(eager=True)
    if rows.isEmpty():
        raise ValueError("no rows to fit")
    model = Perceptron(layers, features, targets)
    for step in range(iterations + 1):
        flat, spent, n = _step(rows, model.layers, len(features), measure)
        model.costs.append(spent / n)
        model.reached = model.costs[-1] <= error
        if model.reached or step == iterations or (progress is not None and progress(step, model.costs[-1]) is False):
            break
        moved, at = [], 0
        for w, b in model.layers:
            dw, at = flat[at : at + w.size].reshape(w.shape), at + w.size
            db, at = flat[at : at + b.size], at + b.size
            moved.append((w + rate * dw / n, b + rate * db / n))
        model.layers = moved
    return model
