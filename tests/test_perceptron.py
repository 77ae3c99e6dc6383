"""A perceptron by whole-table steps against plain numpy steps."""

import numpy as np
import pytest

from tessera.plans import perceptron
from tessera.sources.tables import scratch_path

XOR = [(0.0, 0.0, 0, 0), (0.0, 1.0, 1, 0), (1.0, 0.0, 1, 0), (1.0, 1.0, 0, 1)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(XOR, "a double, b double, x int, y int").coalesce(2)


def plain(layers, x, t, rate, steps):
    for _ in range(steps):
        acts = [x]
        for w, b in layers:
            acts.append(1 / (1 + np.exp(-(acts[-1] @ w.T + b))))
        resp, moved = t - acts[-1], []
        for (w, b), a in zip(layers[::-1], acts[-2::-1]):
            moved.insert(0, (w + rate * resp.T @ a / len(x), b + rate * resp.mean(axis=0)))
            resp = (resp @ w) * a * (1 - a)
        layers = moved
    return layers


def test_exclusive_or_reaches_its_target(spark, table):
    m = perceptron.fit_perceptron(table, ["a", "b"], ["x"], [8], rate=12.0, iterations=150, error=0.02, seed=4)
    assert m.reached and m.costs[-1] <= 0.02 < m.costs[-2] and len(m.costs) < 100
    x, t = np.array([r[:2] for r in XOR]), np.array([[r[2]] for r in XOR], float)
    want = plain(perceptron.first_weights([2, 8, 1], 4), x, t, 12.0, len(m.costs) - 1)
    for (w, b), (v, c) in zip(m.layers, want):
        assert np.allclose(w, v) and np.allclose(b, c)
    out = {(r.a, r.b): r.out_x for r in m.transform(table).collect()}
    assert all(abs(out[a, b] - x) < 0.4 for a, b, x, _ in XOR)
    path = scratch_path(spark, "perceptron")
    m.save(path)
    back = perceptron.Perceptron.load(path).transform(table)
    assert {(r.a, r.b): r.out_x for r in back.collect()} == pytest.approx(out)


def test_two_outputs_and_a_callers_cost(spark, table):
    rows = table.unionByName(spark.createDataFrame([(None, 1.0, 1, 1), (float("nan"), 1.0, 1, 1)], table.schema))
    seen = []
    m = perceptron.fit_perceptron(rows, ["a", "b"], ["x", "y"], [8], rate=8.0, iterations=12, error=0.0, seed=5,
                                  cost=lambda t, o: np.abs(t - o).max(axis=1), progress=lambda i, c: seen.append((i, c)))
    x, t = np.array([r[:2] for r in XOR]), np.array([r[2:] for r in XOR], float)
    want = plain(perceptron.first_weights([2, 8, 2], 5), x, t, 8.0, 12)
    assert all(np.allclose(w, v) and np.allclose(b, c) for (w, b), (v, c) in zip(m.layers, want))
    assert len(m.costs) == 13 and not m.reached and [c for _, c in seen] == m.costs[:-1]
    out = m.transform(table)
    worst = max(max(abs(r.out_x - r.x), abs(r.out_y - r.y)) for r in out.collect())
    assert worst <= 1 and m.costs[-1] == pytest.approx(np.mean([max(abs(r.out_x - r.x), abs(r.out_y - r.y)) for r in out.collect()]))
    stopped = perceptron.fit_perceptron(table, ["a", "b"], ["x", "y"], progress=lambda i, c: i < 2, iterations=50)
    assert len(stopped.costs) == 3
    with pytest.raises(ValueError):
        perceptron.fit_perceptron(table.limit(0), ["a"], ["x"])
