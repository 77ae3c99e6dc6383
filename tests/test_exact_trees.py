"""Exact trees against a plain recursive one."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.plans import models
from tessera.plans.exact_trees import TreeModel, grow_trees
from tessera.sources.tables import scratch_path


def gini_sum(rows):
    n, classes = len(rows), {}
    for *_, k in rows:
        classes[k] = classes.get(k, 0) + 1
    return n * (1.0 - sum(c * c for c in classes.values()) / (n * n)) if n else 0.0


def plain_tree(rows, n_features, depth, node=1):
    """{node: (feature, threshold) or None} by trying every threshold."""
    best = None
    if depth and len({r[-1] for r in rows}) > 1:
        for f in range(n_features):
            values = sorted({r[f] for r in rows}, key=lambda v: (math.isnan(v), v))
            for v, after in zip(values, values[1:]):
                t = v if math.isnan(after) or (v + after) / 2 >= after else (v + after) / 2
                left, right = [r for r in rows if r[f] <= t], [r for r in rows if not r[f] <= t]
                key = (round((gini_sum(left) + gini_sum(right)) / len(rows), 12), f, t)
                if best is None or key < best[0]:
                    best = (key, left, right)
    if best is None:
        return {node: None}
    (_, f, t), left, right = best
    return {node: (f, t)} | plain_tree(left, n_features, depth - 1, 2 * node) | plain_tree(right, n_features, depth - 1, 2 * node + 1)


def grown(model, tree=0):
    return {r.id: (r.feature, r.threshold) if r.feature is not None else None
            for r in model.flat().where(F.col("tree") == tree).collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    nan = float("nan")
    out = []
    for _ in range(400):
        a, b = rng.choice([rng.random(), round(rng.random(), 1)]), rng.choice([float(rng.randrange(5)), nan])
        out.append((a, b, float(rng.randrange(2)), (int(a * 3 + (b if b == b else 7)) + (rng.random() < 0.1)) % 3, rng.choice([0, 1, None])))
    return out + out[:60]  # equal rows


def test_equals_plain_tree(spark, rows):
    null = [(a, None if b != b else b, c, y, z) for a, b, c, y, z in rows]
    df = spark.createDataFrame(null, "a double, b double, c double, y int, z int").repartition(6)
    m = grow_trees(df, ["a", "b", "c"], ["y", "z"], max_depth=4)
    assert grown(m) == plain_tree([(*r[:3], r[3]) for r in rows], 3, 4)
    assert grown(m, 1) == plain_tree([(*r[:3], r[4]) for r in rows if r[4] is not None], 3, 4)
    one = grow_trees(df, ["a", "b", "c"], ["y"], max_depth=4)
    assert grown(one) == grown(m)
    # counts of a node are its children's, and predictions are the leaves' classes
    by_id = {r.id: r for r in m.table().collect()}
    for r in by_id.values():
        if r.left >= 0:
            assert [x + z for x, z in zip(by_id[r.left].value, by_id[r.right].value)] == list(r.value)
    for r, p in zip(null, m.transform(df.withColumn("i", F.monotonically_increasing_id())).collect()):
        node = 1
        while by_id[node].left >= 0:
            f, t = {"a": "a", "b": "b", "c": "c"}[by_id[node].feature], by_id[node].threshold
            node = 2 * node + (0 if p[f] is not None and p[f] <= t else 1)
        assert p.pred_y == by_id[node]["class"]


def test_unbounded_tree_and_equal_rows(spark):
    # exclusive or: the first split gains nothing
    xor = [(float(i % 2), float(i // 2 % 2), i % 2 ^ i // 2 % 2) for i in range(40)]
    df = spark.createDataFrame(xor, "a double, b double, y int")
    m = models.fit_tree(df, ["a", "b"], "y", max_depth=None)
    assert m.transform(df).where("pred_y <> y").isEmpty()
    # rows that differ in the class only stay together
    same = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "a double, y int")
    leaf = models.fit_tree(same, ["a"], "y", max_depth=None).table().collect()
    assert len(leaf) == 1 and leaf[0]["class"] == 1.0 and leaf[0].samples == 3
    assert models.fit_tree(same.limit(0), ["a"], "y").table().count() == 0


def test_many_values_and_a_hot_one(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5000.5).otherwise(F.col("id").cast("double")).alias("x"),
                                    (F.col("id") >= 20_000).cast("int").alias("y"))
    m = models.fit_tree(df, ["x"], "y", max_depth=1)
    root = m.flat().where("id = 1").first()
    assert root.threshold == 19_999.5


def test_strings_and_saved_models(spark, rows):
    df = spark.createDataFrame([(r[0], "no" if r[3] else "yes") for r in rows], "a double, y string")
    m = models.fit_tree(df, ["a"], "y", max_depth=3)
    path = scratch_path(spark, "tree-model")
    models.save_model(m, path)
    back = models.load_model(path)
    assert isinstance(back, TreeModel)
    want = [r.pred_y for r in m.transform(df).orderBy("a", "y").collect()]
    assert [r.pred_y for r in back.transform(df).orderBy("a", "y").collect()] == want and set(want) == {"yes", "no"}
    with pytest.raises(ValueError):
        grow_trees(df.withColumn("z", F.lit(1)), ["a"], ["y", "z"])
