"""M1/M2: Gini decision trees grown exactly, a level of all trees at a time.

Equal rows are one row with a count. For each level Spark counts (tree, node,
feature, value, class), runs the class counts and the sums of their squares
along each feature's values (inside ``RANGES`` ranges of values, so that a feature
of a large node is spread over as many tasks), and takes the best threshold of every node by one aggregate.
There are no bins and no candidates in the driver: every midpoint between two
consecutive values is tried, whatever their number. Rows then go to their child
by a join with the level's splits.

Rules: the lowest weighted Gini wins; ties go to the first feature, then the
lowest threshold. A node of several classes is divided until ``max_depth``,
even where Gini doesn't fall, unless all its rows are equal. A null or NaN
feature is greater than all numbers; where only such rows differ, the threshold
is the largest number. Rows without a label don't count for its tree. A leaf's
class is the most frequent (ties: the lowest).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.prep import require_columns

#: nodes are numbered as in a heap (children 2 i and 2 i + 1), in 64 bits
MOST_LEVELS = 62
#: splits (a few dozen bytes each) that may be broadcast; beyond, joins shuffle
BROADCAST_ROWS = 100_000
#: ranges of values that a feature's running sums are cut into
RANGES = 64
_EXACT = "decimal(38,0)"  # squares of row counts
_NAN = float("nan")


def _values(features: Sequence[str]) -> list[Column]:
    """Features as doubles; null counts as NaN, -0.0 as 0.0."""
    return [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(_NAN)) + F.lit(0.0) for c in features]


def _range_of(value: Column, edges: list[float]) -> Column:
    """How many of the edges lie below a value."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda b: b < value)) if edges else F.lit(0)


def _running(rows: DataFrame, keys: list[str], sums: list[str], first: bool = False) -> DataFrame:
    """``rows`` with ``run_<c>`` (sum up to the row, along ``v``) and ``tot_<c>``
    for each of ``keys``. Runs are made inside the value ranges ``g`` and begin
    with the sums of the ranges before (at most ``RANGES`` rows of a key), so that
    no task holds all values of a key. ``first``: also ``v_next``."""
    inside = Window.partitionBy(*keys, "g").orderBy("v")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({f"run_{c}": F.sum(c).over(upto) for c in sums} | ({"v_next": F.lead("v").over(inside)} if first else {}))
    ranges = rows.groupBy(*keys, "g").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums], F.min("v").alias("_low"))
    along = Window.partitionBy(*keys).orderBy("g")
    before, every = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    ranges = ranges.withColumns({f"_b_{c}": F.sum(f"_s_{c}").over(before) for c in sums} | {f"tot_{c}": F.sum(f"_s_{c}").over(every) for c in sums}
                                | {"_next": F.lead("_low").over(along)}).drop("_low", *[f"_s_{c}" for c in sums])
    out = local.join(ranges, [*keys, "g"])
    out = out.withColumns({f"run_{c}": F.col(f"run_{c}") + F.coalesce(f"_b_{c}", F.lit(0)) for c in sums})
    if first:
        out = out.withColumn("v_next", F.coalesce("v_next", "_next"))
    return out.drop("_next", *[f"_b_{c}" for c in sums])


def _best_splits(rows: DataFrame, n_features: int) -> DataFrame:
    """(tree, node, feature, threshold): of ``rows(tree, node, x, g, k, n)``, for
    each node with several classes and different rows."""
    each = F.array(*[F.struct(F.lit(i).alias("f"), F.col("x")[i].alias("v"), F.col("g")[i].alias("g")) for i in range(n_features)])
    counts = rows.select("tree", "node", F.inline(each), "k", "n").groupBy("tree", "node", "f", "g", "v", "k").agg(F.sum("n").alias("n"))
    by_class = _running(counts, ["tree", "node", "f", "k"], ["n"])
    square = lambda c: c.cast(_EXACT) * c.cast(_EXACT)
    run, rest = F.col("run_n"), F.col("tot_n") - F.col("run_n")
    by_value = by_class.groupBy("tree", "node", "f", "g", "v").agg(
        F.sum("n").alias("n"),
        F.sum((square(run) - square(run - F.col("n"))).cast(_EXACT)).cast(_EXACT).alias("l"),
        F.sum((square(rest + F.col("n")) - square(rest)).cast(_EXACT)).cast(_EXACT).alias("r"),
    )
    s = _running(by_value, ["tree", "node", "f"], ["n", "l", "r"], first=True)
    nl, nr = F.col("run_n").cast("double"), (F.col("tot_n") - F.col("run_n")).cast("double")
    gl = 1.0 - F.col("run_l").cast("double") / (nl * nl)
    gr = 1.0 - (F.col("tot_r") - F.col("run_r")).cast("double") / (nr * nr)
    middle = (F.col("v") + F.col("v_next")) / 2
    # no number between two neighbours, or a missing value next: the lower one
    threshold = F.when(F.isnan("v_next") | (middle >= F.col("v_next")), F.col("v")).otherwise(middle)
    # all changes on the right add up to the squares of the node's class counts
    impure = F.col("tot_r") < square(F.col("tot_n"))
    tried = s.where(impure & F.col("v_next").isNotNull()).select(
        "tree", "node", F.struct(((nl * gl + nr * gr) / F.col("tot_n")).alias("impurity"), F.col("f").alias("feature"), threshold.alias("threshold")).alias("b")
    )
    return tried.groupBy("tree", "node").agg(F.min("b").alias("b")).select("tree", "node", "b.feature", "b.threshold")


@dataclass
class TreeModel:
    """``nodes(tree, id, depth, feature, threshold, k, n)``: a row for each class
    of each node; ``feature`` is null in leaves."""

    nodes: DataFrame
    features: list[str]
    labels: list[str]
    label_types: list[str]
    _flat: DataFrame | None = field(default=None, repr=False)

    def flat(self) -> DataFrame:
        """(tree, id, depth, feature, threshold, class, samples): a row a node, stored."""
        if self._flat is None:
            top = F.min(F.struct((-F.col("n")).alias("less"), F.col("k").alias("k")))
            g = self.nodes.groupBy("tree", "id", "depth", "feature", "threshold").agg(top.alias("top"), F.sum("n").alias("samples"))
            self._flat = g.select("tree", "id", "depth", "feature", "threshold", F.col("top.k").alias("class"), "samples").checkpoint(eager=True)
        return self._flat

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``pred_<label>`` for each label: one join with the nodes of a
        level for each level (no rows are looked up twice)."""
        flat = self.flat()
        depth = flat.agg(F.max("depth")).first()[0] or 0
        few = flat.count() <= BROADCAST_ROWS
        out = df.withColumn("_x", F.array(*_values(self.features)))
        for tree, (label, kind) in enumerate(zip(self.labels, self.label_types)):
            own = flat.where(F.col("tree") == tree)
            out = out.withColumn("_node", F.lit(1).cast("long"))
            for d in range(depth):
                level = own.where((F.col("depth") == d) & F.col("feature").isNotNull()).select(F.col("id").alias("_node"), "feature", "threshold")
                level = level.withColumnsRenamed({"feature": "_f", "threshold": "_t"})
                out = out.join(F.broadcast(level) if few else level, "_node", "left")
                right = (~(F.get("_x", F.col("_f")) <= F.col("_t"))).cast("long")
                out = out.withColumn("_node", F.coalesce(F.col("_node") * 2 + right, F.col("_node"))).drop("_f", "_t")
            leaf = own.select(F.col("id").alias("_node"), F.col("class").cast(kind).alias(f"pred_{label}"))
            out = out.drop(f"pred_{label}").join(F.broadcast(leaf) if few else leaf, "_node", "left").drop("_node")
        return out.drop("_x")

    def table(self, tree: int = 0) -> DataFrame:
        """(id, feature, threshold, gini, samples, value, class, left, right)
        of one tree; ``value`` has the counts of all its classes in order."""
        own = self.nodes.where(F.col("tree") == tree)
        classes = own.agg(F.array_sort(F.collect_set("k")).alias("_classes"))
        g = own.groupBy("id", "feature", "threshold").agg(
            F.sum("n").alias("samples"), F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("_by")
        )
        g = g.join(F.broadcast(classes)).withColumn("value", F.expr("transform(_classes, c -> coalesce(element_at(_by, c), 0L))"))
        share = lambda a, c: a + (c / F.col("samples")) * (c / F.col("samples"))
        inner = F.col("feature").isNotNull()
        names = F.array(*[F.lit(f) for f in self.features])
        return g.select(
            "id", F.get(names, F.col("feature")).alias("feature"), "threshold",
            (1.0 - F.aggregate("value", F.lit(0.0), share)).alias("gini"), "samples", "value",
            F.element_at("_classes", F.array_position("value", F.array_max("value")).cast("int")).alias("class"),
            F.when(inner, F.col("id") * 2).otherwise(-1).alias("left"), F.when(inner, F.col("id") * 2 + 1).otherwise(-1).alias("right"),
        )

    def save(self, path: str) -> None:
        """Nodes as Parquet, and one row that says what they split."""
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"features": self.features, "labels": self.labels, "label_types": self.label_types})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        """S11."""
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return TreeModel(spark.read.parquet(f"{path}/nodes"), **meta)


def grow_trees(df: DataFrame, features: Sequence[str], labels: Sequence[str], max_depth: int | None = 5) -> TreeModel:
    """A tree for each label over the same features. ``max_depth=None``: until
    every leaf is pure or its rows are equal (raises where a tree would be
    deeper than ``MOST_LEVELS``). Labels are all numbers or all strings."""
    features, labels = list(features), list(labels)
    require_columns(df, features + labels)
    types = [df.schema[c].dataType for c in labels]
    kinds = {"string" if isinstance(t, T.StringType) else "double" for t in types}
    if len(kinds) != 1:
        raise ValueError("labels are all numbers or all strings")
    each = F.array(*[F.struct(F.lit(i).alias("tree"), F.col(f"`{c}`").cast(*kinds).alias("k")) for i, c in enumerate(labels)])
    # classes of one tree, and both trees' rows, in one table
    rows = df.select(F.array(*_values(features)).alias("x"), F.inline(each)).where("k is not null")
    rows = rows.groupBy("tree", "x", "k").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    # ranges of values with about as many rows each: where they are cut doesn't change a split
    cuts = [F.percentile_approx(F.col("x")[i], [j / RANGES for j in range(1, RANGES)], 10 * RANGES).alias(f"c{i}") for i in range(len(features))]
    edges = [sorted({v for v in c or () if v == v}) for c in rows.agg(*cuts).first()]
    place = [_range_of(F.col("x")[i], e) for i, e in enumerate(edges)]
    rows = rows.withColumns({"g": F.array(*place), "node": F.lit(1).cast("long")}).checkpoint(eager=True)
    levels, depth, n_splits = [], 0, 1
    while n_splits:
        counts = rows.groupBy("tree", "node", "k").agg(F.sum("n").alias("n")).select("tree", F.col("node").alias("id"), "k", "n")
        if max_depth is not None and depth >= max_depth:
            levels.append((counts, depth, None))
            break
        if depth > MOST_LEVELS:
            raise ValueError(f"a tree is deeper than {MOST_LEVELS} levels")
        splits = _best_splits(rows, len(features)).checkpoint(eager=True)
        n_splits = splits.count()
        if n_splits <= BROADCAST_ROWS:
            splits = F.broadcast(splits)
        levels.append((counts, depth, splits))
        if n_splits:
            right = (~(F.get("x", F.col("feature")) <= F.col("threshold"))).cast("long")
            rows = rows.join(splits, ["tree", "node"]).select("tree", "x", "g", "k", "n", (F.col("node") * 2 + right).alias("node")).checkpoint(eager=True)
        depth += 1
    out = None
    for counts, depth, splits in levels:
        if splits is None:
            level = counts.withColumns({"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")})
        else:
            level = counts.join(splits.withColumnRenamed("node", "id"), ["tree", "id"], "left")
        level = level.select("tree", "id", F.lit(depth).alias("depth"), "feature", "threshold", "k", "n")
        out = level if out is None else out.unionByName(level)
    return TreeModel(out, features, labels, [t.simpleString() for t in types])
