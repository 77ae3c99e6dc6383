"""Tree statistics.

``best_split`` evaluates every midpoint between consecutive distinct values
of one feature by weighted Gini. Sums of squared class counts left and right of
a value are running sums of the changes that each (class, value) row makes, so
the number of classes is free: one skew-safe scan per class, one over values
(a global order is one hot key). ``node_stats`` reads one ``groupBy(node,
label)``. Rows without a label take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import keyed_scan

_EXACT = "decimal(38,0)"  # squares of row counts


def best_split(df: DataFrame, feature: str, label: str) -> DataFrame:
    """The threshold (midpoint of two consecutive distinct values) with the
    lowest weighted Gini; ties -> lowest threshold. One row: feature,
    threshold, impurity, n_left, n_right; none with fewer than two values."""
    counts = df.where(F.col(label).isNotNull() & F.col(feature).isNotNull()).groupBy(
        F.col(label).alias("k"), F.col(feature).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    per_class = keyed_scan(counts, ["k"], ["v"], sums=["n"], totals=True)
    sq = lambda c: F.col(c).cast(_EXACT) * F.col(c).cast(_EXACT)
    moves = per_class.withColumns({
        "_l0": F.col("run_n") - F.col("n"), "_r1": F.col("tot_n") - F.col("run_n"),
    }).withColumn("_r0", F.col("_r1") + F.col("n"))
    by_value = moves.groupBy("v").agg(
        F.sum("n").alias("n"),
        F.sum((sq("run_n") - sq("_l0")).cast(_EXACT)).cast(_EXACT).alias("l"),
        F.sum((sq("_r0") - sq("_r1")).cast(_EXACT)).cast(_EXACT).alias("r"))
    s = keyed_scan(by_value, [], ["v"], sums=["n", "l", "r"], totals=True)
    nxt = s.select((F.col("rn") - 1).alias("rn"), F.col("v").alias("v_next"))
    nl, nr = F.col("run_n").cast("double"), (F.col("tot_n") - F.col("run_n")).cast("double")
    # all changes on the right add up to the squares before the first value
    gl = 1.0 - F.col("run_l").cast("double") / (nl * nl)
    gr = 1.0 - (F.col("tot_r") - F.col("run_r")).cast("double") / (nr * nr)
    return s.join(nxt, "rn").select(
        F.lit(feature).alias("feature"),
        ((F.col("v") + F.col("v_next")) / 2).alias("threshold"),
        ((nl * gl + nr * gr) / F.col("tot_n")).alias("impurity"),
        nl.cast("bigint").alias("n_left"), nr.cast("bigint").alias("n_right"),
    ).orderBy("impurity", "threshold").limit(1)


def node_stats(df: DataFrame, node: str, label: str) -> DataFrame:
    """Per node samples, class counts in class order, Gini and the
    majority class (ties -> lowest class). The list of classes is one row, as
    wide as the ``value`` of a node."""
    counts = df.where(F.col(label).isNotNull()).groupBy(node, label).agg(F.count(F.lit(1)).alias("_n"))
    classes = df.where(F.col(label).isNotNull()).agg(F.array_sort(F.collect_set(label)).alias("_classes"))
    g = counts.groupBy(node).agg(
        F.sum("_n").alias("samples"),
        F.map_from_entries(F.collect_list(F.struct(F.col(label), "_n"))).alias("_by"))
    g = g.join(F.broadcast(classes)).withColumn(
        "value", F.expr("transform(_classes, c -> coalesce(element_at(_by, c), 0L))"))
    gini = 1.0 - F.aggregate("value", F.lit(0.0), lambda a, c: a + (c / F.col("samples")) * (c / F.col("samples")))
    first = F.array_position("value", F.array_max("value")).cast("int")
    return g.select(node, "samples", "value", gini.alias("gini"), F.element_at("_classes", first).alias("class"))
