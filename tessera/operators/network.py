"""Layered networks as tables.

A network is two tables: neurons ``(id, layer, bias, squash)`` and
connections ``(from, to, weight)``. Two ways to score rows:

* ``score_network``: the weights of a (small, fixed) feed-forward network are
  compiled into Column arithmetic, so scoring is a projection inside
  whole-stage codegen: no join, no Python;
* ``weighted_sum``: the set form, connections joined to long-format
  activations and summed per target (used when the network itself is data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.activations import SQUASH

# fields of an exported network; a neuron has no id, its place in the list is it
_TRACE = "struct<elegibility: map<string,double>, extended: map<string,map<string,double>>>"
NEURON = f"trace {_TRACE}, state double, old double, activation double, bias double, layer string, squash string"
CONNECTION = "`from` int, `to` int, weight double, gater int"
NETWORK = f"neurons array<struct<{NEURON}>>, connections array<struct<{CONNECTION}>>"


def network_from_json(df: DataFrame, col: str = "json") -> tuple[DataFrame, DataFrame]:
    """S12 in: JSON text -> (neurons, connections) tables. A neuron's ``id`` is
    its position in the list, which connections refer to; absent fields are
    null."""
    parsed = df.select(F.from_json(F.col(col), NETWORK).alias("n"))
    neurons = parsed.select(F.posexplode("n.neurons").alias("id", "_u")).select("id", "_u.*")
    conns = parsed.select(F.inline("n.connections"))
    return neurons, conns


def network_to_json(neurons: DataFrame, conns: DataFrame) -> DataFrame:
    """S12 out: (neurons, connections) -> one JSON text, neurons in the order
    of their ids (which must count from 0), without the ids."""
    unit = F.struct(*[c for c in neurons.columns if c != "id"])
    # maps have no order: only the ids (unique) are sorted by
    n = neurons.agg(F.map_from_entries(F.collect_list(F.struct(F.col("id"), unit))).alias("_u")).select(
        F.transform(F.array_sort(F.map_keys("_u")), lambda i: F.element_at("_u", i)).alias("neurons"))
    c = conns.agg(F.array_sort(F.collect_list(F.struct(*conns.columns))).alias("connections"))
    return n.crossJoin(c).select(F.to_json(F.struct("neurons", "connections")).alias("json"))


def score_network(df: DataFrame, inputs: Sequence[Column], layers: Sequence[dict],
                  out_prefix: str = "out") -> DataFrame:
    """Feed-forward scoring. ``layers`` = [{"weights": [[w_ij]] (rows =
    this layer's neurons), "bias": [b_j], "squash": "LOGISTIC"}, ...]."""
    acts = list(inputs)
    for layer in layers:
        sq = layer.get("squash", "LOGISTIC")
        fn = sq if callable(sq) else SQUASH[sq]  # X2: a caller's Column -> Column
        nxt = []
        for row, b in zip(layer["weights"], layer["bias"]):
            z = F.lit(float(b))
            for w, a in zip(row, acts):
                z = z + F.lit(float(w)) * a
            nxt.append(fn(z))
        acts = nxt
    return df.select("*", *[a.alias(f"{out_prefix}{i}") for i, a in enumerate(acts)])


def weighted_sum(conns: DataFrame, acts: DataFrame, gain: str | None = None, max_broadcast: int = 100_000) -> DataFrame:
    """``acts(row_id, node, value)`` x ``conns(from, to, weight)`` ->
    ``(row_id, node, value)`` input sums per target node. A node may have a
    value in every row, so rows aren't dealt by it: connections are broadcast
    up to a number of them, beyond it each node's rows and connections are
    dealt to several tasks by the row."""
    if conns.limit(max_broadcast + 1).count() <= max_broadcast:
        j = acts.join(F.broadcast(conns), acts["node"] == conns["from"])
    else:
        n = int(acts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = acts.withColumn("_part", F.pmod(F.xxhash64("row_id"), F.lit(n)))
        links = conns.withColumn("_part", F.explode(F.expr(f"sequence(0L, {n - 1}L)")))
        j = rows.join(links, (rows["node"] == links["from"]) & (rows["_part"] == links["_part"]))
    term = F.col("value") * F.col("weight")
    if gain:
        term = term * F.col(gain)
    return j.groupBy("row_id", F.col("to").alias("node")).agg(F.sum(term).alias("value"))


def layer_edges(a: DataFrame, b: DataFrame, rule: str, max_pairs: int = 10_000_000) -> DataFrame:
    """Connect layer ``a(id, pos)`` to ``b(id, pos)`` by rule:
    ``all_to_all``, ``one_to_one`` (equal positions) or ``all_to_else``
    (all pairs except equal ids). Layers are neuron lists: the pair count is
    checked before any all-pairs join is planned."""
    if rule == "one_to_one":
        return a.select(F.col("id").alias("from"), "pos").join(
            b.select(F.col("id").alias("to"), "pos"), "pos").select("from", "to")
    na, nb = a.count(), b.count()
    if na * nb > max_pairs:
        raise ValueError(f"{na} x {nb} connections exceed {max_pairs}")
    pairs = a.select(F.col("id").alias("from")).crossJoin(F.broadcast(b.select(F.col("id").alias("to"))))
    if rule == "all_to_all":
        return pairs
    if rule == "all_to_else":
        return pairs.where(F.col("from") != F.col("to"))
    raise ValueError(f"unknown rule {rule}")


def link_type(edges: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """edges = n*m -> all_to_all; edges = n on equal positions ->
    one_to_one; else 'other'. One row."""
    pa = a.select(F.col("id").alias("from"), F.col("pos").alias("pa"))
    pb = b.select(F.col("id").alias("to"), F.col("pos").alias("pb"))
    e = edges.join(pa, "from").join(pb, "to")
    stats = e.agg(F.count(F.lit(1)).alias("n_edges"),
                  F.sum(F.when(F.col("pa") == F.col("pb"), 1).otherwise(0)).cast("bigint").alias("n_same_pos"))
    sizes = a.agg(F.count(F.lit(1)).alias("n_a")).crossJoin(b.agg(F.count(F.lit(1)).alias("n_b")))
    s = stats.crossJoin(sizes)
    return s.withColumn(
        "link", F.when(F.col("n_edges") == F.col("n_a") * F.col("n_b"), "all_to_all")
        .when((F.col("n_edges") == F.col("n_a")) & (F.col("n_same_pos") == F.col("n_a")), "one_to_one")
        .otherwise("other"))
