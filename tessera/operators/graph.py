"""Grid graphs and shortest paths.

``shortest_paths`` relaxes a frontier set-at-a-time (Bellman-Ford by rounds):
each round joins only the nodes improved in the previous round with their
edges and keeps the minimum per target. Lineage is cut every round with
``checkpoint`` into the shared checkpoint folder.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 8 neighbour offsets (row, col) and their step costs
# (10 straight, 14 diagonal).
NEIGHBOURS = [(-1, -1, 14), (-1, 0, 10), (-1, 1, 14), (0, -1, 10), (0, 1, 10),
              (1, -1, 14), (1, 0, 10), (1, 1, 14)]


def cell_number(r, c, n_rows: int):
    """Cells numbered by column then row, from 1."""
    return c * n_rows + r + 1


def grid_edges(cells: DataFrame, row: str = "r", col: str = "c") -> DataFrame:
    """Directed edges from every present cell to its present 8-neighbours.

    Missing cells are walls. The 8 offsets are a literal array exploded per
    cell (no join); the neighbour must exist: a semi join on its coordinates."""
    offs = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc"), F.lit(w).alias("w"))
                     for a, b, w in NEIGHBOURS])
    c = cells.select(F.col(row).alias("r"), F.col(col).alias("c")).distinct()
    cand = c.select("r", "c", F.inline(offs)).select(
        F.col("r").alias("src_r"), F.col("c").alias("src_c"),
        (F.col("r") + F.col("dr")).alias("dst_r"), (F.col("c") + F.col("dc")).alias("dst_c"), "w")
    dst = c.select(F.col("r").alias("dst_r"), F.col("c").alias("dst_c"))
    return cand.join(dst, ["dst_r", "dst_c"], "left_semi")


def _compose(ea: DataFrame, eb: DataFrame) -> DataFrame:
    """Min-plus product: paths u -> v (ea) then v -> w (eb), cheapest per
    (u, w); ``via`` is the predecessor of w on that path (from eb)."""
    a = ea.select(F.col("_s"), F.col("_d").alias("_m"), F.col("_w").alias("_wa"))
    b = eb.select(F.col("_s").alias("_m"), F.col("_d"), F.col("_w").alias("_wb"), F.col("_via"))
    j = a.join(b, "_m").where(F.col("_s") != F.col("_d")).select(
        "_s", "_d", (F.col("_wa") + F.col("_wb")).alias("_w"), "_via")
    return j


def _min_edges(e: DataFrame) -> DataFrame:
    return e.groupBy("_s", "_d").agg(F.min(F.struct("_w", "_via")).alias("_b")).select(
        "_s", "_d", "_b._w", "_b._via")


def hop_closure(e: DataFrame, max_power: int = 8, pair_budget: int = 50_000_000,
                growth_budget: int = 64) -> tuple[DataFrame, int]:
    """Edges for paths of up to ``p`` hops (p a power of two <= max_power),
    cheapest per (src, dst). Squaring stops early when the next join would
    produce more than ``pair_budget`` pairs (sum over middle nodes of
    in-degree x out-degree, computed before joining) or the edge table would
    outgrow ``growth_budget`` times the original. Returns (edges, p)."""
    base_n = e.count()
    cur, power = e, 1
    while power * 2 <= max_power:
        indeg = cur.groupBy(F.col("_d").alias("_v")).agg(F.count(F.lit(1)).alias("_i"))
        outdeg = cur.groupBy(F.col("_s").alias("_v")).agg(F.count(F.lit(1)).alias("_o"))
        pairs = indeg.join(outdeg, "_v").agg(F.sum(F.col("_i") * F.col("_o"))).first()[0] or 0
        if pairs > pair_budget:
            break
        nxt = _min_edges(cur.unionByName(_compose(cur, cur))).checkpoint(eager=True)
        if nxt.count() > growth_budget * max(base_n, 1):
            break
        cur, power = nxt, power * 2
    return cur, power


def shortest_paths(edges: DataFrame, sources: DataFrame, src: str = "src", dst: str = "dst",
                   w: str = "w", max_power: int = 4, on_round=None) -> DataFrame:
    """R1 + R2: cheapest cost from any source to every reachable node, with
    the predecessor on one cheapest path (ties -> lowest predecessor).

    ``edges(src, dst, w)`` with non-negative weights, ``sources(node)``;
    returns ``(node, cost, prev)``.

    First the edges are closed under up to ``max_power`` hops (min-plus
    squaring, size-checked before every join), then the distances are relaxed
    set-at-a-time from the nodes improved in the previous round. Every
    multi-hop edge is a real path whose last-hop predecessor travels along,
    so costs and predecessors are exact, and the number of rounds drops by
    about the hop power. Each round is checkpointed (lineage cut).
    ``on_round(info) -> bool`` (X3) may stop the loop early."""
    e = edges.select(F.col(src).alias("_s"), F.col(dst).alias("_d"), F.col(w).cast("long").alias("_w"),
                     F.col(src).alias("_via"))
    e = _min_edges(e).checkpoint(eager=True)
    e, _ = hop_closure(e, max_power=max_power)
    ptype = edges.schema[src].dataType
    dist = sources.select(F.col("node"), F.lit(0).cast("long").alias("cost"),
                          F.lit(None).cast(ptype).alias("prev"), F.lit(True).alias("_new"))
    dist = dist.checkpoint(eager=True)
    for i in itertools.count():
        wave = dist.where("_new").select("node", "cost")
        cand = wave.join(e, wave["node"] == e["_s"]).select(
            F.col("_d").alias("node"), (F.col("cost") + F.col("_w")).alias("cost"),
            F.col("_via").alias("prev"))
        best = cand.groupBy("node").agg(F.min(F.struct("cost", "prev")).alias("_b")).select(
            "node", F.col("_b.cost").alias("_nc"), F.col("_b.prev").alias("_np"))
        old = dist.select("node", "cost", "prev")
        m = old.join(best, "node", "full_outer")
        better = F.col("_nc").isNotNull() & (F.col("cost").isNull() | (F.col("_nc") < F.col("cost")))
        merged = m.select(
            "node",
            F.when(better, F.col("_nc")).otherwise(F.col("cost")).alias("cost"),
            F.when(better, F.col("_np")).otherwise(F.col("prev")).alias("prev"),
            better.alias("_new"))
        # materialised every round: the next round's plan starts from files in
        # the shared checkpoint folder, so its size stays constant
        dist = merged.checkpoint(eager=True)
        n_new = dist.where("_new").count()
        if n_new == 0 or (on_round is not None and on_round({"round": i, "improved": n_new}) is False):
            break
    return dist.select("node", "cost", "prev")


def paths_to(dist: DataFrame, targets: DataFrame) -> DataFrame:
    """R2: the nodes on the path to every target, for many targets at once.

    ``dist(node, cost, prev)`` from ``shortest_paths``, ``targets(node)``;
    returns ``(target, node, back)`` with ``back`` steps left to the target
    (0: the target). Targets that were not reached give no rows. Predecessors
    are followed by pointer doubling: ``log2`` of the longest path in rounds,
    each checkpointed."""
    jump = dist.where("prev is not null").select("node", F.col("prev").alias("_j")).checkpoint(eager=True)
    known = targets.select("node").distinct().join(dist.select("node"), "node", "left_semi")
    steps = known.select(F.col("node").alias("target"), "node", F.lit(0).cast("long").alias("back"))
    for r in itertools.count():
        further = steps.join(jump, "node").select("target", F.col("_j").alias("node"), (F.col("back") + (1 << r)).alias("back"))
        steps = steps.unionByName(further).checkpoint(eager=True)
        then = jump.select(F.col("node").alias("_m"), F.col("_j").alias("_n"))
        jump = jump.join(then, F.col("_j") == F.col("_m")).select("node", F.col("_n").alias("_j")).checkpoint(eager=True)
        if jump.isEmpty():
            return steps


def path_to(dist: DataFrame, target) -> list:
    """R2 for one target: its path from the source as a list (one node a step);
    a target that was not reached is a path of its own."""
    one = dist.sparkSession.createDataFrame([(target,)], "node " + dist.schema["node"].dataType.simpleString())
    return [r.node for r in paths_to(dist, one).orderBy(F.desc("back")).collect()] or [target]
