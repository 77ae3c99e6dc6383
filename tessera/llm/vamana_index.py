"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt to shards of about ``shard_rows`` rows by a hash of the id.
In each shard a graph is built by inserting points in batches: a greedy beam
search from the entry point proposes neighbours; relaxed distance pruning goes
through them from the nearest on and drops those that a kept one is ``alpha``
times nearer to than the point itself, so the edges kept are diverse; every
edge is also put in the reverse direction, and lists that grow beyond ``slack``
are pruned again. Queries search every shard by a beam search in blocks, and
the best of all shards are merged.

Nearness is the largest inner product. One more component that makes all
vectors equally long turns it into Euclidean nearness, exactly, for building
and searching; the scores returned are inner products of the original vectors
in double precision.

Equal vectors are one point of a graph with the ``k`` + 1 smallest ids that
have it, found in salted steps; so a vector that a third of the rows have
costs one point and all ties are exact. A query asks for one more neighbour
than wanted, because it may meet itself.

Defined results: null vectors, vectors with null or non-finite components,
zero vectors, null ids and vectors of another length than the most frequent one
take no part, as query or candidate; with ``k`` candidates or fewer all are
returned; rows that repeat an id and a vector count once; a query never returns
its own id; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32
INDEX_SCHEMA = "shard int, n int, dim int, vectors binary, graph binary, entry int, id_counts binary, ids binary"
FOUND_SCHEMA = "qid long, vec_id long, score double"


# ---------------------------------------------------------------- one shard


def beam_search(vectors, graph, entry, queries, beam: int):
    """Beam search of all ``queries`` at once. Returns points and squared
    distances, nearest first (-1: fewer points were reached)."""
    n_q, n = len(queries), len(vectors)
    norms = (vectors * vectors).sum(axis=1)
    ids = np.full((n_q, beam), -1, np.int64)
    dist = np.full((n_q, beam), np.inf, np.float32)
    done = np.ones((n_q, beam), bool)
    visited = np.zeros((n_q, n), bool)
    ids[:, 0] = entry
    dist[:, 0] = norms[entry] - 2 * (queries @ vectors[entry])
    done[:, 0] = False
    visited[:, entry] = True
    live = np.arange(n_q)
    while len(live):
        at = np.argmin(done[live], axis=1)  # the nearest point that isn't expanded
        open_ = ~done[live, at]
        live, at = live[open_], at[open_]
        if not len(live):
            break
        done[live, at] = True
        near = graph[ids[live, at]]
        fresh = (near >= 0) & ~visited[live[:, None], near]
        visited[live[:, None], np.where(fresh, near, entry)] = True
        d = norms[near] - 2 * np.einsum("qrd,qd->qr", vectors[near], queries[live])
        d[~fresh] = np.inf
        all_d = np.concatenate([dist[live], d.astype(np.float32)], axis=1)
        all_i = np.concatenate([ids[live], near], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[live] = np.take_along_axis(all_d, best, 1)
        ids[live] = np.take_along_axis(all_i, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1)
    ids[~np.isfinite(dist)] = -1
    return ids, dist + (queries * queries).sum(axis=1)[:, None]


def robust_prune(vectors, points, candidates, degree: int, alpha: float):
    """At most ``degree`` diverse neighbours of each point from its candidates
    (rows of ids, -1 for none)."""
    out = np.full((len(points), degree), -1, np.int64)
    c = np.sort(candidates, axis=1)
    twice = np.zeros(c.shape, bool)
    twice[:, 1:] = c[:, 1:] == c[:, :-1]
    c[twice | (c == points[:, None])] = -1
    x = vectors[c]
    own = vectors[points]
    d0 = ((x - own[:, None]) ** 2).sum(axis=2)
    d0[c < 0] = np.inf
    order = np.argsort(d0, axis=1, kind="stable")
    c, d0 = np.take_along_axis(c, order, 1), np.take_along_axis(d0, order, 1)
    x = np.take_along_axis(x, order[:, :, None], 1)
    sq = (x * x).sum(axis=2)
    between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    live = np.isfinite(d0)
    rows = np.arange(len(points))
    for k in range(degree):
        pick = np.argmax(live, axis=1)
        some = live[rows, pick]
        if not some.any():
            break
        out[some, k] = c[some, pick[some]]
        live &= ~((alpha * alpha * between[rows, pick] <= d0) & some[:, None])
        live[rows, pick] = False
    return out


def build_graph(vectors, degree: int = 32, slack: int = 48, beam: int = 64, alpha: float = 1.2, batch: int = 512, seed: int = 1):
    """(graph, entry) over ``vectors``: rows of neighbours, -1 for none."""
    n = len(vectors)
    graph = np.full((n, slack), -1, np.int64)
    entry = int(np.argmin(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1)))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    first = order[: min(n, 64)]
    if n > 1:
        graph[first, :degree] = robust_prune(vectors, first, np.broadcast_to(first, (len(first), len(first))).copy(), degree, alpha)
    at = len(first)
    while at < n:
        new = order[at : at + min(at, batch)]
        found, _ = beam_search(vectors, graph, entry, vectors[new], beam)
        graph[new, :degree] = robust_prune(vectors, new, found, degree, alpha)
        back_to = graph[new, :degree].ravel()
        back_from = np.repeat(new, degree)[back_to >= 0]
        back_to = back_to[back_to >= 0]
        o = np.argsort(back_to, kind="stable")
        back_to, back_from = back_to[o], back_from[o]
        heads = np.flatnonzero(np.concatenate([[True], back_to[1:] != back_to[:-1]]))
        nodes, counts = back_to[heads], np.diff(np.append(heads, len(back_to)))
        have = (graph[nodes] >= 0).sum(axis=1)
        fits = have + counts <= slack
        rank = np.arange(len(back_to)) - np.repeat(heads, counts)
        ok = np.repeat(fits, counts)
        graph[back_to[ok], np.repeat(have, counts)[ok] + rank[ok]] = back_from[ok]
        full = np.flatnonzero(~fits)
        for s in range(0, len(full), 256):
            some = full[s : s + 256]
            wide = np.full((len(some), slack + int(counts[some].max())), -1, np.int64)
            wide[:, :slack] = graph[nodes[some]]
            for r, i in enumerate(some):
                wide[r, slack : slack + counts[i]] = back_from[heads[i] : heads[i] + counts[i]]
            graph[nodes[some]] = -1
            graph[nodes[some], :degree] = robust_prune(vectors, nodes[some], wide, degree, alpha)
        at += len(new)
    return graph, entry


def augmented(vectors, largest: float):
    """Vectors with one more component that makes their squared length ``largest``."""
    rest = np.sqrt(np.maximum(largest - (vectors.astype(np.float64) ** 2).sum(axis=1), 0))
    return np.concatenate([vectors, rest[:, None].astype(np.float32)], axis=1)


# ---------------------------------------------------------------- Spark


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.where(F.col(vec_id).isNotNull() & v.isNotNull()).where(finite & F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.cast("array<float>").alias("v"))
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.where(F.size("v") == (dims[0].d if dims else 0))


def points(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): each different vector with its ``keep`` smallest ids, ascending."""
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    salted = Window.partitionBy("v", "_salt").orderBy("vec_id")
    few = rows.distinct().withColumn("_salt", salt).withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= keep)
    whole = Window.partitionBy("v").orderBy("vec_id")
    few = few.withColumn("_r", F.row_number().over(whole)).where(F.col("_r") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _floats(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(flat), -1)


def build_index(reps: DataFrame, largest: float, shards: int, **graph) -> DataFrame:
    """``INDEX_SCHEMA``: a row for each shard of ``reps(v, ids)``."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("first")
        v = _floats(group["v"])
        links, entry = build_graph(augmented(v, largest), **graph)
        ids = group["ids"].combine_chunks()
        counts = np.array([len(x) for x in ids], np.int32)
        row = (
            group["shard"][0].as_py(), len(v), v.shape[1], v.tobytes(), links.astype(np.int32).tobytes(), entry,
            counts.tobytes(), ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
        )
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
        return pa.table([pa.array([x], t) for x, t in zip(row, types)], names=names)

    first = F.col("ids")[0]
    dealt = reps.select(F.pmod(F.xxhash64(first), F.lit(shards)).cast("int").alias("shard"), first.alias("first"), "v", "ids")
    return dealt.groupBy("shard").applyInArrow(run, INDEX_SCHEMA)


def query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """(block, qids, qvectors) rows of ``queries(qid, v)``."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("qid")
        cols = [group["block"][0].as_py(), group["qid"].to_numpy().astype(np.int64).tobytes(), _floats(group["v"]).tobytes()]
        return pa.table([pa.array([x], t) for x, t in zip(cols, (pa.int32(), pa.binary(), pa.binary()))], names=["block", "qids", "qvectors"])

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(run, "block int, qids binary, qvectors binary")


def search_index(index: DataFrame, blocks: DataFrame, largest: float, tasks: int, k: int, beam: int) -> DataFrame:
    """``FOUND_SCHEMA``: the ``k`` nearest ids of every query in every shard.
    Every block of queries meets every shard (a stated query set in blocks)."""

    def one(row) -> pa.RecordBatch:
        n, dim = row["n"].as_py(), row["dim"].as_py()
        v = np.frombuffer(row["vectors"].as_buffer(), np.float32).reshape(n, dim)
        graph = np.frombuffer(row["graph"].as_buffer(), np.int32).reshape(n, -1).astype(np.int64)
        counts = np.frombuffer(row["id_counts"].as_buffer(), np.int32).astype(np.int64)
        ids = np.frombuffer(row["ids"].as_buffer(), np.int64)
        start = np.cumsum(counts) - counts
        qids = np.frombuffer(row["qids"].as_buffer(), np.int64)
        q = np.frombuffer(row["qvectors"].as_buffer(), np.float32).reshape(len(qids), dim)
        x = augmented(v, largest)
        out = [[], [], []]
        for s in range(0, len(qids), 256):
            mine = q[s : s + 256]
            found, _ = beam_search(x, graph, row["entry"].as_py(), np.pad(mine, ((0, 0), (0, 1))), beam)
            exact = np.einsum("qbd,qd->qb", v[found].astype(np.float64), mine.astype(np.float64))
            exact[found < 0] = -np.inf
            r, b = np.nonzero(found >= 0)  # points to ids
            n_ids = counts[found[r, b]]
            pick = np.repeat(start[found[r, b]] - (np.cumsum(n_ids) - n_ids), n_ids) + np.arange(n_ids.sum())
            query, vec, score = np.repeat(r, n_ids), ids[pick], np.repeat(exact[r, b], n_ids)
            order = np.lexsort((vec, -score, query))
            query, vec, score = query[order], vec[order], score[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            for c, x_ in zip(out, (qids[s + query], vec, score)):
                c.append(x_[rank < k])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["qid", "vec_id", "score"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield one({name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)})

    every = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(index.agg(F.max("shard")).first()[0]))))
    pairs = index.join(every, "shard")
    return pairs.repartition(tasks, "shard", "block").mapInArrow(run, FOUND_SCHEMA)


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, *, vec_id: str = "vec_id", vector: str = "embedding",
    shard_rows: int = 4096, block_rows: int = 1024, beam: int = 64, **graph,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for the rows
    where ``is_query`` (a condition on ``vec_id``) holds, among all others."""
    rows = usable(df, vec_id, vector).checkpoint(eager=True)
    reps = points(rows, k + 1).checkpoint(eager=True)
    n = reps.count()
    asked = rows.where(is_query).distinct()
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    largest = float(reps.agg(F.max(length)).first()[0])
    shards = math.ceil(n / shard_rows)
    index = build_index(reps, largest, shards, **graph).checkpoint(eager=True)
    # one search for queries with equal vectors
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")
    different = asked.groupBy("v").agg(F.min("vec_id").alias("qid")).checkpoint(eager=True)
    salted = different.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    members = asked.withColumn("_salt", salt).join(salted, ["v", "_salt"]).select("qid", F.col("vec_id").alias("query_id"))
    # an id with several vectors asks with each; a pair of ids has its best score
    n_queries = different.count()
    if not n_queries:
        return empty
    blocks = math.ceil(n_queries / block_rows)
    found = search_index(index, query_blocks(different.select("qid", "v"), blocks), largest, max(1, math.ceil(blocks * shards / 8), min(blocks * shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))), k + 1, beam)
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    merged = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = members.join(merged, "qid").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    out = out.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20."""
    return nearest(embeddings, F.col("vec_id") % 20 == 0)
