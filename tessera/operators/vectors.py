"""Vector operators: centroids, nearest centroid, exact k nearest neighbours,
k-NN vote (G6, G7, J2, J3, J4, M9, G11, W3).

Exhaustive search is what the reference does (a flat L2 index). Here queries
and base rows are dealt to blocks, inside their topic if there is one, and
each pair of blocks is one task group of fixed size: a matrix product proposes
candidates, exact float64 distances decide, and at most k rows a query leave
the tile; a last top-k merges the tiles. Nothing passes through the driver and
memory doesn't depend on the size of either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: a block has at least ``BLOCK`` rows; there are about ``BLOCKS`` until one of
#: them has ``BLOCK_VALUES`` numbers (16 MB), so that a tile's memory is bounded
#: and rows are copied ``BLOCKS`` times, or once for each full block
BLOCK, BLOCKS, BLOCK_VALUES = 2048, 8, 1 << 21


def centroids(df: DataFrame, key: str, vec: str, out: str = "centroid") -> DataFrame:
    """Mean vector per group (double), a partial aggregate per key."""
    return (
        df.select(key, array_to_vector(F.col(vec)).alias("_v"))
        .groupBy(key)
        .agg(Summarizer.mean(F.col("_v")).alias("_m"))
        .select(key, vector_to_array("_m").alias(out))
    )


def _tile_fn(k: int, exclude_self: bool, names: list[str]):
    """Top-k of one pair of blocks, exact and with ties by base id.

    ``|q|^2 + |b|^2 - 2 q.b`` bounds the k-th distance up to rounding; every
    base row within that bound plus the rounding slack is scored again as
    ``sum((q - b)^2)`` and ordered by (distance, base id)."""
    import numpy as np

    def matrix(column):
        flat = column.combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            q_ids, b_ids = left["_q"].to_numpy(), right["_b"].to_numpy()
            q_all, b = matrix(left["_qv"]), matrix(right["_bv"])
            b_sq = np.einsum("bd,bd->b", b, b)
            step = max(1, 2_000_000 // len(b_ids))
            for s in range(0, len(q_ids), step):
                q, ids = q_all[s:s + step], q_ids[s:s + step]
                q_sq = np.einsum("qd,qd->q", q, q)
                approx = q_sq[:, None] + b_sq[None, :] - 2.0 * (q @ b.T)
                if exclude_self:
                    approx[ids[:, None] == b_ids[None, :]] = np.inf
                m = min(k, len(b_ids))
                bound = np.partition(approx, m - 1, axis=1)[:, m - 1]
                bound = bound + 1e-9 * (q_sq + b_sq.max()) + 1e-12
                r, c = np.nonzero((approx <= bound[:, None]) & np.isfinite(approx))
                exact = np.empty(len(r))
                for a in range(0, len(r), 100_000):
                    d = q[r[a:a + 100_000]] - b[c[a:a + 100_000]]
                    exact[a:a + 100_000] = np.einsum("nd,nd->n", d, d)
                order = np.lexsort((b_ids[c], exact, r))
                r, c, exact = r[order], c[order], exact[order]
                keep = np.arange(len(r)) - np.searchsorted(r, r) < k
                for col, v in zip(out, (ids[r[keep]], b_ids[c[keep]], exact[keep])):
                    col.append(v)
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        cols = [pa.array(np.concatenate(v) if v else e) for v, e in zip(out, empty)]
        if len(names) == 4:  # the topic of the tile
            topic = left["_g"] if left.num_rows else right["_g"]
            cols.append(pa.chunked_array([topic.combine_chunks().take(pa.array(np.zeros(len(cols[0]), np.int64)))]))
        return pa.table(cols, names=names)

    return run


def _sparse_tile_fn(k: int, exclude_self: bool, names: list[str]):
    """The same for vectors as ``struct<indices, values>``: each query gathers
    the base rows of its own indices; distances are rounded to 12 digits, so
    that ties go by base id."""
    import numpy as np

    def entries(column):
        flat = column.combine_chunks()
        lists = [flat.field(f) for f in ("indices", "values")]
        size = np.diff(lists[0].offsets.to_numpy())
        idx, val = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
        at = np.concatenate([[0], np.cumsum(size)])
        return at, idx, val, np.bincount(np.repeat(np.arange(len(size)), size), weights=val * val, minlength=len(size))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            q_ids, b_ids = left["_q"].to_numpy(), right["_b"].to_numpy()
            q_at, q_idx, q_val, q_sq = entries(left["_qv"])
            b_at, b_idx, b_val, b_sq = entries(right["_bv"])
            order = np.argsort(b_idx, kind="stable")
            b_idx, b_val, row = b_idx[order], b_val[order], np.repeat(np.arange(len(b_ids)), np.diff(b_at))[order]
            for i, qid in enumerate(q_ids):
                own = slice(q_at[i], q_at[i + 1])
                lo, hi = (np.searchsorted(b_idx, q_idx[own], side) for side in ("left", "right"))
                n = hi - lo
                at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                dot = np.bincount(row[at], weights=b_val[at] * np.repeat(q_val[own], n), minlength=len(b_ids))
                dist = np.round(np.maximum(q_sq[i] + b_sq - 2 * dot, 0), 12)
                if exclude_self:
                    dist[b_ids == qid] = np.inf
                m = min(k, len(b_ids))
                c = np.flatnonzero((dist <= np.partition(dist, m - 1)[m - 1]) & np.isfinite(dist))
                c = c[np.lexsort((b_ids[c], dist[c]))][:k]
                for col, v in zip(out, (np.full(len(c), qid), b_ids[c], dist[c])):
                    col.append(v)
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        cols = [pa.array(np.concatenate(v) if v else e) for v, e in zip(out, empty)]
        if len(names) == 4:  # the topic of the tile
            topic = left["_g"] if left.num_rows else right["_g"]
            cols.append(pa.chunked_array([topic.combine_chunks().take(pa.array(np.zeros(len(cols[0]), np.int64)))]))
        return pa.table(cols, names=names)

    return run


def nearest_centroid_sparse(df: DataFrame, id_col: str, vec: str, base: DataFrame, key: str) -> DataFrame:
    """``nearest_centroid`` over the mean vectors of ``base(key, vec)`` for
    vectors of entries >= 0 as ``struct<indices, values>``: ``df`` with ``key``.
    Centroids stay a table of (key, index); cosines are rounded to 12 digits, a
    tie (also of a row without common entries) goes to the largest key."""
    known = base.where(F.col(key).isNotNull())
    entry = F.explode(F.arrays_zip(f"{vec}.indices", f"{vec}.values"))
    cents = known.select(key, entry.alias("e")).groupBy(key, F.col("e.indices").alias("_i")).agg(F.sum("e.values").alias("_c"))
    norms = cents.groupBy(key).agg(F.sqrt(F.sum(F.col("_c") * F.col("_c"))).alias("_norm"))
    asked = df.select(id_col, entry.alias("e")).select(id_col, F.col("e.indices").alias("_i"), F.col("e.values").alias("_v"))
    dots = asked.join(cents, "_i").groupBy(id_col, key).agg(F.sum(F.col("_v") * F.col("_c")).alias("_dot")).join(norms, key)
    # the length of the row itself doesn't change the order
    cos = F.round(F.col("_dot") / F.col("_norm"), 12)
    best = dots.where("_dot > 0").groupBy(id_col).agg(F.max_by(key, F.struct(cos, F.col(key))).alias("_best"))
    last = known.agg(F.max(key).alias("_last"))
    out = df.join(best, id_col, "left").crossJoin(F.broadcast(last))
    return out.withColumn(key, F.coalesce("_best", "_last")).drop("_best", "_last")


def block_rows(n: int, width: int | None) -> int:
    """Rows of a block of ``n`` vectors of ``width`` numbers."""
    return max(BLOCK, min(-(-n // BLOCKS), BLOCK_VALUES // max(width or 1, 1)))


def nearest_k(queries: DataFrame, base: DataFrame, k: int, qid: str = "qid", bid: str = "bid",
              vec: str = "vec", exclude_self: bool = False, on: str | None = None,
              block: int | None = None, sparse: bool = False) -> DataFrame:
    """The ``k`` nearest base rows of every query by squared L2,
    ties -> lowest base id. ``queries(qid, vec[, on])``, ``base(bid, vec[, on])``
    with integral ids and vectors of one length. Returns
    ``(qid, [on,] rank, bid, dist)``; fewer than k rows when the base is smaller
    (the reference pads with -1 and reads the last block; we don't). With
    ``on`` only rows of the same topic meet: blocks are dealt inside a topic, so
    a topic's search costs its own queries times its own rows, and a large
    topic is many tiles. Null vectors and null topics take no part.
    ``sparse``: vectors are ``struct<indices, values>`` of any width. ``block``:
    rows of a block (by default as many as ``block_rows`` says)."""
    group = F.col(on) if on else F.lit(0)
    q = queries.where(F.col(vec).isNotNull() & group.isNotNull()).select(
        F.col(qid).cast("long").alias("_q"), F.col(vec).alias("_qv"), group.alias("_g"))
    b = base.where(F.col(vec).isNotNull() & group.isNotNull()).select(
        F.col(bid).cast("long").alias("_b"), F.col(vec).alias("_bv"), group.alias("_g"))
    block = BLOCK if sparse and block is None else block
    n = F.count(F.lit(1))
    if on:  # one row for each topic: how many blocks each side has
        rows = lambda v: F.lit(block) if block else F.greatest(F.lit(BLOCK), F.least(F.ceil(n / BLOCKS), F.floor(F.lit(BLOCK_VALUES) / F.greatest(F.max(F.size(v)), F.lit(1)))))
        sizes = q.groupBy("_g").agg(F.ceil(n / rows("_qv")).alias("_nq")).join(b.groupBy("_g").agg(F.ceil(n / rows("_bv")).alias("_nb")), "_g")
        q, b = q.join(sizes, "_g"), b.join(sizes, "_g")
    else:
        blocks = {}
        for side, x, v in (("_nq", q, "_qv"), ("_nb", b, "_bv")):
            found = x.agg(n.alias("n"), (F.lit(0) if block else F.max(F.size(v))).alias("width")).first()
            blocks[side] = max(1, -(-found.n // (block or block_rows(found.n, found.width))))
        q, b = (x.withColumns({c: F.lit(n).cast("long") for c, n in blocks.items()}) for x in (q, b))
    q = q.select(
        "_q", "_qv", "_g", F.pmod(F.xxhash64("_q"), F.col("_nq")).alias("_i"),
        F.explode(F.expr("sequence(0L, _nb - 1)")).alias("_j"))
    b = b.select(
        "_b", "_bv", "_g", F.pmod(F.xxhash64("_b"), F.col("_nb")).alias("_j"),
        F.explode(F.expr("sequence(0L, _nq - 1)")).alias("_i"))
    tile = ["_g", "_i", "_j"]
    names = ["_q", "_b", "dist"] + (["_g"] if on else [])
    schema = "_q long, _b long, dist double" + (f", _g {q.schema['_g'].dataType.simpleString()}" if on else "")
    found = q.groupBy(*tile).cogroup(b.groupBy(*tile)).applyInArrow((_sparse_tile_fn if sparse else _tile_fn)(k, exclude_self, names), schema)
    w = Window.partitionBy("_q", *(["_g"] if on else [])).orderBy("dist", "_b")
    found = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return found.select(
        F.col("_q").alias(qid), *([F.col("_g").alias(on)] if on else []), "rank", F.col("_b").alias(bid), "dist")


def _bucket_tile_fn(threshold: float):
    """Pairs of one tile of a bucket: closer than ``threshold``, and in no
    common bucket of an earlier table."""
    import numpy as np

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = pa.Table.from_batches(list(batches))
        table, i, j = (x.as_py() for x in (key[0], key[2], key[3]))

        def side(n):
            own = tile.filter(pc.equal(tile["_p"], n)).combine_chunks()
            matrix = lambda c: own[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, -1)
            return (own["id"].to_numpy(), matrix("x").astype(np.float64), matrix("h")) if own.num_rows else None

        left = side(i)
        right = left if i == j else side(j)
        if left is None or right is None:
            return
        (l_ids, lv, lh), (r_ids, rv, rh) = left, right
        r_sq = np.einsum("nd,nd->n", rv, rv)
        rv_t = np.ascontiguousarray(rv.T)
        step = max(1, 2_000_000 // len(r_ids))
        for s in range(0, len(l_ids), step):
            ids, v, h = l_ids[s:s + step], lv[s:s + step], lh[s:s + step]
            l_sq = np.einsum("nd,nd->n", v, v)
            slack = 1e-9 * (l_sq + r_sq.max()) + 1e-12
            approx = l_sq[:, None] + r_sq[None, :] - 2.0 * (v @ rv.T)
            r, c = np.nonzero(approx <= (threshold * threshold + slack)[:, None])
            v_t = np.ascontiguousarray(v.T)
            keep = ids[r] < r_ids[c] if i == j else ids[r] != r_ids[c]
            r, c = r[keep], c[keep]
            for a in range(0, len(r), 100_000):
                rr, cc = r[a:a + 100_000], c[a:a + 100_000]
                same = h[rr] == rh[cc]
                first = same.any(axis=1) & (same.argmax(axis=1) == table)
                rr, cc = rr[first], cc[first]
                dist = np.zeros(len(rr))
                for x, y in zip(v_t, rv_t):  # summed in order, as MLlib does
                    d = x[rr] - y[cc]
                    dist += d * d
                dist = np.sqrt(dist)
                near = dist < threshold
                x, y = ids[rr[near]], r_ids[cc[near]]
                if len(x):
                    yield pa.RecordBatch.from_pydict({"a": np.minimum(x, y), "b": np.maximum(x, y), "dist": dist[near]})

    return run


def bucket_pairs(rows: DataFrame, threshold: float, block: int | None = None) -> DataFrame:
    """J3 approximate: pairs ``(a, b, dist)``, a < b, of ``rows(id, x, h)`` that
    share a bucket (a place of ``h``, one bucket in each table) and are closer
    than ``threshold`` by L2. ``(id, x)`` must be distinct, ids integral.

    A bucket's rows are dealt to blocks, and each pair of blocks is one group,
    so that a bucket may hold most of the rows; a pair that shares several
    buckets is found in the first of them only: no pair leaves a task twice and
    no vector with it."""
    each = rows.select(F.col("id").cast("long").alias("id"), "x", "h", F.posexplode("h").alias("_t", "_h"))
    size = F.count(F.lit(1))
    rows_of = F.lit(block) if block else F.greatest(F.lit(BLOCK), F.least(F.ceil(size / BLOCKS), F.floor(F.lit(BLOCK_VALUES) / F.greatest(F.max(F.size("x")), F.lit(1)))))
    sizes = each.groupBy("_t", "_h").agg(size.alias("_n"), F.ceil(size / rows_of).alias("_nb")).where("_n > 1").drop("_n")
    each = each.join(sizes, ["_t", "_h"]).withColumn("_p", F.pmod(F.xxhash64("id"), F.col("_nb")))
    each = each.withColumn("_o", F.explode(F.expr("sequence(0L, _nb - 1)")))
    each = each.select("id", "x", "h", "_p", "_t", "_h", F.least("_p", "_o").alias("_i"), F.greatest("_p", "_o").alias("_j"))
    return each.groupBy("_t", "_h", "_i", "_j").applyInArrow(_bucket_tile_fn(float(threshold)), "a long, b long, dist double")


def nearest_centroid(df: DataFrame, id_col: str, vec: str, cents: DataFrame, key: str,
                     out: str = "pred", max_centroids: int = 100_000, keep: tuple = ()) -> DataFrame:
    """Cosine distance ``1 - (a/|a|).(c/|c|)`` to every centroid, the
    nearest wins; equal distance -> the later (larger) key, like the
    reference's strict ``<``. Returns ``(id, *keep, out, distance)``: ``keep``
    columns ride along, so no join back to the input is needed.

    The centroid table has one row per class: its count is checked before it
    is broadcast; the rows are streamed through ``mapInPandas`` (numpy, each
    vector normalised once), so no pair table is materialised."""
    import numpy as np
    import pandas as pd

    cp = cents.select(F.col(key).alias("_k"), F.col("centroid")).limit(max_centroids + 1).toPandas().sort_values("_k")
    if len(cp) > max_centroids:
        raise ValueError(f"more than {max_centroids} centroids: beyond the broadcast bound")
    if not len(cp):
        return df.select(F.col(id_col), *keep, F.lit(None).cast(cents.schema[key].dataType).alias(out),
                         F.lit(None).cast("double").alias("distance"))
    keys = cp["_k"].to_numpy()
    cm = np.stack(cp["centroid"].to_numpy()).astype(np.float64) if len(cp) else np.zeros((0, 0))
    norms = np.linalg.norm(cm, axis=1, keepdims=True)
    cm = np.divide(cm, norms, out=np.zeros_like(cm), where=norms > 0)
    bc = df.sparkSession.sparkContext.broadcast((keys, cm))
    key_type = cents.schema[key].dataType.simpleString()
    id_type = df.schema[id_col].dataType.simpleString()

    def run(it):
        ks, c = bc.value
        for pdf in it:
            if len(pdf) == 0:
                continue
            q = np.stack(pdf["_v"].to_numpy()).astype(np.float64)
            qn = np.linalg.norm(q, axis=1, keepdims=True)
            q = np.divide(q, qn, out=np.zeros_like(q), where=qn > 0)
            d = 1.0 - q @ c.T
            # last minimum wins: reverse the columns, argmin, map back
            j = d.shape[1] - 1 - np.argmin(d[:, ::-1], axis=1)
            res = {id_col: pdf["_id"].to_numpy()}
            for k in keep:
                res[k] = pdf[k].to_numpy()
            res[out] = ks[j]
            res["distance"] = d[np.arange(len(j)), j]
            yield pd.DataFrame(res)

    keep_types = "".join(f", {k} {df.schema[k].dataType.simpleString()}" for k in keep)
    df = df.where(F.col(vec).isNotNull())  # a null vector has no nearest centroid
    return df.select(F.col(id_col).alias("_id"), *keep, F.col(vec).alias("_v")).mapInPandas(
        run, f"{id_col} {id_type}{keep_types}, {out} {key_type}, distance double")


def knn_vote(neigh: DataFrame, labels: DataFrame, qid: str, bid: str, label: str,
             out: str = "pred") -> DataFrame:
    """Most frequent label among the neighbours, ties -> lowest label.

    ``neigh(qid, bid)`` is bounded by k rows per query."""
    j = neigh.join(labels.select(F.col(bid), F.col(label).alias("_l")), bid)
    votes = j.groupBy(qid, "_l").agg(F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(qid).agg(
        F.max_by(F.col("_l"), F.struct(F.col("_n"), (-F.col("_l")).alias("nl"))).alias(out))


def knn_votes(neigh: DataFrame, labels: DataFrame, qid: str, bid: str, label: str,
              ks: tuple = (6, 3), prefix: str = "pred_k") -> DataFrame:
    """G11 for several k at once from one neighbour table (ranks 1..max k):
    one count per (query, label) and k, then the vote per k (ties -> lowest
    label). One search, one aggregation."""
    j = neigh.join(labels.select(F.col(bid), F.col(label).alias("_l")), bid)
    votes = j.groupBy(qid, "_l").agg(*[
        F.sum(F.when(F.col("rank") <= k, 1).otherwise(0)).alias(f"_n{k}") for k in ks])
    return votes.groupBy(qid).agg(*[
        F.max_by(F.when(F.col(f"_n{k}") > 0, F.col("_l")),
                 F.struct(F.col(f"_n{k}"), (-F.col("_l")).alias("nl"))).alias(f"{prefix}{k}")
        for k in ks])
