"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key,
and the equivalent DuckDB SQL over the same parquet tables.

Every query reads whole tables (no id subsets, no row caps). Floating results
are rounded to 6 decimals on both sides so that the oracle compares values,
not the last bits of different summation orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as TX
from tessera.functions.activations import clamp
from tessera.operators import metrics, prep, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _positive_zero(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB can round a
    tiny negative to -0.0 where Spark's decimal rounding gives 0.0; adding 0.0
    turns -0.0 into 0.0 and leaves every other value as it is."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("(" + sql[j:j + 6] + _positive_zero(sql[j + 6:k + 1]) + " + 0.0)")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = _positive_zero(sql.strip())
        return fn

    return deco


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c):
    return F.round(c, 6)


# --------------------------------------------------------------------------
# nearest centroid (flagship): G6 centroids, J2 cosine, M9 argmin, G4 accuracy
# --------------------------------------------------------------------------

def _nc_predictions(spark, sf) -> DataFrame:
    emb = T(spark, sf, "embeddings")
    cents = vectors.centroids(emb, "label", "embedding")
    return vectors.nearest_centroid(emb, "vec_id", "embedding", cents, "label", keep=("label",))


_NC_CTE = """
x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
             generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS cl, i, avg(v) AS m FROM x GROUP BY label, i),
qn AS (SELECT vec_id, sqrt(sum(v * v)) AS nq FROM x GROUP BY vec_id),
cn AS (SELECT cl, sqrt(sum(m * m)) AS nc FROM c GROUP BY cl),
d AS (SELECT x.vec_id, c.cl, 1 - sum((x.v / qn.nq) * (c.m / cn.nc)) AS dist
      FROM x JOIN qn USING (vec_id) JOIN c USING (i) JOIN cn USING (cl)
      GROUP BY x.vec_id, c.cl),
r AS (SELECT vec_id, cl, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cl DESC) AS k
      FROM d),
p AS (SELECT e.vec_id, e.label, r.cl AS pred FROM embeddings e JOIN r USING (vec_id)
      WHERE r.k = 1)
"""


@register("nearest_centroid_accuracy", f"""
WITH {_NC_CTE}
SELECT count(*) AS n, CAST(sum(CASE WHEN label = pred THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM p
""")
def q_nearest_centroid_accuracy(spark, sf):
    p = _nc_predictions(spark, sf)
    return metrics.accuracy(p, "label", "pred").select(
        "n", "n_correct", r6(F.col("accuracy")).alias("accuracy"))


@register("classification_report", f"""
WITH {_NC_CTE},
cls AS (SELECT label AS k FROM p UNION SELECT pred FROM p),
s AS (SELECT k,
        CAST(sum(CASE WHEN p.label = k AND p.pred = k THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN p.pred = k THEN 1 ELSE 0 END) AS BIGINT) AS npred,
        CAST(sum(CASE WHEN p.label = k THEN 1 ELSE 0 END) AS BIGINT) AS support
      FROM cls CROSS JOIN p GROUP BY k),
m AS (SELECT k, support,
        CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision,
        CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM s),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                     ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m)
SELECT CAST(k AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM f
UNION ALL
SELECT 'accuracy', NULL, NULL,
       round((SELECT sum(CASE WHEN label = pred THEN 1 ELSE 0 END) FROM p) / (SELECT count(*) FROM p), 6),
       (SELECT count(*) FROM p)
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM f
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM f
""")
def q_classification_report(spark, sf):
    p = _nc_predictions(spark, sf)
    return metrics.classification_report(p, "label", "pred")


# --------------------------------------------------------------------------
# class counts, guards
# --------------------------------------------------------------------------

@register("class_counts", """
SELECT quality, count(*) AS n, (SELECT count(DISTINCT quality) FROM labels) AS n_classes
FROM labels GROUP BY quality
""")
def q_class_counts(spark, sf):
    return prep.class_counts(T(spark, sf, "labels"), "quality")


@register("training_guard", """
SELECT count(*) AS n_rows, count(DISTINCT quality) AS n_classes,
       CASE WHEN count(*) = 0 THEN 'empty' WHEN count(*) < 10 THEN 'too_few_rows'
            WHEN count(DISTINCT quality) < 2 THEN 'one_class' ELSE 'ok' END AS status
FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)
""")
def q_training_guard(spark, sf):
    lab = T(spark, sf, "labels").join(T(spark, sf, "documents").select("doc_id"), "doc_id", "left_semi")
    return prep.training_guard(lab, "quality")


# --------------------------------------------------------------------------
# splits and balancing
# --------------------------------------------------------------------------

@register("stratified_split", """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN row_number() OVER (PARTITION BY o_orderpriority
                                    ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey)
                 <= floor((count(*) OVER (PARTITION BY o_orderpriority) * 20 + 99) / 100)
            THEN 'test' ELSE 'train' END AS split
FROM orders
""")
def q_stratified_split(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return prep.stratified_split(o, "o_orderkey", "o_orderpriority", 20, 42)


@register("random_split", """
SELECT o_orderkey,
       CASE WHEN ('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT * 100
                 < 20 * 4294967296 THEN 'test' ELSE 'train' END AS split
FROM orders
""")
def q_random_split(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey")
    return prep.random_split(o, "o_orderkey", 20, 42)


@register("tail_split", """
SELECT event_id, user_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                 <= floor((count(*) OVER (PARTITION BY user_id) * 80 + 99) / 100)
            THEN 'train' ELSE 'test' END AS split
FROM events
""")
def q_tail_split(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id", "ts")
    return prep.tail_split(e, ["user_id"], ["ts", "event_id"], 20).select(
        "event_id", "user_id", "rn", "split")


@register("oversample_even", """
WITH l AS (SELECT doc_id, quality,
             row_number() OVER (PARTITION BY quality
                                ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
             count(*) OVER (PARTITION BY quality) AS cnt FROM labels),
big AS (SELECT count(*) AS nn FROM labels WHERE quality = 0),
cp AS (SELECT doc_id, quality,
         nn // cnt + CASE WHEN rn <= nn % cnt THEN 1 ELSE 0 END AS copies
       FROM l, big)
SELECT doc_id, quality, CAST(unnest(generate_series(1, copies)) AS BIGINT) AS copy
FROM cp WHERE copies > 0
""")
def q_oversample_even(spark, sf):
    lab = T(spark, sf, "labels").select("doc_id", "quality")
    return prep.oversample_even(lab, "doc_id", "quality", 42)


# --------------------------------------------------------------------------
# standardise, flags, filters, dictionary decode
# --------------------------------------------------------------------------

@register("standardize", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
                  avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp,
                  avg(5.0::DOUBLE) AS mc, stddev_pop(5.0::DOUBLE) AS sc FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round((l_quantity - mq) / CASE WHEN sq = 0 THEN 1.0 ELSE sq END, 6) AS z_qty,
       round((l_extendedprice - mp) / CASE WHEN sp = 0 THEN 1.0 ELSE sp END, 6) AS z_price,
       round((5.0 - mc) / CASE WHEN sc = 0 THEN 1.0 ELSE sc END, 6) AS z_const
FROM lineitem, s
""")
def q_standardize(spark, sf):
    li = T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"), F.lit(5.0).alias("const"))
    cols = ["qty", "price", "const"]
    stats = prep.fit_scaler(li, cols)
    z = prep.apply_scaler(li, stats, cols)
    return z.select("l_orderkey", "l_linenumber", *[r6(F.col(f"z_{c}")).alias(f"z_{c}") for c in cols])


@register("flags_and_clamp", """
SELECT l_orderkey, l_linenumber,
       l_quantity - l_linenumber * 10 AS dist,
       abs(l_quantity - l_linenumber * 10) AS abs_dist,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_return,
       CASE WHEN l_returnflag = 'A' THEN -1 WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS move,
       greatest(0.0, least(30.0, l_quantity)) AS qty_clamped
FROM lineitem
""")
def q_flags_and_clamp(spark, sf):
    li = T(spark, sf, "lineitem").withColumn("_ln10", F.col("l_linenumber") * 10)
    return li.select(
        "l_orderkey", "l_linenumber",
        prep.with_distance("l_quantity", "_ln10", signed=True).alias("dist"),
        prep.with_distance("l_quantity", "_ln10", signed=False).alias("abs_dist"),
        prep.encode_flag(F.col("l_returnflag") == "R").alias("is_return"),
        prep.encode_move(F.col("l_returnflag") == "A", F.col("l_returnflag") == "R").alias("move"),
        clamp("l_quantity", 0.0, 30.0).alias("qty_clamped"),
    )


@register("membership_filter", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def q_membership_filter(spark, sf):
    return T(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice")


@register("decode_class", """
SELECT n.n_nationkey, n.n_name, r.r_name,
       CASE n.n_regionkey WHEN 0 THEN 'Setosa' WHEN 1 THEN 'Versicolor' WHEN 2 THEN 'Virginica' END
         AS iris_class
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_decode_class(spark, sf):
    # a dimension join (Spark broadcasts region only when its measured size
    # is under autoBroadcastJoinThreshold) plus a literal dictionary decode
    n = T(spark, sf, "nation").join(
        T(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    n = prep.decode_class(n, "n_regionkey", IRIS_CLASSES, "iris_class")
    return n.select("n_nationkey", "n_name", "r_name", "iris_class")


# Class id -> iris class name.
IRIS_CLASSES = {0: "Setosa", 1: "Versicolor", 2: "Virginica"}


# --------------------------------------------------------------------------
# costs, running success rate, array matches
# --------------------------------------------------------------------------

@register("cost_functions", """
WITH r AS (
  SELECT l_returnflag,
    (power(l_discount - l_tax, 2) + power(l_tax - (1 - l_discount), 2)) / 2 AS mse,
    -((l_discount * ln(l_tax + 1e-15) + (1 - l_discount) * ln((1 + 1e-15) - l_tax))
      + (l_tax * ln((1 - l_discount) + 1e-15) + (1 - l_tax) * ln((1 + 1e-15) - (1 - l_discount)))) AS ce,
    (CASE WHEN floor(l_discount * 2 + 0.5) <> floor(l_tax * 2 + 0.5) THEN 1 ELSE 0 END
     + CASE WHEN floor(l_tax * 2 + 0.5) <> floor((1 - l_discount) * 2 + 0.5) THEN 1 ELSE 0 END) AS bin
  FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(avg(mse), 6) AS mse, round(avg(ce), 6) AS cross_entropy,
       round(avg(bin), 6) AS binary
FROM r GROUP BY l_returnflag
""")
def q_cost_functions(spark, sf):
    li = T(spark, sf, "lineitem").select(
        "l_returnflag",
        F.array("l_discount", "l_tax").alias("target"),
        F.array(F.col("l_tax"), F.lit(1.0) - F.col("l_discount")).alias("output"))
    ev = metrics.evaluate(li, "target", "output", ["l_returnflag"],
                          {"mse": A.cost_mse, "cross_entropy": A.cost_cross_entropy,
                           "binary": A.cost_binary})
    return ev.select("l_returnflag", "n", *[r6(F.col(c)).alias(c) for c in ("mse", "cross_entropy", "binary")])


@register("running_success_rate", """
WITH t AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS trial,
                  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS flag FROM events),
b AS (SELECT *, CAST(floor(trial / 1000) AS BIGINT) AS block, trial - floor(trial / 1000) * 1000 AS pos
      FROM t)
SELECT event_id, trial, block,
       round(sum(CASE WHEN pos = 0 THEN 0 ELSE flag END)
               OVER (PARTITION BY block ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / (pos + 1), 6) AS success_rate
FROM b
""")
def q_running_success_rate(spark, sf):
    e = T(spark, sf, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("flag"))
    return metrics.block_success_rate(e, ["ts", "event_id"], "flag", 1000).select(
        "event_id", "trial", "block", r6(F.col("success_rate")).alias("success_rate"))


@register("match_flags", """
WITH a AS (SELECT vec_id, label,
             list_transform(embedding, lambda x: x::DOUBLE) AS a,
             list_transform(generate_series(0, 63), lambda k: CASE WHEN k = label THEN 1.0 ELSE 0.0 END) AS b
           FROM embeddings)
SELECT vec_id,
       CAST(CASE WHEN list_max(a) > 0 THEN list_position(a, list_max(a)) - 1 ELSE -1 END AS BIGINT) AS argmax_a,
       CASE WHEN (CASE WHEN list_max(a) > 0 THEN list_position(a, list_max(a)) - 1 ELSE -1 END)
               = (CASE WHEN list_max(b) > 0 THEN list_position(b, list_max(b)) - 1 ELSE -1 END)
            THEN 1 ELSE 0 END AS argmax_match,
       CASE WHEN list_bool_and(list_transform(generate_series(1, 64),
                 lambda i: floor(a[i] + 0.5) = floor(b[i] + 0.5))) THEN 1 ELSE 0 END AS rounded_match
FROM a
""")
def q_match_flags(spark, sf):
    e = T(spark, sf, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: x.cast("double")).alias("a"),
        A.one_hot(F.col("label"), 64).alias("b"))
    return e.select(
        "vec_id", A.argmax("a").alias("argmax_a"),
        F.when(A.argmax_equal("a", "b"), 1).otherwise(0).alias("argmax_match"),
        F.when(A.rounded_equal("a", "b"), 1).otherwise(0).alias("rounded_match"))


# --------------------------------------------------------------------------
# nearest neighbours: k-NN vote, top-k, routed top-k (leave-one-out)
# --------------------------------------------------------------------------

_PAIRS_CTE = """
x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
      FROM embeddings),
pr AS (SELECT a.vec_id AS qid, b.vec_id AS bid, sum((a.v - b.v) * (a.v - b.v)) AS dist
       FROM x a JOIN x b ON a.i = b.i AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id),
rk AS (SELECT qid, bid, dist, row_number() OVER (PARTITION BY qid ORDER BY dist, bid) AS rank FROM pr)
"""


@register("topk_neighbours", f"""
WITH {_PAIRS_CTE}
SELECT qid, CAST(rank AS INTEGER) AS rank, bid, round(dist, 6) AS dist FROM rk WHERE rank <= 3
""")
def q_topk_neighbours(spark, sf):
    e = T(spark, sf, "embeddings").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    b = e.withColumnRenamed("qid", "bid")
    nn = vectors.nearest_k(e, b, 3, exclude_self=True)
    return nn.select("qid", "rank", "bid", r6(F.col("dist")).alias("dist"))


@register("knn_vote", f"""
WITH {_PAIRS_CTE},
lab AS (SELECT vec_id, label FROM embeddings),
v AS (SELECT kk, rk.qid, lab.label AS l, count(*) AS n
      FROM rk JOIN lab ON rk.bid = lab.vec_id, (VALUES (6), (3)) AS t(kk)
      WHERE rk.rank <= kk GROUP BY kk, rk.qid, lab.label),
w AS (SELECT kk, qid, l, row_number() OVER (PARTITION BY kk, qid ORDER BY n DESC, l) AS r FROM v)
SELECT e.vec_id, e.label,
       max(CASE WHEN kk = 6 AND r = 1 THEN l END) AS pred_k6,
       max(CASE WHEN kk = 3 AND r = 1 THEN l END) AS pred_k3
FROM embeddings e JOIN w ON w.qid = e.vec_id GROUP BY e.vec_id, e.label
""")
def q_knn_vote(spark, sf):
    emb = T(spark, sf, "embeddings")
    e = emb.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    b = e.withColumnRenamed("qid", "bid")
    nn = vectors.nearest_k(e, b, 6, exclude_self=True)
    lab = emb.select(F.col("vec_id").alias("bid"), "label")
    votes = vectors.knn_votes(nn, lab, "qid", "bid", "label", ks=(6, 3))
    return emb.select(F.col("vec_id"), "label").join(votes.withColumnRenamed("qid", "vec_id"), "vec_id")


@register("routed_topk", f"""
WITH {_NC_CTE},
x2 AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
       FROM embeddings),
pr AS (SELECT a.vec_id AS qid, pa.pred AS topic, b.vec_id AS bid, sum((a.v - b.v) * (a.v - b.v)) AS dist
       FROM x2 a JOIN p pa ON pa.vec_id = a.vec_id
       JOIN p pb ON pb.pred = pa.pred AND pb.vec_id <> pa.vec_id
       JOIN x2 b ON b.vec_id = pb.vec_id AND b.i = a.i
       GROUP BY a.vec_id, pa.pred, b.vec_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, bid) AS rank FROM pr)
SELECT qid, topic, CAST(rank AS INTEGER) AS rank, bid, round(dist, 6) AS dist FROM rk WHERE rank <= 3
""")
def q_routed_topk(spark, sf):
    # route every vector to its nearest centroid ("topic"), then search only
    # the vectors routed to the same topic (J4: equi-join on topic first)
    emb = T(spark, sf, "embeddings")
    cents = vectors.centroids(emb, "label", "embedding")
    routed = vectors.nearest_centroid(emb, "vec_id", "embedding", cents, "label", out="topic",
                                      keep=("embedding",)).select(
        "vec_id", F.col("embedding").alias("vec"), "topic")
    q = routed.withColumnRenamed("vec_id", "qid")
    b = routed.withColumnRenamed("vec_id", "bid")
    nn = vectors.nearest_k(q, b, 3, exclude_self=True, on="topic")
    return nn.select("qid", "topic", "rank", "bid", r6(F.col("dist")).alias("dist"))


# --------------------------------------------------------------------------
# ordered per-key operators on events: next symbol, every n-th, last writer,
# cool-down, state machine
# --------------------------------------------------------------------------

from tessera.operators import graph, network, sequences, spatial, text, trees  # noqa: E402


def _events(spark, sf):
    return T(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")


@register("next_symbol", """
SELECT event_id, user_id, event_type, next_type FROM (
  SELECT event_id, user_id, event_type,
         lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type,
         lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nid
  FROM events) WHERE nid IS NOT NULL
""")
def q_next_symbol(spark, sf):
    return sequences.next_symbol(_events(spark, sf), ["user_id"], ["ts", "event_id"], "event_type",
                                 "next_type").select("event_id", "user_id", "event_type", "next_type")


@register("every_nth", """
SELECT event_id, user_id, rn FROM (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events) WHERE (rn - 1) % 5 = 0
""")
def q_every_nth(spark, sf):
    return prep.every_nth(_events(spark, sf), ["user_id"], ["ts", "event_id"], 5).select(
        "event_id", "user_id", "rn")


@register("last_writer", """
SELECT user_id, day, event_id, event_type FROM (
  SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r
  FROM events) WHERE r = 1
""")
def q_last_writer(spark, sf):
    e = _events(spark, sf).withColumn("day", F.to_date("ts"))
    return prep.keep_last(e, ["user_id", "day"], ["ts", "event_id"], ["event_id", "event_type"])


@register("throttle", """
WITH RECURSIVE e AS (
  SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
nx AS (SELECT a.user_id, a.rn, min(b.rn) AS j FROM e a LEFT JOIN e b
       ON a.user_id = b.user_id AND b.ts >= a.ts + INTERVAL 86400 SECOND GROUP BY a.user_id, a.rn),
acc(user_id, rn) AS (
  SELECT user_id, rn FROM e WHERE rn = 1
  UNION ALL
  SELECT nx.user_id, nx.j FROM acc JOIN nx ON nx.user_id = acc.user_id AND nx.rn = acc.rn
  WHERE nx.j IS NOT NULL)
SELECT e.event_id, e.user_id, e.ts FROM e JOIN acc USING (user_id, rn)
""")
def q_throttle(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id", "ts")
    return sequences.throttle(e, ["user_id"], "ts", "event_id", 24 * 3600).select(
        "event_id", "user_id", "ts")


# A purchase funnel over event types (state, symbol) -> state.
# Errors keep the current state; anything not listed ends the sequence.
FUNNEL = {
    ("start", "signup"): "member", ("start", "view"): "visitor",
    ("visitor", "view"): "visitor", ("visitor", "signup"): "member",
    ("member", "view"): "browsing", ("browsing", "view"): "browsing",
    ("browsing", "click"): "interested", ("interested", "click"): "interested",
    ("interested", "view"): "browsing", ("interested", "purchase"): "buyer",
    ("buyer", "view"): "browsing", ("buyer", "purchase"): "buyer",
}
for _st in ["start", "visitor", "member", "browsing", "interested", "buyer"]:
    FUNNEL[(_st, "error")] = _st
FUNNEL_ACCEPT = ["buyer"]
_FUNNEL_VALUES = ", ".join(f"('{a}', '{b}', '{c}')" for (a, b), c in FUNNEL.items())


@register("conforms", f"""
WITH RECURSIVE e AS (
  SELECT user_id, event_type AS sym,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
tr(st, sym, nx) AS (VALUES {_FUNNEL_VALUES}),
walk(user_id, rn, st) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), 'start' FROM e
  UNION ALL
  SELECT w.user_id, e.rn, tr.nx FROM walk w
  JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1
  JOIN tr ON tr.st = w.st AND tr.sym = e.sym),
n AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id),
s AS (SELECT user_id, max(rn) AS steps, arg_max(st, rn) AS st FROM walk GROUP BY user_id)
SELECT n.user_id, n.n, CAST(s.steps AS BIGINT) AS steps_ok,
       CASE WHEN s.steps = n.n THEN s.st END AS final_state,
       s.steps = n.n AS prefix_ok, (s.steps = n.n AND s.st = 'buyer') AS complete_ok
FROM n JOIN s USING (user_id)
""")
def q_conforms(spark, sf):
    e = _events(spark, sf)
    return sequences.conforms(e, ["user_id"], ["ts", "event_id"], "event_type", FUNNEL, "start",
                              accept=FUNNEL_ACCEPT)


# --------------------------------------------------------------------------
# trees: best split, node statistics
# --------------------------------------------------------------------------

@register("best_split", """
WITH g AS (SELECT l_quantity::DOUBLE AS v, count(*) AS n,
                  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS BIGINT) AS c0,
                  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS c1
           FROM lineitem GROUP BY 1),
c AS (SELECT v, lead(v) OVER (ORDER BY v) AS vn,
             CAST(sum(n) OVER w AS BIGINT) AS ln, CAST(sum(c0) OVER w AS BIGINT) AS l0,
             CAST(sum(c1) OVER w AS BIGINT) AS l1
      FROM g WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT CAST(sum(n) AS BIGINT) AS nn, CAST(sum(c0) AS BIGINT) AS t0,
             CAST(sum(c1) AS BIGINT) AS t1 FROM g),
s AS (SELECT (v + vn) / 2 AS threshold, ln, nn - ln AS rr, l0, l1, t0 - l0 AS r0, t1 - l1 AS r1, nn
      FROM c, t WHERE vn IS NOT NULL),
i AS (SELECT *, (ln * (1.0 - ((l0 / ln) * (l0 / ln) + (l1 / ln) * (l1 / ln)))
                 + rr * (1.0 - ((r0 / rr) * (r0 / rr) + (r1 / rr) * (r1 / rr)))) / nn AS imp FROM s)
SELECT 'l_quantity' AS feature, threshold, round(imp, 6) AS impurity, ln AS n_left, rr AS n_right
FROM i ORDER BY imp, threshold LIMIT 1
""")
def q_best_split(spark, sf):
    li = T(spark, sf, "lineitem").select(
        "l_quantity", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_r"))
    b = trees.best_split(li, "l_quantity", "is_r")
    return b.select("feature", "threshold", r6(F.col("impurity")).alias("impurity"), "n_left", "n_right")


@register("node_stats", """
WITH g AS (SELECT CAST(floor(l_extendedprice / 10000) AS BIGINT) AS node, count(*) AS samples,
                  CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS c0,
                  CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS c1,
                  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS c2
           FROM lineitem GROUP BY 1)
SELECT node, samples, [c0, c1, c2] AS value,
       round(1.0 - ((c0 / samples) * (c0 / samples) + (c1 / samples) * (c1 / samples)
                    + (c2 / samples) * (c2 / samples)), 6) AS gini,
       CASE WHEN c0 >= c1 AND c0 >= c2 THEN 'A' WHEN c1 >= c2 THEN 'N' ELSE 'R' END AS class
FROM g
""")
def q_node_stats(spark, sf):
    li = T(spark, sf, "lineitem").select(
        F.floor(F.col("l_extendedprice") / 10000).alias("node"), "l_returnflag")
    s = trees.node_stats(li, "node", "l_returnflag")
    return s.select("node", "samples", "value", r6(F.col("gini")).alias("gini"), "class")


# --------------------------------------------------------------------------
# text: blocks, question keys, unanswered questions
# --------------------------------------------------------------------------

_WS = TX.WS_SQL
_KEY_SQL = (f"regexp_replace(lower(trim(text, {_WS})), "
            r"'[^\p{L}\p{N}_]+', ' ', 'g')")


@register("text_blocks", f"""
SELECT doc_id, CAST(generate_subscripts(l, 1) AS INTEGER) AS block_id, unnest(l) AS text
FROM (SELECT doc_id,
             list_filter(list_transform(string_split_regex(text, '\\n+'),
                                        lambda x: trim(x, {_WS})),
                         lambda x: x <> '') AS l
      FROM documents)
""")
def q_text_blocks(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text")
    return text.text_blocks(d, "doc_id", "text", r"\n+")


@register("clean_questions", f"""
SELECT conv_id, turn, {_KEY_SQL} AS key FROM conversations WHERE role = 'user'
""")
def q_clean_questions(spark, sf):
    c = T(spark, sf, "conversations").where(F.col("role") == "user")
    return text.question_keys(c).select("conv_id", "turn", "key")


@register("unanswered", f"""
WITH q AS (SELECT conv_id, turn, {_KEY_SQL} AS key FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn FROM conversations
      WHERE role = 'assistant' AND length(trim(text, {_WS})) >= 20),
cache AS (SELECT DISTINCT q.key FROM q JOIN a USING (conv_id, turn))
SELECT key, count(*) AS n_asked FROM q
WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE c.key = q.key) GROUP BY key
""")
def q_unanswered(spark, sf):
    conv = T(spark, sf, "conversations")
    cache = text.answer_cache(conv)
    q = text.question_keys(conv.where(F.col("role") == "user"))
    return text.unanswered(q, cache).groupBy("key").agg(F.count(F.lit(1)).alias("n_asked"))


# --------------------------------------------------------------------------
# grid graph from part (row = size, column = brand number; missing = wall)
# --------------------------------------------------------------------------

def _part_cells(spark, sf):
    return T(spark, sf, "part").select(
        F.col("p_size").alias("r"), F.expr("CAST(substring(p_brand, 7) AS INT)").alias("c")).distinct()


_CELLS_SQL = "SELECT DISTINCT p_size AS r, CAST(substr(p_brand, 7) AS INTEGER) AS c FROM part"
_OFFSETS_SQL = ", ".join(f"({a}, {b}, {w})" for a, b, w in graph.NEIGHBOURS)


@register("grid_edges", f"""
WITH c AS ({_CELLS_SQL}), o(dr, dc, w) AS (VALUES {_OFFSETS_SQL})
SELECT c.r AS src_r, c.c AS src_c, c.r + o.dr AS dst_r, c.c + o.dc AS dst_c, o.w
FROM c, o WHERE EXISTS (SELECT 1 FROM c c2 WHERE c2.r = c.r + o.dr AND c2.c = c.c + o.dc)
""")
def q_grid_edges(spark, sf):
    return graph.grid_edges(_part_cells(spark, sf)).select("src_r", "src_c", "dst_r", "dst_c", "w")


@register("shortest_paths", f"""
WITH RECURSIVE c AS ({_CELLS_SQL}), o(dr, dc, w) AS (VALUES {_OFFSETS_SQL}),
e AS (SELECT c.r * 1000 + c.c AS src, (c.r + o.dr) * 1000 + (c.c + o.dc) AS dst, o.w
      FROM c, o WHERE EXISTS (SELECT 1 FROM c c2 WHERE c2.r = c.r + o.dr AND c2.c = c.c + o.dc)),
s AS (SELECT r * 1000 + c AS node FROM c ORDER BY r, c LIMIT 1),
d(node, cost) USING KEY (node) AS (
  SELECT node, CAST(0 AS BIGINT) FROM s
  UNION
  (SELECT e.dst, min(d.cost + e.w) FROM d JOIN e ON e.src = d.node
   LEFT JOIN recurring.d r ON r.node = e.dst
   GROUP BY e.dst HAVING min(d.cost + e.w) < coalesce(min(r.cost), 9223372036854775807)))
SELECT CAST(node // 1000 AS INTEGER) AS r, CAST(node % 1000 AS INTEGER) AS c, CAST(cost AS BIGINT) AS cost
FROM d
""")
def q_shortest_paths(spark, sf):
    d = _part_paths(spark, sf)[1]
    return d.select((F.floor(F.col("node") / 1000)).cast("int").alias("r"),
                    (F.col("node") % 1000).cast("int").alias("c"), F.col("cost").cast("bigint").alias("cost"))


def _part_paths(spark, sf):
    cells = _part_cells(spark, sf)
    e = graph.grid_edges(cells).select(
        (F.col("src_r") * 1000 + F.col("src_c")).alias("src"),
        (F.col("dst_r") * 1000 + F.col("dst_c")).alias("dst"), "w")
    src = cells.agg(F.min(F.struct("r", "c")).alias("m")).select(
        (F.col("m.r") * 1000 + F.col("m.c")).alias("node"))
    return e, graph.shortest_paths(e, src)


@register("path_costs", SQL["shortest_paths"])
def q_path_costs(spark, sf):
    """R2: every reached cell's path, walked back and its steps' costs added."""
    e, d = _part_paths(spark, sf)
    steps = graph.paths_to(d, d.select("node"))
    to = steps.select("target", F.col("node").alias("dst"), (F.col("back") + 1).alias("back"))
    links = steps.join(to, ["target", "back"], "left").join(
        e, (F.col("node") == F.col("src")) & (to["dst"] == e["dst"]), "left")
    total = links.groupBy("target").agg(F.sum(F.coalesce("w", F.lit(0))).alias("cost"))
    return total.select(F.floor(F.col("target") / 1000).cast("int").alias("r"),
                        (F.col("target") % 1000).cast("int").alias("c"), F.col("cost").cast("bigint").alias("cost"))


# --------------------------------------------------------------------------
# rectangles from part; points from lineitem
# --------------------------------------------------------------------------

def _part_rects(spark, sf):
    return T(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") * 10).cast("double").alias("x"),
        F.floor("p_retailprice").cast("double").alias("y"), F.lit(15.0).alias("w"),
        (F.length("p_type") * 4).cast("double").alias("h"))


_RECTS_SQL = ("SELECT p_partkey AS id, CAST(p_size * 10 AS DOUBLE) AS x, CAST(floor(p_retailprice) AS DOUBLE) AS y, "
              "15.0::DOUBLE AS w, CAST(length(p_type) * 4 AS DOUBLE) AS h FROM part")


@register("rect_overlap", f"""
WITH r AS ({_RECTS_SQL})
SELECT a.id AS a_id, b.id AS b_id FROM r a JOIN r b ON a.id < b.id
 AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h
""")
def q_rect_overlap(spark, sf):
    return spatial.rect_overlap(_part_rects(spark, sf), cell=32.0)


@register("point_in_rect", f"""
WITH r AS ({_RECTS_SQL}),
p AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity * 10 AS px, 900 + l_discount * 10000 AS py
      FROM lineitem)
SELECT r.id AS rid, count(*) AS n_points FROM p JOIN r
  ON r.x <= p.px AND p.px < r.x + r.w AND r.y <= p.py AND p.py < r.y + r.h
GROUP BY r.id
""")
def q_point_in_rect(spark, sf):
    li = T(spark, sf, "lineitem").select(
        (F.col("l_quantity") * 10).alias("px"), (F.lit(900) + F.col("l_discount") * 10000).alias("py"))
    return spatial.count_points_in_rect(li, _part_rects(spark, sf), cell=32.0)


# --------------------------------------------------------------------------
# CSV round trip (S1, S2), network scoring (M11), layer edges
# --------------------------------------------------------------------------

@register("csv_roundtrip", """
SELECT * FROM orders
""")
def q_csv_roundtrip(spark, sf):
    from tessera.sources import tables

    o = T(spark, sf, "orders")
    path = tables.scratch_path(spark, "csv_roundtrip")
    tables.write_table_csv(o, path)
    return tables.read_table_csv(spark, path, schema=o.schema)


# A 3-3-1 logistic network used as a scoring model.
NET_LAYERS = [
    {"weights": [[0.8, -1.2, 0.5], [-0.4, 0.9, 1.1], [1.5, 0.3, -0.7]],
     "bias": [0.1, -0.2, 0.05], "squash": "LOGISTIC"},
    {"weights": [[1.2, -0.8, 0.6]], "bias": [-0.3], "squash": "LOGISTIC"},
]
_NET_INPUTS_SQL = ["(l_quantity / 50)", "(l_discount * 10)", "(l_tax * 10)"]


def _network_sql(inputs: list[str], layers: list[dict]) -> str:
    acts = inputs
    for layer in layers:
        nxt = []
        for row, b in zip(layer["weights"], layer["bias"]):
            z = f"CAST({float(b)!r} AS DOUBLE)"
            for w, a in zip(row, acts):
                z = f"({z} + CAST({float(w)!r} AS DOUBLE) * {a})"
            nxt.append(f"(1.0 / (1.0 + exp(-{z})))")
        acts = nxt
    return acts[0]


@register("network_score", f"""
SELECT l_orderkey, l_linenumber, round({_network_sql(_NET_INPUTS_SQL, NET_LAYERS)}, 6) AS score
FROM lineitem
""")
def q_network_score(spark, sf):
    li = T(spark, sf, "lineitem")
    ins = [F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10]
    s = network.score_network(li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"),
                              ins, NET_LAYERS)
    return s.select("l_orderkey", "l_linenumber", r6(F.col("out0")).alias("score"))


def _layers(spark, sf):
    a = T(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_regionkey").alias("pos"))
    b = T(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_nationkey").alias("pos"))
    return a, b


_LAYER_EDGES_SQL = """
SELECT 'all_to_all' AS rule, r.r_regionkey AS "from", n.n_nationkey AS "to" FROM region r, nation n
UNION ALL
SELECT 'one_to_one', r.r_regionkey, n.n_nationkey FROM region r JOIN nation n ON r.r_regionkey = n.n_nationkey
UNION ALL
SELECT 'all_to_else', r.r_regionkey, n.n_nationkey FROM region r, nation n WHERE r.r_regionkey <> n.n_nationkey
"""


@register("layer_edges", _LAYER_EDGES_SQL)
def q_layer_edges(spark, sf):
    a, b = _layers(spark, sf)
    parts = [network.layer_edges(a, b, rule).select(F.lit(rule).alias("rule"), "from", "to")
             for rule in ("all_to_all", "one_to_one", "all_to_else")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("link_type", f"""
WITH e AS ({_LAYER_EDGES_SQL}),
s AS (SELECT rule, count(*) AS n_edges,
             CAST(sum(CASE WHEN "from" = "to" THEN 1 ELSE 0 END) AS BIGINT) AS n_same_pos
      FROM e GROUP BY rule),
z AS (SELECT (SELECT count(*) FROM region) AS n_a, (SELECT count(*) FROM nation) AS n_b)
SELECT rule, n_edges, n_same_pos, n_a, n_b,
       CASE WHEN n_edges = n_a * n_b THEN 'all_to_all'
            WHEN n_edges = n_a AND n_same_pos = n_a THEN 'one_to_one' ELSE 'other' END AS link
FROM s, z
""")
def q_link_type(spark, sf):
    a, b = _layers(spark, sf)
    out = None
    for rule in ("all_to_all", "one_to_one", "all_to_else"):
        lt = network.link_type(network.layer_edges(a, b, rule), a, b).select(F.lit(rule).alias("rule"), "*")
        out = lt if out is None else out.unionByName(lt)
    return out


# --------------------------------------------------------------------------
# Spark ML plans (rows-only checks: fitted models are compared by bounds in
# the tests, not by value)
# --------------------------------------------------------------------------

from tessera.plans import models  # noqa: E402
from tessera.sources.tables import scratch_path  # noqa: E402

DOC_FEATURES = ["n_chars", "n_words", "n_lines"]


def _doc_features(spark, sf):
    d = T(spark, sf, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.col("text"), r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(F.col("text"), "\n")).cast("double").alias("n_lines"))
    lab = T(spark, sf, "labels")
    return d.join(lab, "doc_id")


def _split_docs(spark, sf):
    # narrow rows, kept: the split reads them twice, and texts are cut into words once
    f = _doc_features(spark, sf).checkpoint(eager=True)
    s = prep.stratified_split(f, "doc_id", "quality", 20, 42)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


_TRAIN_SQL = """
WITH f AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x0,
                  CAST(len(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+')) AS DOUBLE) AS x1,
                  CAST(len(string_split(text, chr(10))) AS DOUBLE) AS x2, quality, toxic
           FROM documents JOIN labels USING (doc_id)),
s AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id)
                  <= floor((count(*) OVER (PARTITION BY quality) * 20 + 99) / 100) AS is_test FROM f)
"""


def _tree_sql(p: str, label: str, depth: int, n_features: int = 3) -> str:
    """CTEs of an exact tree, level by level: ``{p}nodes(id, depth, f, t)`` and
    ``{p}counts(node, k, n)``."""
    xs = ", ".join(f"x{i}" for i in range(n_features))
    out = [f"{p}r0 AS (SELECT CAST(1 AS BIGINT) AS node, {xs}, {label} AS k FROM s WHERE NOT is_test AND {label} IS NOT NULL)"]
    for d in range(depth):
        melted = " UNION ALL ".join(f"SELECT node, {i} AS f, x{i} AS v, k FROM {p}r{d}" for i in range(n_features))
        value = "CASE b.f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(n_features)) + " END"
        out.append(f"""{p}b{d} AS MATERIALIZED (
  WITH c AS (SELECT node, f, v, k, count(*) AS n FROM ({melted})
             WHERE node IN (SELECT node FROM {p}r{d} GROUP BY node HAVING count(DISTINCT k) > 1) GROUP BY ALL),
  u AS (SELECT *, CAST(sum(n) OVER (PARTITION BY node, f, k ORDER BY v) AS HUGEINT) AS run,
               CAST(sum(n) OVER (PARTITION BY node, f, k) AS HUGEINT) AS tot FROM c),
  m AS (SELECT node, f, v, sum(n) AS n, sum(run * run - (run - n) * (run - n)) AS l,
               sum((tot - run + n) * (tot - run + n) - (tot - run) * (tot - run)) AS r FROM u GROUP BY ALL),
  w AS (SELECT node, f, v, lead(v) OVER z AS v_next, CAST(sum(n) OVER z AS DOUBLE) AS nl,
               CAST(sum(n) OVER y AS DOUBLE) - CAST(sum(n) OVER z AS DOUBLE) AS nr, CAST(sum(l) OVER z AS DOUBLE) AS sl,
               CAST(sum(r) OVER y - sum(r) OVER z AS DOUBLE) AS sr
        FROM m WINDOW z AS (PARTITION BY node, f ORDER BY v), y AS (PARTITION BY node, f)),
  g AS (SELECT node, f, (v + v_next) / 2 AS t, (nl * (1.0 - sl / (nl * nl)) + nr * (1.0 - sr / (nr * nr))) / (nl + nr) AS impurity
        FROM w WHERE v_next IS NOT NULL)
  SELECT node, f, t FROM g QUALIFY row_number() OVER (PARTITION BY node ORDER BY impurity, f, t) = 1)""")
        out.append(f"""{p}r{d + 1} AS MATERIALIZED (
  SELECT 2 * r.node + CASE WHEN {value} <= b.t THEN 0 ELSE 1 END AS node, {xs.replace("x", "r.x")}, k FROM {p}r{d} r JOIN {p}b{d} b ON r.node = b.node)""")
    every = " UNION ALL ".join(f"SELECT node, k, count(*) AS n FROM {p}r{d} GROUP BY ALL" for d in range(depth + 1))
    splits = " UNION ALL ".join(f"SELECT node, f, t FROM {p}b{d}" for d in range(depth))
    return ",\n".join([*out, f"{p}counts AS MATERIALIZED ({every})", f"{p}splits AS MATERIALIZED ({splits})"])


_FIT_TREE_SQL = _TRAIN_SQL + ",\n" + _tree_sql("a", "quality", 5) + """,
k AS (SELECT DISTINCT k FROM acounts),
g AS (SELECT n.node, k.k, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT node FROM acounts) n CROSS JOIN k
      LEFT JOIN acounts c ON c.node = n.node AND c.k = k.k),
h AS (SELECT node, list(CAST(n AS BIGINT) ORDER BY k) AS value, CAST(sum(n) AS BIGINT) AS samples, arg_min(k, (-n, k)) AS class FROM g GROUP BY node)
SELECT h.node AS id, CASE f WHEN 0 THEN 'n_chars' WHEN 1 THEN 'n_words' WHEN 2 THEN 'n_lines' END AS feature, round(t, 6) AS threshold,
       round(1.0 - list_sum(list_transform(value, lambda c: (c / samples) * (c / samples))), 6) AS gini, samples, value,
       CAST(class AS VARCHAR) AS class, CASE WHEN f IS NULL THEN -1 ELSE 2 * h.node END AS left, CASE WHEN f IS NULL THEN -1 ELSE 2 * h.node + 1 END AS right
FROM h LEFT JOIN asplits USING (node)
"""


def _walk_sql(p: str, depth: int, n_features: int = 3) -> str:
    """CTE ``{p}leaf(doc_id, class)``: the test rows' leaves."""
    value = "CASE f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(n_features)) + " END"
    xs = ", ".join(f"x{i}" for i in range(n_features))
    out = [f"{p}w0 AS (SELECT doc_id, CAST(1 AS BIGINT) AS node, {xs} FROM s WHERE is_test)"]
    for d in range(depth):
        out.append(f"""{p}w{d + 1} AS MATERIALIZED (SELECT doc_id, CASE WHEN f IS NULL THEN w.node WHEN {value} <= t THEN 2 * w.node ELSE 2 * w.node + 1 END AS node, {xs}
  FROM {p}w{d} w LEFT JOIN {p}splits b ON b.node = w.node)""")
    out.append(f"""{p}leaf AS (SELECT doc_id, class FROM {p}w{depth} w
  JOIN (SELECT node, arg_min(k, (-n, k)) AS class FROM {p}counts GROUP BY node) c ON c.node = w.node)""")
    return ",\n".join(out)


_MULTI_TREE_SQL = _TRAIN_SQL + ",\n" + ",\n".join(
    [_tree_sql("a", "quality", 5), _tree_sql("b", "toxic", 5), _walk_sql("a", 5), _walk_sql("b", 5)]) + """
SELECT s.doc_id, quality, toxic, a.class AS pred_quality, b.class AS pred_toxic
FROM s JOIN aleaf a USING (doc_id) JOIN bleaf b USING (doc_id) WHERE is_test
"""


@register("fit_tree", _FIT_TREE_SQL)
def q_fit_tree(spark, sf):
    train, _ = _split_docs(spark, sf)
    nodes = models.tree_table(models.fit_tree(train, DOC_FEATURES, "quality", max_depth=5))
    return nodes.withColumns({"threshold": r6(F.col("threshold")), "gini": r6(F.col("gini"))})


@register("multi_tree", _MULTI_TREE_SQL)
def q_multi_tree(spark, sf):
    train, test = _split_docs(spark, sf)
    ms = models.fit_multi_tree(train, DOC_FEATURES, ["quality", "toxic"], max_depth=5)
    return models.score_multi(test, ms, ["doc_id", "quality", "toxic"])


@register("fit_mlp")
def q_fit_mlp(spark, sf):
    train, test = _split_docs(spark, sf)
    m = models.fit_mlp(train, DOC_FEATURES, "quality", hidden=(16, 8), max_iter=500)
    return metrics.accuracy(m.transform(test), "quality", "pred_quality")


@register("compare_models")
def q_compare_models(spark, sf):
    train, test = _split_docs(spark, sf)
    ms = {"tree": models.fit_tree(train, DOC_FEATURES, "quality"),
          "knn": models.KnnModel(train, DOC_FEATURES, "quality", "doc_id"),
          "mlp": models.fit_mlp(train, DOC_FEATURES, "quality", hidden=(8, 4), max_iter=500)}
    return models.compare_models(test, ms, "quality")


@register("pca_nearest")
def q_pca_nearest(spark, sf):
    emb = T(spark, sf, "embeddings")
    pca = models.fit_pca(emb, "embedding", 8)
    pc = models.project_pca(pca, emb, "embedding")
    q = pc.select(F.col("vec_id").alias("qid"), F.col("pc").alias("vec"))
    nn = vectors.nearest_k(q, q.withColumnRenamed("qid", "bid"), 1, exclude_self=True)
    lab = emb.select("vec_id", "label")
    return (nn.join(lab.withColumnRenamed("vec_id", "qid"), "qid")
            .join(lab.select(F.col("vec_id").alias("bid"), F.col("label").alias("nn_label")), "bid")
            .select("qid", "bid", "label", "nn_label", r6(F.col("dist")).alias("dist")))


@register("lsh_neighbours")
def q_lsh_neighbours(spark, sf):
    emb = T(spark, sf, "embeddings")
    return models.lsh_pairs(emb, "vec_id", "embedding", threshold=1.2, bucket_length=1.0)


@register("vectorize_text")
def q_vectorize_text(spark, sf):
    # dealt once: a file may be one part, and both the fit and the scoring cut texts into words
    d = T(spark, sf, "documents").select("doc_id", "text").repartition("doc_id").checkpoint(eager=True)
    m = models.fit_text_vectors(d, "text", 1 << 16)
    return m.transform(d).select("doc_id", F.size(F.array_distinct("_tok")).alias("n_terms"), "vector")


@register("text_weights", r"""
WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term <> '' GROUP BY doc_id, term),
d AS (SELECT term, count(*) AS df FROM f GROUP BY term),
w AS (SELECT doc_id, term, tf, tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) AS w
      FROM f JOIN d USING (term)),
l AS (SELECT doc_id, sqrt(sum(w * w)) AS len FROM w GROUP BY doc_id)
SELECT doc_id, term, tf, round(CASE WHEN len > 0 THEN w / len ELSE 0.0 END, 6) AS weight FROM w JOIN l USING (doc_id)
""")
def q_text_weights(spark, sf):
    w = models.term_weights(T(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    return w.select("doc_id", "term", "tf", r6(F.col("weight")).alias("weight"))


_PROMPT_SQL = TX.PROMPT_TEMPLATE.replace("'", "''").replace("\n", "' || chr(10) || '").replace("%s", "' || coalesce({}, '') || '")


@register("prompt_table", f"""
WITH p AS (SELECT doc_id, lang AS topic, list_filter(list_transform(string_split_regex(text, '\\n+'), lambda x: trim(x, {_WS})), lambda x: x <> '') AS l
           FROM documents WHERE lang IS NOT NULL),
b AS MATERIALIZED (SELECT doc_id, topic, generate_subscripts(l, 1) AS block_id, unnest(l) AS text FROM p),
n AS (SELECT count(*) + 1.0 AS n FROM b),
tf AS (SELECT doc_id, block_id, topic, term, count(*) AS tf
       FROM (SELECT doc_id, block_id, topic, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM b)
       WHERE term <> '' GROUP BY ALL),
idf AS MATERIALIZED (SELECT term, ln((SELECT n FROM n) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term),
raw AS (SELECT *, tf * idf AS w FROM tf JOIN idf USING (term)),
w AS MATERIALIZED (SELECT doc_id, block_id, topic, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, block_id)) AS w FROM raw WHERE w > 0),
c0 AS (SELECT topic, term, sum(w) AS w FROM w GROUP BY ALL),
c AS (SELECT topic, term, w / sqrt(sum(w * w) OVER (PARTITION BY topic)) AS w FROM c0),
q0 AS (SELECT conv_id, turn, text, {_KEY_SQL} AS key FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn FROM conversations WHERE role = 'assistant' AND length(trim(text, {_WS})) >= 20),
q AS MATERIALIZED (SELECT * FROM q0 WHERE key NOT IN (SELECT q1.key FROM q0 q1 JOIN a USING (conv_id, turn))),
qt AS (SELECT conv_id, turn, term, count(*) AS tf
       FROM (SELECT conv_id, turn, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM q) WHERE term <> '' GROUP BY ALL),
qr AS (SELECT conv_id, turn, term, tf * idf AS w FROM qt JOIN idf USING (term)),
qw AS MATERIALIZED (SELECT conv_id, turn, term, w / l AS w FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY conv_id, turn)) AS l FROM qr) WHERE l > 0),
r AS (SELECT conv_id, turn, topic, round(sum(qw.w * c.w), 12) AS s FROM qw JOIN c USING (term) GROUP BY ALL),
t AS MATERIALIZED (SELECT q.conv_id, q.turn, coalesce(z.topic, (SELECT max(topic) FROM w)) AS topic FROM q
      LEFT JOIN (SELECT conv_id, turn, arg_max(topic, (s, topic)) AS topic FROM r WHERE s > 0 GROUP BY ALL) z USING (conv_id, turn)),
s0 AS (SELECT t.conv_id, t.turn, t.topic, w.doc_id, w.block_id, round(sum(qw.w * w.w), 9) AS s
       FROM t JOIN qw USING (conv_id, turn) JOIN w ON w.topic = t.topic AND w.term = qw.term GROUP BY ALL),
low AS (SELECT topic, doc_id, block_id FROM (SELECT DISTINCT topic, doc_id, block_id FROM tf)
        QUALIFY row_number() OVER (PARTITION BY topic ORDER BY doc_id, block_id) <= 3),
s AS (SELECT conv_id, turn, topic, doc_id, block_id, max(s) AS s FROM
      (SELECT * FROM s0 UNION ALL SELECT conv_id, turn, t.topic, doc_id, block_id, 0.0 FROM t JOIN low USING (topic)) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY s DESC, doc_id, block_id) AS rank FROM s QUALIFY rank <= 3),
x AS (SELECT conv_id, turn, k.topic, string_agg(trim(b.text, {_WS}), chr(10) ORDER BY rank) AS context
      FROM k JOIN b USING (doc_id, block_id) GROUP BY ALL)
SELECT q.conv_id, q.turn, q.key, x.topic, x.context,
       CASE WHEN length(trim(coalesce(context, ''), {_WS})) >= 20 THEN '{_PROMPT_SQL.format("context", "text")}' END AS prompt,
       CASE WHEN length(trim(coalesce(context, ''), {_WS})) >= 20 THEN 'ready' ELSE '{TX.NOT_ENOUGH_CONTEXT}' END AS status,
       CASE WHEN length(trim(coalesce(context, ''), {_WS})) >= 20 THEN 2 END AS n_messages
FROM q LEFT JOIN x USING (conv_id, turn)
""")
def q_prompt_table(spark, sf):
    """Unanswered user questions -> routed top-3 paragraphs -> prompt."""
    from tessera.plans import retrieval

    conv = T(spark, sf, "conversations")
    docs = T(spark, sf, "documents").where("lang is not null").select("doc_id", "lang", "text").repartition("doc_id")
    blocks = text.text_blocks(docs, "doc_id", "text", r"\n+", keep=("lang",))
    # the paragraph table is read by the index build and for the contexts: stored once
    blocks = blocks.select(retrieval.block_key("doc_id", "block_id").alias("bid"),
                           F.col("lang").alias("topic"), "text").checkpoint(eager=True)
    qs = conv.where(F.col("role") == "user").select(F.struct("conv_id", "turn").alias("qid"), "text")
    out = retrieval.retrieve(qs, blocks, k=3, cache=text.answer_cache(conv))
    return out.select("qid.conv_id", "qid.turn", "key", "topic", "context", "prompt", "status",
                      F.size("messages").alias("n_messages"))


# --------------------------------------------------------------------------
# streaming (availableNow over the table files; outputs read back)
# --------------------------------------------------------------------------

from tessera.streaming import streams  # noqa: E402


def _event_stream(spark, sf):
    schema = T(spark, sf, "events").schema
    return streams.read_table_stream(spark, sf, "events", schema)


@register("stream_capture", """
SELECT event_id, user_id, ts, event_type FROM events WHERE event_type <> 'error'
""")
def q_stream_capture(spark, sf):
    s = _event_stream(spark, sf).select("event_id", "user_id", "ts", "event_type")
    return streams.run_available(streams.capture(s, F.col("event_type") != "error"), "capture")


@register("stream_score", SQL["network_score"])
def q_stream_score(spark, sf):
    li = T(spark, sf, "lineitem")
    s = streams.read_table_stream(spark, sf, "lineitem", li.schema).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")

    def score(df):
        ins = [F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10]
        return network.score_network(df, ins, NET_LAYERS).select(
            "l_orderkey", "l_linenumber", r6(F.col("out0")).alias("score"))

    return streams.run_available(streams.score_stream(s, score), "score")


@register("stream_throttle", SQL["throttle"])
def q_stream_throttle(spark, sf):
    s = _event_stream(spark, sf).select("event_id", "user_id", "ts")
    out = streams.run_available(streams.throttle_stream(s, "user_id", "ts", "event_id", 24 * 3600), "throttle")
    return out.select("event_id", "user_id", "ts")


@register("stream_every_nth", SQL["every_nth"])
def q_stream_every_nth(spark, sf):
    s = _event_stream(spark, sf).select("event_id", "user_id", "ts")
    out = streams.run_available(streams.every_nth_stream(s, "user_id", "ts", "event_id", 5), "every_nth")
    return out.select("event_id", "user_id", "rn")


@register("stream_dedupe", f"""
SELECT DISTINCT {_KEY_SQL} AS key FROM conversations WHERE role = 'user'
""")
def q_stream_dedupe(spark, sf):
    conv = T(spark, sf, "conversations")
    s = streams.read_table_stream(spark, sf, "conversations", conv.schema)
    q = text.question_keys(s.where(F.col("role") == "user")).select(
        "key", F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("asked_at"))
    out = streams.run_available(streams.dedupe_questions(q, "key", "asked_at", "1 hour"), "dedupe")
    return out.select("key")


# --------------------------------------------------------------------------
# scalar and small operators over whole tables: activations, symbol index and
# one-hot, string functions, seeded shuffle, cell numbering, set-form neuron
# sums, routed scoring with a decision gate
# --------------------------------------------------------------------------

from tessera.functions import activations as ACT  # noqa: E402
from tessera.operators.ordered import keyed_scan  # noqa: E402

_X_SQL = "((l_quantity - 25) / 10)"


@register("activations", f"""
SELECT l_orderkey, l_linenumber,
       round(1.0 / (1.0 + exp(-{_X_SQL})), 6) AS logistic,
       round((1.0 / (1.0 + exp(-{_X_SQL}))) * (1.0 - 1.0 / (1.0 + exp(-{_X_SQL}))), 6) AS d_logistic,
       round(tanh({_X_SQL}), 6) AS tanh,
       round(1.0 - tanh({_X_SQL}) * tanh({_X_SQL}), 6) AS d_tanh,
       CASE WHEN {_X_SQL} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hlim,
       round(CASE WHEN {_X_SQL} > 0 THEN {_X_SQL} ELSE 0.0::DOUBLE END, 6) AS relu,
       CASE WHEN {_X_SQL} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d_relu
FROM lineitem
""")
def q_activations(spark, sf):
    x = (F.col("l_quantity") - 25) / 10
    li = T(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        r6(ACT.logistic(x)).alias("logistic"), r6(ACT.logistic(x, deriv=True)).alias("d_logistic"),
        r6(ACT.tanh(x)).alias("tanh"), r6(ACT.tanh(x, deriv=True)).alias("d_tanh"),
        ACT.hlim(x).alias("hlim"), r6(ACT.relu(x)).alias("relu"), ACT.relu(x, deriv=True).alias("d_relu"))


# Event type -> symbol index.
EVENT_INDEX = {"signup": 0, "view": 1, "click": 2, "purchase": 3, "error": 4}
_EVENT_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_INDEX.items()) + " END"


@register("symbol_onehot", f"""
SELECT event_id, {_EVENT_CASE} AS idx,
       list_transform(range(5), lambda k: CASE WHEN k = {_EVENT_CASE} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS onehot
FROM events
""")
def q_symbol_onehot(spark, sf):
    e = T(spark, sf, "events").select("event_id", A.symbol_index(F.col("event_type"), EVENT_INDEX).alias("idx"))
    return e.select("event_id", "idx", A.one_hot(F.col("idx"), len(EVENT_INDEX)).alias("onehot"))


@register("string_functions", r"""
SELECT page_id, regexp_replace(url, '\?.*$', '') AS base_url,
       CAST(len(string_split(url, '/')) AS INTEGER) AS n_parts,
       printf('%.4f', length(html) / 1000.0) AS kchars
FROM pages
""")
def q_string_functions(spark, sf):
    p = T(spark, sf, "pages")
    return p.select(
        "page_id",
        F.regexp_replace("url", r"\?.*$", "").alias("base_url"),
        F.size(TX.split_label("url", "/")).alias("n_parts"),
        TX.format_fixed(F.length("html") / 1000.0, 4).alias("kchars"))


@register("shuffle_rows", """
SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS pos
FROM orders
""")
def q_shuffle_rows(spark, sf):
    # U6 as a stable position: the seeded order numbered by the skew-safe scan
    o = T(spark, sf, "orders").select("o_orderkey").withColumn("_h", prep.seeded_hash("o_orderkey"))
    return keyed_scan(o, [], ["_h", "o_orderkey"], rn="pos").select("o_orderkey", "pos")


@register("grid_cells", f"""
WITH c AS ({_CELLS_SQL})
SELECT r, c, c * 50 + r + 1 AS cell, (abs(r - 1) + abs(c - 1)) * 10 AS h FROM c
""")
def q_grid_cells(spark, sf):
    c = _part_cells(spark, sf)
    return c.select("r", "c", graph.cell_number(F.col("r"), F.col("c"), 50).alias("cell"),
                    ACT.manhattan10("r", "c", F.lit(1), F.lit(1)).alias("h"))


# Connections (from, to, weight) of two hidden neurons.
HIDDEN_CONNECTIONS = [(0, 10, 0.8), (1, 10, -1.2), (2, 10, 0.5), (0, 11, -0.4), (1, 11, 0.9), (2, 11, 1.1)]
_CONN_SQL = ", ".join(f"({a}, {b}, {w})" for a, b, w in HIDDEN_CONNECTIONS)


@register("weighted_sum", f"""
WITH a AS (
  SELECT o_orderkey AS row_id, 0 AS node, o_totalprice / 100000 AS value FROM orders
  UNION ALL SELECT o_orderkey, 1, (o_custkey % 10) / 10.0::DOUBLE FROM orders
  UNION ALL SELECT o_orderkey, 2, length(o_orderpriority) / 10.0::DOUBLE FROM orders),
cn("from", "to", weight) AS (VALUES {_CONN_SQL})
SELECT a.row_id, cn."to" AS node, round(sum(a.value * cn.weight), 6) AS value
FROM a JOIN cn ON a.node = cn."from" GROUP BY a.row_id, cn."to"
""")
def q_weighted_sum(spark, sf):
    # o_orderkey is unique, so each input row keeps its own sums
    acts = T(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("node"), (F.col("o_totalprice") / 100000).alias("value")),
            F.struct(F.lit(1).alias("node"), ((F.col("o_custkey") % 10) / 10.0).alias("value")),
            F.struct(F.lit(2).alias("node"), (F.length("o_orderpriority") / 10.0).alias("value")))))
    conns = spark.createDataFrame(HIDDEN_CONNECTIONS, "from int, to int, weight double")
    ws = network.weighted_sum(conns, acts)
    return ws.select("row_id", "node", r6(F.col("value")).alias("value"))


@register("score_routed", f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'A' THEN CASE WHEN {_network_sql(_NET_INPUTS_SQL, NET_LAYERS)} > 0.5 THEN 1 ELSE 0 END
            WHEN l_returnflag = 'N' THEN CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END
            ELSE 0 END AS pred,
       (CASE WHEN l_returnflag = 'A' THEN CASE WHEN {_network_sql(_NET_INPUTS_SQL, NET_LAYERS)} > 0.5 THEN 1 ELSE 0 END
             WHEN l_returnflag = 'N' THEN CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END
             ELSE 0 END) = 1 AND l_quantity > 10 AS act
FROM lineitem
""")
def q_score_routed(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
                                         "l_discount", "l_tax")
    ins = [F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10]
    models_ = {
        "A": lambda d: network.score_network(d, ins, NET_LAYERS).withColumn(
            "pred", F.when(F.col("out0") > 0.5, 1).otherwise(0)),
        "N": F.when(F.col("l_discount") > 0.05, 1).otherwise(0),
    }
    s = prep.score_routed(li, "l_returnflag", models_)
    return s.select("l_orderkey", "l_linenumber", "pred",
                    prep.decision_gate("pred", F.col("l_quantity") > 10).alias("act"))


def _hidden_sql() -> list[str]:
    layer = NET_LAYERS[0]
    return [_network_sql(_NET_INPUTS_SQL, [{"weights": [row], "bias": [b], "squash": "LOGISTIC"}])
            for row, b in zip(layer["weights"], layer["bias"])]


@register("pattern_recall", f"""
SELECT l_orderkey, l_linenumber,
       [{", ".join(f"CASE WHEN {h} > 0.5 THEN 1 ELSE 0 END" for h in _hidden_sql())}] AS pattern
FROM lineitem
""")
def q_pattern_recall(spark, sf):
    # Activate the hidden layer, then read the pattern back as 0/1
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    ins = [F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10]
    h = network.score_network(li, ins, NET_LAYERS[:1], out_prefix="h")
    return h.select("l_orderkey", "l_linenumber",
                    A.threshold(F.array("h0", "h1", "h2"), 0.5).alias("pattern"))


# --------------------------------------------------------------------------
# stored indexes and models
# --------------------------------------------------------------------------

from tessera.sources.vector_index import VectorIndex  # noqa: E402


@register("stored_index", """
WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
d AS (SELECT a.vec_id AS qid, b.vec_id AS bid, a.label AS topic, sum((a.v - b.v) * (a.v - b.v)) AS dist
      FROM x a JOIN x b ON a.label = b.label AND a.i = b.i AND a.vec_id <> b.vec_id GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, bid) AS rank FROM d)
SELECT qid, topic, CAST(rank AS INTEGER) AS rank, bid, round(dist, 6) AS dist FROM r WHERE rank <= 3
""")
def q_stored_index(spark, sf):
    """An index of one part of the vectors, the others appended, searched
    by all in their own cell (label)."""
    emb = T(spark, sf, "embeddings").select("vec_id", F.col("label").alias("topic"), F.col("embedding").cast("array<double>").alias("vec"))
    path = scratch_path(spark, "vector-index")
    VectorIndex.create(emb.where("vec_id % 3 <> 0"), path).append(emb.where("vec_id % 3 = 0"))
    nn = VectorIndex(spark, path).search(emb.withColumnRenamed("vec_id", "qid"), 3, exclude_self=True)
    return nn.withColumn("dist", r6(F.col("dist")))


_ALL_WALKS = ",\n".join(_walk_sql(p, 5).replace("FROM s WHERE is_test", "FROM s") for p in "ab")


@register("stream_score_models", _TRAIN_SQL + ",\n" + ",\n".join([_tree_sql("a", "quality", 5), _tree_sql("b", "toxic", 5), _ALL_WALKS]) + """
SELECT s.doc_id, CAST(a.class AS DOUBLE) AS pred_quality, CAST(b.class AS DOUBLE) AS pred_toxic, CAST(1 AS BIGINT) AS model_version
FROM s JOIN aleaf a USING (doc_id) JOIN bleaf b USING (doc_id)
""")
def q_stream_score_models(spark, sf):
    """K2: two saved trees, loaded from the registry, score the labelled
    documents as a stream."""
    from tessera.plans.registry import ModelRegistry

    train, _ = _split_docs(spark, sf)
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    train = train.checkpoint(eager=True)
    registry.publish({lab: models.fit_tree(train, DOC_FEATURES, lab, max_depth=5) for lab in ("quality", "toxic")})
    folder = scratch_path(spark, "live-rows")  # the rows to score, as files that arrive
    rows = _doc_features(spark, sf).select("doc_id", *DOC_FEATURES)
    rows.repartition(4, "doc_id").write.parquet(folder)
    live = streams.read_stream(spark, folder, rows.schema, max_files=2)
    return streams.score_with_registry(live, registry, scratch_path(spark, "scored"), ["doc_id"])


@register("stream_answers", f"""
WITH q AS (SELECT conv_id, turn, {_KEY_SQL} AS key FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn, text AS answer FROM conversations WHERE role = 'assistant' AND length(trim(text, {_WS})) >= 20),
c AS (SELECT key, min(answer) AS answer FROM q JOIN a USING (conv_id, turn) GROUP BY key)
SELECT conv_id, turn, q.key, coalesce(c.answer, 'answer to: ' || q.key) AS answer, CASE WHEN c.answer IS NULL THEN 'new' ELSE 'cache' END AS source
FROM q LEFT JOIN c ON q.key = c.key
""")
def q_stream_answers(spark, sf):
    """K4: live questions against the cache that earlier conversations left;
    each key that isn't there is answered once."""
    conv = T(spark, sf, "conversations")
    cache = scratch_path(spark, "answers")
    earlier = text.answer_cache(conv).groupBy("key").agg(F.min("answer").alias("answer"))
    streams.write_epoch(earlier, cache, "earlier", 0)
    s = streams.read_table_stream(spark, sf, "conversations", conv.schema)
    asked = text.question_keys(s.where(F.col("role") == "user")).select("conv_id", "turn", "key")
    return streams.answer_stream(asked, cache, lambda new: new.withColumn("answer", F.concat(F.lit("answer to: "), "key")),
                                 scratch_path(spark, "asked"), order=("conv_id", "turn"))


from tessera.streaming import event_order  # noqa: E402

ARRIVAL_DELAY = "2 days"


def _arriving_events(spark, sf):
    """The events as files in an order of arrival up to a day late, and a last
    row of user -1 that moves the watermark over all others."""
    ev = T(spark, sf, "events").select("event_id", "user_id", "ts").where("user_id is not null and ts is not null")
    late = F.pmod(F.xxhash64("event_id"), F.lit(86_400))
    ev = ev.withColumn("_arrived", F.unix_seconds(F.col("ts").cast("timestamp")) + late)
    lo, hi, last = ev.agg(F.min("_arrived"), F.max("_arrived"), F.max("ts")).first()
    folder = scratch_path(spark, "arriving-events")
    part = F.floor((F.col("_arrived") - lo) * 3 / (hi - lo + 1))
    for i in range(3):
        ev.where(part == i).drop("_arrived").write.parquet(f"{folder}/part={i}")
    end = spark.range(1).select(F.lit(-1).cast(ev.schema["event_id"].dataType).alias("event_id"), F.lit(-1).cast(ev.schema["user_id"].dataType).alias("user_id"),
                                (F.lit(last) + F.expr("INTERVAL 30 DAYS")).cast(ev.schema["ts"].dataType).alias("ts"))
    end.write.parquet(f"{folder}/part=3")
    schema = ev.drop("_arrived").schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 2 * spark.sparkContext.defaultParallelism).parquet(folder)


@register("stream_throttle_ordered", SQL["throttle"])
def q_stream_throttle_ordered(spark, sf):
    s = event_order.throttle_in_order(_arriving_events(spark, sf), "user_id", "ts", "event_id", 24 * 3600, ARRIVAL_DELAY)
    return streams.run_available(s, "throttle_ordered").where("user_id >= 0").select("event_id", "user_id", "ts")


@register("stream_every_nth_ordered", SQL["every_nth"])
def q_stream_every_nth_ordered(spark, sf):
    s = event_order.every_nth_in_order(_arriving_events(spark, sf), "user_id", "ts", "event_id", 5, ARRIVAL_DELAY)
    return streams.run_available(s, "every_nth_ordered").where("user_id >= 0").select("event_id", "user_id", "rn")


# --------------------------------------------------------------------------
# vector and array functions over whole tables
# --------------------------------------------------------------------------

from tessera.functions import vectors as VEC  # noqa: E402


@register("vector_functions", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_reverse(embedding::DOUBLE[]) AS r FROM embeddings),
n AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm, list_sum(list_transform(list_zip(v, r), lambda p: p[1] * p[2])) AS d FROM e)
SELECT vec_id, round(norm, 6) AS norm, round(d, 6) AS dot, round(list_sum(list_transform(list_zip(v, r), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS l2sq,
       round(CASE WHEN norm > 0 THEN 1.0 - d / (norm * norm) ELSE 1.0 END, 6) AS cosine_distance,
       list_transform(v[2:4], lambda x: round(x, 6)) AS part, round(r[1], 6) AS last, CAST(len(v) + 2 AS INTEGER) AS n_pushed FROM n
""")
def q_vector_functions(spark, sf):
    e = T(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    e = e.withColumn("r", A.reversed_array("v"))
    return e.select(
        "vec_id", r6(VEC.l2_norm("v")).alias("norm"), r6(VEC.dot("v", "r")).alias("dot"), r6(VEC.l2sq("v", "r")).alias("l2sq"),
        r6(VEC.cosine_distance("v", "r")).alias("cosine_distance"),
        F.transform(A.slice_from("v", 2, 3), lambda x: r6(x)).alias("part"), r6(F.get("r", F.lit(0))).alias("last"),
        F.size(A.push("v", 1.0, 2.0)).alias("n_pushed"))


# --------------------------------------------------------------------------
# perceptron by whole-table steps
# --------------------------------------------------------------------------

from tessera.plans import perceptron  # noqa: E402

_STEPS, _RATE = 3, 2.0


def _perceptron_sql(steps: int, rate: float) -> str:
    """Gradient steps of one layer with two inputs and two outputs from zeros."""
    out = ["""WITH x AS (SELECT l_quantity / 50 AS a, l_discount * 10 AS b, CAST(l_returnflag = 'R' AS INTEGER) AS t0,
                  CAST(l_linestatus = 'O' AS INTEGER) AS t1 FROM lineitem),
w0 AS (SELECT 0.0::DOUBLE AS a0, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS c0, 0.0::DOUBLE AS a1, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS c1)"""]
    for s in range(steps + 1):
        out.append(f"o{s} AS (SELECT x.*, w.*, t0 - 1 / (1 + exp(-(a * a0 + b * b0 + c0))) AS e0, t1 - 1 / (1 + exp(-(a * a1 + b * b1 + c1))) AS e1 FROM x, w{s} w)")
        moved = ", ".join(f"max({v}{k}) + {rate} * avg(e{k}{m}) AS {v}{k}" for k in (0, 1) for v, m in (("a", " * a"), ("b", " * b"), ("c", "")))
        out.append(f"w{s + 1} AS MATERIALIZED (SELECT {moved} FROM o{s})")
    costs = " UNION ALL ".join(f"SELECT 'cost' AS name, {s} AS i, round(avg((e0 * e0 + e1 * e1) / 2), 6) AS value FROM o{s}" for s in range(steps + 1))
    names = [f"{v}{k}" for k in (0, 1) for v in "abc"]
    weights = " UNION ALL ".join(f"SELECT 'weight' AS name, {i} AS i, round({c}, 6) AS value FROM w{steps}" for i, c in enumerate(names))
    return ",\n".join(out) + f"\n{costs} UNION ALL {weights}"


@register("perceptron_steps", _perceptron_sql(_STEPS, _RATE))
def q_perceptron_steps(spark, sf):
    li = T(spark, sf, "lineitem").select(
        (F.col("l_quantity") / 50).alias("a"), (F.col("l_discount") * 10).alias("b"),
        (F.col("l_returnflag") == "R").cast("int").alias("t0"), (F.col("l_linestatus") == "O").cast("int").alias("t1"))
    zeros = [(perceptron.np.zeros((2, 2)), perceptron.np.zeros(2))]
    m = perceptron.fit_perceptron(li, ["a", "b"], ["t0", "t1"], rate=_RATE, iterations=_STEPS, error=0.0, start=zeros)
    (w, bias), = m.layers
    values = [("weight", i, float(v)) for i, v in enumerate([w[0, 0], w[0, 1], bias[0], w[1, 0], w[1, 1], bias[1]])]
    values += [("cost", i, float(c)) for i, c in enumerate(m.costs)]
    return spark.createDataFrame(values, "name string, i int, value double").withColumn("value", r6(F.col("value")))
