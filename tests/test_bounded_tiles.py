"""Pairs, neighbours and sums whose memory and shuffles must stay bounded."""

import random

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import network, vectors
from tessera.plans import models


def rows_of(n, width, seed=5):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-1, 1) for _ in range(width)]) for i in range(n)]


def test_lsh_pairs_equal_the_join_of_spark_ml(spark):
    rows = rows_of(150, 4)
    df = spark.createDataFrame(rows + rows[:3] + [(900, None)], "id long, x array<double>")
    v = spark.createDataFrame(rows, "id long, x array<double>").select("id", array_to_vector("x").alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=0.4, numHashTables=3, seed=42).fit(v)
    want = {(r.a, r.b): r.dist for r in model.approxSimilarityJoin(v, v, 0.7, "dist").select(
        F.col("datasetA.id").alias("a"), F.col("datasetB.id").alias("b"), "dist").where("a < b").collect()}
    got = models.lsh_pairs(df, "id", "x", 0.7, 0.4, 3).collect()
    assert len(got) == len(want) > 20 and {(r.a, r.b): r.dist for r in got} == want


def test_buckets_of_many_blocks(spark):
    rows = rows_of(120, 3)
    df = spark.createDataFrame([(i, x, [0, i % 2]) for i, x in rows], "id long, x array<double>, h array<long>")
    want = {(i, j) for i, x in rows for j, y in rows if i < j and sum((a - b) ** 2 for a, b in zip(x, y)) < 0.25}
    for block in (7, 50, None):
        got = [(r.a, r.b) for r in vectors.bucket_pairs(df, 0.5, block).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_bucket_pairs_shuffle_no_pair_of_vectors(spark):
    df = spark.createDataFrame(rows_of(20, 3), "id long, x array<double>")
    plan = models.lsh_pairs(df, "id", "x", 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "datasetA" not in plan


def test_blocks_grow_to_a_bound():
    assert vectors.block_rows(1000, 64) == vectors.BLOCK
    copies = lambda n, width: -(-n // vectors.block_rows(n, width))
    assert copies(100_000, 64) == copies(200_000, 64) == vectors.BLOCKS  # rows are copied as often
    assert vectors.block_rows(10**7, 64) * 64 <= vectors.BLOCK_VALUES


def test_a_node_of_every_row_is_not_one_task(spark):
    conns = spark.createDataFrame([(0, 5, 0.5), (0, 6, 2.0), (1, 5, -1.0)], "from int, to int, weight double")
    acts = spark.range(200).select(F.col("id").alias("row_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("node"), F.col("id").cast("double").alias("value"))
    assert "BroadcastHashJoin" in network.weighted_sum(conns, acts)._jdf.queryExecution().executedPlan().toString()
    want = {(i, n): v for i in range(200) for n, v in ((5, -0.5 * i), (6, 2.0 * i))}
    for most in (100_000, 1):
        assert {(r.row_id, r.node): r.value for r in network.weighted_sum(conns, acts, max_broadcast=most).collect()} == want


def test_term_weights_deal_texts_by_their_size(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 37}" for k in range(1, 30))) for i in range(60)], "id long, text string")
    want = {tuple(r) for r in models.term_weights(df, "id", "text").select("id", "term", "tf", F.round("weight", 9)).collect()}
    monkeypatch.setattr(models, "TASK_BYTES", 200)
    monkeypatch.setattr(models, "TASK_ROWS", 50)
    out = models.term_weights(df, "id", "text")
    assert out.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {tuple(r) for r in out.select("id", "term", "tf", F.round("weight", 9)).collect()} == want
