"""Plan-shape checks for the scale properties the operators promise."""

from pyspark.sql import functions as F

from tessera.operators import vectors
from tessera.operators.ordered import keyed_scan
from tessera.plans.catalog import QUERIES
from paths import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_knn_has_no_pair_join(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    p = _plan(vectors.nearest_k(e, e.withColumnRenamed("qid", "bid"), 3, exclude_self=True))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "FlatMapCoGroupsInArrow" in p


def test_keyed_scan_window_is_per_partition_and_key(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    s = keyed_scan(ev, ["user_id"], ["ts", "event_id"], checkpoint=False)
    p = _plan(s)
    assert "rangepartitioning(user_id" in p
    assert "hashpartitioning(_ks_pid" in p  # the window never groups by the key alone


def test_filter_pushdown_and_pruning(spark):
    p = _plan(QUERIES["membership_filter"](spark, SF_SMALL))
    assert "PushedFilters: [In(o_orderstatus" in p or "PushedFilters: [IsNotNull(o_orderstatus), In(o_orderstatus" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in p


def test_aggregations_are_partial(spark):
    for name in ("last_writer", "node_stats", "class_counts"):
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "partial_" in p, name
