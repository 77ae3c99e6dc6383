"""Ties, null keys, the balance rule, frame borders in streams, model kinds."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph, metrics, prep, sequences, trees, vectors
from tessera.operators.ordered import next_in_key
from tessera.plans import models
from tessera.session import ensure_checkpoint_dir
from tessera.sources.tables import scratch_path
from tessera.streaming import streams


@pytest.mark.parametrize("block, parts", [(2048, 3), (100, 7), (2000, 1)])
def test_equal_distances_go_to_the_smallest_ids(spark, block, parts):
    base = spark.range(2000).select(F.col("id").alias("bid"), F.array(F.lit(1.0), F.lit(2.0)).alias("vec")).repartition(parts)
    q = base.where("bid = 0").withColumnRenamed("bid", "qid")
    got = vectors.nearest_k(q, base, 3, exclude_self=True, block=block).orderBy("rank").collect()
    assert [r.bid for r in got] == [1, 2, 3]


def test_neighbours_by_topic_with_nulls(spark):
    rows = [(1, [0.0], "a"), (2, [1.0], "a"), (3, [0.1], "b"), (4, None, "a"), (5, [0.0], None), (6, [5.0], "a")]
    df = spark.createDataFrame(rows, "qid long, vec array<double>, topic string")
    got = vectors.nearest_k(df, df.withColumnRenamed("qid", "bid"), 2, exclude_self=True, on="topic", block=1).collect()
    assert sorted((r.qid, r["rank"], r.bid) for r in got) == [(1, 1, 2), (1, 2, 6), (2, 1, 1), (2, 2, 6), (6, 1, 2), (6, 2, 1)]
    assert vectors.nearest_k(df.limit(0), df.withColumnRenamed("qid", "bid"), 2).count() == 0


def test_search_plan_keeps_off_the_driver(spark):
    df = spark.range(10).select(F.col("id").alias("qid"), F.array(F.col("id").cast("double")).alias("vec"))
    plan = vectors.nearest_k(df, df.withColumnRenamed("qid", "bid"), 2)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan


def test_null_keys_follow_each_other(spark):
    df = spark.createDataFrame([(1, None, 1, "a"), (2, None, 2, "b"), (3, "k", 1, "c")], "id long, key string, t long, v string")
    got = next_in_key(df, ["key"], ["t", "id"], "v", "nxt").collect()
    assert [(r.id, r.nxt) for r in got] == [(1, "b")]
    ts = df.withColumn("ts", F.timestamp_seconds(F.col("t") * 100))
    assert sorted(r.id for r in sequences.throttle(ts, ["key"], "ts", "id", 50).collect()) == [1, 2, 3]
    assert sequences.throttle(ts, ["key"], "ts", "id", 500).columns == ts.columns


def test_balance_goes_up_and_down(spark):
    for n0, n1 in ((58, 341), (341, 58), (10, 10)):
        df = spark.range(n0 + n1).select("id", (F.col("id") >= n0).cast("int").alias("y"))
        out = prep.oversample_even(df, "id", "y")
        assert {r.y: r["count"] for r in out.groupBy("y").count().collect()} == {0: n0, 1: n0}


def test_copies_are_spread(spark):
    df = spark.range(3100).select("id", (F.col("id") >= 3000).cast("int").alias("y"))
    out = prep.oversample_even(df, "id", "y")
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 6000 and max(per_task) < 2 * 6000 / len(per_task)


def test_unknown_kind_fails(spark):
    with pytest.raises(ValueError, match="unknown kinds"):
        models.train_all(spark.range(5), [{"name": "x", "kind": "forest", "features": ["id"], "label": "id"}], "id")


def test_knn_family(spark):
    df = spark.range(60).select("id", (F.col("id") % 2 * 10 + F.col("id") / 100).alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    model, report = models.train_all(df, [{"name": "k", "kind": "knn", "features": ["x"], "label": "y", "k": 3}], "id")["k"]
    assert model == ("knn", 3)
    assert {r["class"]: r.f1 for r in report.collect()}["accuracy"] == 1.0


def test_streams_do_not_depend_on_frames(spark):
    rows = spark.range(400).select(
        F.col("id").alias("event_id"), F.lit("hot").alias("user"), F.timestamp_seconds(F.lit(10_000) - F.col("id") * 7).alias("ts"))
    folder = scratch_path(spark, "frames-in")
    rows.coalesce(1).write.parquet(folder)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        read = lambda: streams.read_stream(spark, folder, rows.schema)
        got = streams.run_available(streams.throttle_stream(read(), "user", "ts", "event_id", 60), "frames-k3").collect()
        nth = streams.run_available(streams.every_nth_stream(read(), "user", "ts", "event_id", 5), "frames-k5").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = sequences.throttle(rows, ["user"], "ts", "event_id", 60).collect()
    assert {r.event_id for r in got} == {r.event_id for r in want}
    ordered = [r.event_id for r in rows.orderBy("ts", "event_id").collect()]
    assert sorted((r.rn, r.event_id) for r in nth) == [(i + 1, ordered[i]) for i in range(0, 400, 5)]


def test_checkpoint_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Empty:
        def isDefined(self):
            return False

    class Context:
        master = "yarn"

        class _jsc:
            @staticmethod
            def sc():
                class S:
                    @staticmethod
                    def getCheckpointDir():
                        return Empty()

                return S

        @staticmethod
        def getConf():
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_tree_statistics_with_many_classes_and_nulls(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("node"), F.col("id").cast("double").alias("x"),
                                      F.when(F.col("id") > 0, F.col("id") % 12_000).alias("y"))
    got = {r.node: r for r in trees.node_stats(rows, "node", "y").collect()}
    assert sum(r.samples for r in got.values()) == 29_999 and len(got[0].value) == 12_000
    two = rows.select("x", (F.col("x") >= 20_000).cast("int").alias("y"))
    best = trees.best_split(two, "x", "y").first()
    assert (best.threshold, best.impurity, best.n_left, best.n_right) == (19_999.5, 0.0, 20_000, 10_000)
    assert trees.best_split(two.limit(1), "x", "y").count() == 0


def test_paths_to_many_targets(spark):
    chain = [(i, i * 10, i - 1 if i else None) for i in range(40)] + [(100, 5, 0)]
    dist = spark.createDataFrame(chain, "node long, cost long, prev long")
    targets = spark.createDataFrame([(39,), (100,), (0,), (777,)], "node long")
    got = {}
    for r in graph.paths_to(dist, targets).orderBy("target", F.desc("back")).collect():
        got.setdefault(r.target, []).append(r.node)
    assert got == {39: list(range(40)), 100: [0, 100], 0: [0]}
    assert graph.path_to(dist, 777) == [777]


def test_report_counts_each_class_once(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c"), (None, "a")], "y string, p string")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (0.5, 0.5, 2)
    assert (got["c"].precision, got["c"].support, got[None].support, got["accuracy"].f1) == (0.0, 0, 1, 0.25)
    plan = metrics.classification_report(df, "y", "p")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan


def test_weights_of_terms(spark):
    df = spark.createDataFrame([(1, "The cat, the CAT"), (2, "the dog"), (3, None), (4, "")], "id long, text string")
    got = {(r.id, r.term): r for r in models.term_weights(df, "id", "text").collect()}
    assert {k: r.tf for k, r in got.items()} == {(1, "the"): 2, (1, "cat"): 2, (2, "the"): 1, (2, "dog"): 1}
    assert got[1, "cat"].weight ** 2 + got[1, "the"].weight ** 2 == pytest.approx(1.0)
    assert got[2, "dog"].weight > got[2, "the"].weight
