"""Model versions, retraining, two models on a stream, answers by a cache."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import prep, text
from tessera.plans import models
from tessera.plans.registry import ModelRegistry
from tessera.sources.manifest import Conflict
from tessera.sources.tables import scratch_path
from tessera.streaming import streams

FEATURES = ["a", "b"]
SPEC = [{"name": n, "kind": n, "features": FEATURES, "label": "y", "max_iter": 20, "hidden": (3,)} for n in models.KINDS]


def rows_of(n, seed, flip=False, start=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.random(), rng.random()
        out.append((start + i, a, b, -1 if i % 10 == 9 else int((a > 0.5) != flip)))
    return out


def write(spark, folder, rows, part):
    spark.createDataFrame(rows, "id long, a double, b double, y int").coalesce(1).write.parquet(f"{folder}/part={part}")


def live(spark, folder):
    return (spark.readStream.schema("id long, a double, b double, y int").option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(folder))


def test_registry_saves_three_families(spark):
    df = spark.createDataFrame(rows_of(120, 1), "id long, a double, b double, y int")
    trained = models.train_all(df, SPEC, "id", save_to=scratch_path(spark, "saved"))
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    assert registry.latest().number == 0 and registry.latest().load() == {}
    v = registry.publish({k: m for k, (m, _) in trained.items()}, epoch=4)
    assert v.number == 1 and {e["kind"] for e in v.entries.values()} == {"tree", "knn", "pipeline"}
    for name, model in v.load().items():
        want = trained[name][0].transform(df).select("id", "pred_y").collect()
        assert {r.id: r.pred_y for r in model.transform(df).collect()} == {r.id: r.pred_y for r in want}
    # an epoch is published once
    assert registry.publish({}, epoch=4).number == 1 and registry.publish({}, epoch=3).number == 1
    assert registry.publish({}, epoch=5).number == 2
    assert registry.version(1).entries == v.entries
    with pytest.raises(Conflict):
        registry.manifest.commit(2, {})
    compared = {r.model: r.accuracy for r in models.compare_models(df.where("y >= 0"), v.load(), "y").collect()}
    assert set(compared) == set(models.KINDS) and compared["tree"] >= 0.95


def test_guard_and_dropped_rows(spark):
    df = spark.createDataFrame([(i, float(i), 0.0, 1 if i < 15 else -1) for i in range(20)], "id long, a double, b double, y int")
    assert models.train_all(df, SPEC[:1], "id")["tree"] == (None, "empty_class")
    assert prep.training_guard(df, "y").first().status == "ok"
    assert [tuple(r) for r in models.dropped_rows(df, SPEC[:1]).collect()] == [("tree", 20, 5)]


def test_retraining_by_rows_and_replay(spark):
    folder, table = scratch_path(spark, "live"), scratch_path(spark, "table")
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    spec, out = [SPEC[0]], scratch_path(spark, "job")
    for part in range(3):
        write(spark, folder, rows_of(50, part, start=100 * part), part)
    job = dict(registry=registry, spec=spec, id_col="id", every_rows=90, out=out)
    streams.retrain_job(live(spark, folder), table, **job)
    v = registry.latest()
    assert v.number == 1 and v.epoch == 1  # after two of three micro-batches
    assert v.notes["rows_and_dropped"] == {"tree": [100, 10]}
    assert spark.read.parquet(table).count() == 150
    # more rows after a restart
    write(spark, folder, rows_of(50, 9, start=900), 3)
    streams.retrain_job(live(spark, folder), table, **job)
    assert registry.latest().number == 2 and spark.read.parquet(table).count() == 200
    # the whole stream again, as after a lost checkpoint: nothing is added
    streams.retrain_job(live(spark, folder), table, **{**job, "out": scratch_path(spark, "again")})
    assert registry.latest().number == 2 and spark.read.parquet(table).count() == 200
    assert spark.read.parquet(table).select("id").distinct().count() == 200
    # by time
    write(spark, folder, rows_of(20, 11, start=2000), 4)
    streams.retrain_job(live(spark, folder), table, **{**job, "every_seconds": 0.0})
    assert registry.latest().number == 3


def test_models_are_exchanged_between_micro_batches(spark):
    folder, out = scratch_path(spark, "live"), scratch_path(spark, "scored")
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    old, new = (spark.createDataFrame(rows_of(100, s, flip), "id long, a double, b double, y int").where("y >= 0") for s, flip in ((1, False), (2, True)))

    def pair(df):
        return {"y": models.fit_tree(df, FEATURES, "y", max_depth=2), "z": models.fit_mlp(df.withColumn("z", F.lit(1) - F.col("y")), FEATURES, "z", (3,), max_iter=30)}

    first, second = pair(old), pair(new)
    registry.publish(first)
    write(spark, folder, rows_of(30, 5), 0)
    streams.score_with_registry(live(spark, folder), registry, out, ["id"])
    registry.publish(second)
    write(spark, folder, rows_of(30, 6, start=500), 1)
    got = {r.id: r for r in streams.score_with_registry(live(spark, folder), registry, out, ["id"]).collect()}
    assert len(got) == 60
    for version, model, rows in ((1, first, rows_of(30, 5)), (2, second, rows_of(30, 6, start=500))):
        df = spark.createDataFrame(rows, "id long, a double, b double, y int")
        both = model["z"].transform(model["y"].transform(df)).collect()  # batch scoring
        for r in both:
            assert (got[r.id].pred_y, got[r.id].pred_z, got[r.id].model_version) == (r.pred_y, r.pred_z, version)


def test_questions_are_answered_once(spark):
    folder, cache, out = (scratch_path(spark, n) for n in ("questions", "cache", "asked"))
    calls = []

    def ask(part, rows):
        at = [(i, t, dt.datetime(2024, 1, 1, 0, m)) for i, t, m in rows]
        spark.createDataFrame(at, "qid long, text string, asked_at timestamp").coalesce(1).write.parquet(f"{folder}/part={part}")

    def answer(new):
        calls.append(sorted((r.key, r.qid) for r in new.collect()))
        return new.withColumn("answer", F.when(F.col("key") != "no answer", F.concat(F.lit("A:"), "key", F.col("qid").cast("string"))))

    def run(sink):
        s = (spark.readStream.schema("qid long, text string, asked_at timestamp").option("maxFilesPerTrigger", 1)
             .option("recursiveFileLookup", True).parquet(folder))
        return {r.qid: (r.answer, r.source) for r in streams.answer_stream(text.question_keys(s), cache, answer, sink).collect()}

    ask(0, [(1, "What is it", 5), (2, " what IS it ", 3), (3, "no answer", 1)])
    assert run(out) == {1: ("A:what is it2", "new"), 2: ("A:what is it2", "new"), 3: (None, None)}
    ask(1, [(4, "what, is it", 9), (5, "and now", 9), (6, "no answer", 9)])
    got = run(out)  # after a restart
    assert got[4] == ("A:what is it2", "cache") and got[5] == ("A:and now5", "new") and got[6] == (None, None)
    assert calls == [[("no answer", 3), ("what is it", 2)], [("and now", 5), ("no answer", 6)]]
    # replayed from the start: the same rows
    assert run(scratch_path(spark, "again")) == got
    assert streams.read_epochs(spark, cache, "key string, answer string").count() == 2
