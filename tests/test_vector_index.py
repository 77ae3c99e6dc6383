"""A stored index: versions, cells, deltas and compaction."""

import random
import re

import pytest

from tessera.operators import vectors
from tessera.sources.manifest import Conflict, Manifest
from tessera.sources.tables import scratch_path
from tessera.sources.vector_index import VectorIndex


def rows_of(n, seed, start=0):
    rng = random.Random(seed)
    return [(start + i, f"t{rng.randrange(4)}", [rng.random() for _ in range(6)]) for i in range(n)]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, topic string, vec array<double>")


def exact(spark, queries, rows, k):
    base = table(spark, rows).withColumnRenamed("vec_id", "bid")
    return sorted(map(tuple, vectors.nearest_k(queries, base, k, on="topic").collect()))


def test_built_in_one_session_searched_in_another(spark):
    path = scratch_path(spark, "vectors")
    first, more = rows_of(300, 1), rows_of(120, 2, start=1000)
    moved = [(5, "t3", [0.5] * 6), (7, first[7][1], [0.25] * 6)]  # newer vectors of known ids
    VectorIndex.create(table(spark, first), path)
    files = spark.read.parquet(path + "/segment-*").inputFiles()
    other = spark.newSession()
    VectorIndex(other, path).append(table(other, more + moved))
    queries = other.createDataFrame([(i, t, v) for i, t, v in rows_of(40, 3) if t != "t0"], "qid long, topic string, vec array<double>")
    current = {r[0]: r for r in first} | {r[0]: r for r in more + moved}
    index = VectorIndex(other, path)
    assert sorted(map(tuple, index.search(queries, 3).collect())) == exact(spark, queries, list(current.values()), 3)
    assert set(files) <= set(index.read().inputFiles())  # the first segment is as it was
    # an earlier version, and one segment for all
    old = VectorIndex(other, path, 1)
    assert sorted(map(tuple, old.search(queries, 3).collect())) == exact(spark, queries, first, 3)
    packed = index.compact()
    assert packed.version == 3 and len(packed.segments) == 1
    assert sorted(map(tuple, packed.read().select("vec_id", "topic").collect())) == sorted((r[0], r[1]) for r in current.values())
    assert len(VectorIndex(other, path, 2).segments) == 2


def test_reads_only_the_cells_asked_for(spark):
    path = scratch_path(spark, "vectors")
    index = VectorIndex.create(table(spark, rows_of(200, 4)), path)
    found = index.search(spark.createDataFrame([(1, "t2", [0.0] * 6)], "qid long, topic string, vec array<double>"), 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filters: \[[^]]*topic#\d+ = t2", plan)  # of the partition column: folders
    assert "PushedFilters: [IsNotNull(vec)]" in plan
    assert index.read(["t2"]).where("topic <> 't2'").isEmpty()
    assert index.read(["t9"]).count() == 0


def test_versions_are_committed_once(spark):
    path = scratch_path(spark, "vectors")
    df = table(spark, rows_of(10, 5) + [(None, "t1", [1.0]), (50, None, [1.0]), (51, "t1", None)])
    index = VectorIndex.create(df, path)
    assert index.read().count() == 10
    with pytest.raises(Conflict):
        VectorIndex.create(df, path)
    with pytest.raises(FileNotFoundError):
        VectorIndex(spark, scratch_path(spark, "none"))
    # two writers that both saw version 1
    a, b = VectorIndex(spark, path), VectorIndex(spark, path)
    a.append(table(spark, rows_of(5, 6, start=100)))
    assert len(b.append(table(spark, rows_of(5, 7, start=200))).segments) == 3
    assert Manifest(spark, path).versions() == [1, 2, 3]
    assert VectorIndex(spark, path).read().count() == 20
