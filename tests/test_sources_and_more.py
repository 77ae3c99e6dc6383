"""Sources/sinks, network set form, path walk-back and hot-key brute-force checks."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.operators import graph, network, sequences, text
from tessera.plans import models
from tessera.sources import tables
from tessera.sources.tables import scratch_path


def _local(spark, name):
    """A scratch folder as a local path (for writing test files with Python)."""
    p = scratch_path(spark, name)
    return p[len("file:"):] if p.startswith("file:") else p


def test_text_blocks_files_roundtrip(spark):
    base = _local(spark, "corpus")
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/eutanasia.txt", "w", encoding="utf-8") as f:
        f.write("=== TEXTO 1 ===\nprimero\n\n=== TEXTO NUEVO ===\nsegundo\n")
    blocks = text.read_text_blocks(spark, f"{base}/eutanasia.txt")
    got = [(r.topic, r.block_id, r.text) for r in blocks.orderBy("block_id").collect()]
    assert got == [("eutanasia", 1, "primero"), ("eutanasia", 2, "segundo")]
    out = scratch_path(spark, "blocks_out")
    text.write_text_blocks(blocks, out)
    back = text.read_text_blocks(spark, f"{out}/topic=eutanasia/*.txt")
    assert [r.text for r in back.orderBy("block_id").collect()] == ["primero", "segundo"]


def test_vectors_partitioned_by_topic(spark):
    df = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 1, [0.0, 1.0])], "topic string, block_id int, vec array<double>")
    path = scratch_path(spark, "vectors")
    tables.write_vectors(df, path)
    one = tables.read_vectors(spark, path).where(F.col("topic") == "a")
    assert "PartitionFilters: [isnotnull(topic" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_labelled_folders(spark):
    root = _local(spark, "faces")
    for person, n in [("bob", 2), ("alice", 1)]:
        os.makedirs(f"{root}/{person}", exist_ok=True)
        for i in range(n):
            with open(f"{root}/{person}/{i}.png", "wb") as f:
                f.write(b"\x89PNG")
    got = {(r.folder, r.label) for r in tables.read_labelled_files(spark, root).collect()}
    assert got == {("alice", 0), ("bob", 1)}


def test_weighted_sum_and_load_model(spark):
    conns = spark.createDataFrame([(0, 2, 0.5), (1, 2, -1.0)], "from int, to int, weight double")
    acts = spark.createDataFrame([(7, 0, 2.0), (7, 1, 1.0)], "row_id int, node int, value double")
    assert network.weighted_sum(conns, acts).first().value == 0.0
    df = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "x double, y int")
    m = models.fit_tree(df, ["x"], "y", max_depth=2)
    p = scratch_path(spark, "model")
    models.save_model(m, p)
    assert models.load_model(p).transform(df).count() == 20


def test_path_to_walks_predecessors(spark):
    e = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (1, 3, 5)], "src int, dst int, w int")
    d = graph.shortest_paths(e, spark.createDataFrame([(1,)], "node int"))
    assert {r.node: r.cost for r in d.collect()} == {1: 0, 2: 1, 3: 2}
    assert graph.path_to(d, 3) == [1, 2, 3]


def test_is_question(spark):
    df = spark.createDataFrame([("Salir",), ("  ",), ("¿qué?",)], "t string")
    assert [r.q for r in df.select(TX.is_question("t").alias("q")).collect()] == [False, False, True]


def _brute_throttle(rows, gap):
    out, last = [], {}
    for uid, t, eid in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if uid not in last or (t - last[uid]).total_seconds() >= gap:
            out.append(eid)
            last[uid] = t
    return sorted(out)


def test_throttle_hot_key_brute_force(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):  # user 1 holds most rows, with bursts and ties
        rows.append((1, t0 + dt.timedelta(minutes=(i * 7) % 5000), i))
    for i in range(3000, 4500):
        rows.append((2 + i % 5, t0 + dt.timedelta(minutes=(i * 13) % 9000), i))
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long")
    got = sorted(r.event_id for r in sequences.throttle(df, ["user_id"], "ts", "event_id", 3600).collect())
    assert got == _brute_throttle(rows, 3600)


def test_conforms_hot_key_brute_force(spark):
    tr = {("s", "a"): "s", ("s", "b"): "t", ("t", "a"): "s", ("t", "c"): "t"}
    seqs = {1: "ab" * 900 + "c" * 50 + "ab", 2: "abca", 3: "aab" + "x", 4: ""}
    rows = [(k, i, ch) for k, w in seqs.items() for i, ch in enumerate(w)]
    df = spark.createDataFrame(rows, "k int, i int, sym string")
    out = {r.k: r for r in sequences.conforms(df, ["k"], ["i"], "sym", tr, "s", accept=["t"], fan_in=4).collect()}

    def walk(w):
        st, n = "s", 0
        for ch in w:
            st = tr.get((st, ch))
            if st is None:
                return n, None
            n += 1
        return n, st

    for k, w in seqs.items():
        if not w:
            assert k not in out
            continue
        n, st = walk(w)
        assert out[k].steps_ok == n and out[k].final_state == st and out[k].n == len(w)


def test_oversample_chunked_equals_plain(spark):
    from tessera.operators import prep

    rows = [(i, 0) for i in range(50)] + [(1000 + i, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, y int")
    plain = prep.oversample_even(df, "id", "y")
    chunked = prep.oversample_even(df, "id", "y", chunk=4)
    a = sorted(map(tuple, plain.collect()))
    b = sorted(map(tuple, chunked.collect()))
    assert a == b and len(a) == 100
