"""Event-time operators: any arrival order inside the delay gives the batch result."""

import datetime as dt
import random

import pytest

from tessera.operators import prep, sequences
from tessera.sources.tables import scratch_path
from tessera.streaming import event_order, streams

SCHEMA = "event_id long, user_id long, ts timestamp, note string"
START = dt.datetime(2024, 3, 1)


def events(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([1, 1, 1, 2, 3]), START + dt.timedelta(minutes=rng.randrange(6000), microseconds=rng.choice([0, 1, 1500])), rng.choice(["x", None]))
            for i in range(n)]


def arrivals(spark, rows, parts, disorder, seed):
    """Files in order of arrival: time plus up to ``disorder`` minutes, and a
    last row that moves the watermark over all others."""
    rng = random.Random(seed)
    late = sorted(rows, key=lambda r: r[2] + dt.timedelta(minutes=rng.random() * disorder))
    step = -(-len(late) // parts)
    folder = scratch_path(spark, "arrivals")
    files = [late[i : i + step] for i in range(0, len(late), step)] + [[(10**9, 99, START + dt.timedelta(days=30), None)]]
    for i, part in enumerate(files):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/part={i:03d}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


@pytest.mark.parametrize(("parts", "seed"), [(1, 1), (3, 2)])
def test_equals_batch(spark, parts, seed):
    rows = events(300, 7)
    df = spark.createDataFrame(rows, SCHEMA)
    s = arrivals(spark, rows, parts, 110, seed)
    got = streams.run_available(event_order.throttle_in_order(s, "user_id", "ts", "event_id", 3 * 3600, "2 hours"), "t")
    want = sequences.throttle(df, ["user_id"], "ts", "event_id", 3 * 3600)
    full = {r[0]: r for r in rows}
    assert sorted(tuple(r) for r in got.where("user_id <> 99").collect()) == sorted(full[r.event_id] for r in want.collect())
    s = arrivals(spark, rows, parts, 110, seed + 10)
    got = streams.run_available(event_order.every_nth_in_order(s, "user_id", "ts", "event_id", 4, "2 hours"), "n")
    want = prep.every_nth(df, ["user_id"], ["ts", "event_id"], 4)
    assert sorted((r.event_id, r.rn) for r in got.where("user_id <> 99").collect()) == sorted((r.event_id, r.rn) for r in want.collect())


def test_late_rows_are_dropped(spark):
    folder = scratch_path(spark, "late")
    at = lambda h: START + dt.timedelta(hours=h)
    files = [[(1, 1, at(0), "a"), (2, 1, at(10), "b")], [(3, 1, at(2), "late"), (4, 1, at(9.5), "waits")], [(5, 2, at(100), "end")]]
    for i, part in enumerate(files):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/part={i}")
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
    got = streams.run_available(event_order.every_nth_in_order(s, "user_id", "ts", "event_id", 1, "1 hour"), "late")
    assert sorted((r.event_id, r.rn) for r in got.collect()) == [(1, 1), (2, 3), (4, 2)]


def test_a_batch_of_a_key_is_one_value_of_state():
    import pandas as pd
    from pyspark.sql import types as T

    class State(list):
        def appendValue(self, value):
            self.append(value)

    own = T.StructType([T.StructField(c, T.LongType()) for c in ("event_id", "event_micros")])
    step = event_order._InOrder(own, "event_id", lambda seen, micros: (micros, True), None)
    step.pending, step.handle = State(), type("Handle", (), {"registerTimer": lambda self, ms: None})()
    times = type("Times", (), {"getCurrentWatermarkInMs": lambda self: 0})()
    list(step.handleInputRows((1,), iter([pd.DataFrame({"event_id": range(500), "event_micros": range(1, 501)})]), times))
    assert len(step.pending) == 1
