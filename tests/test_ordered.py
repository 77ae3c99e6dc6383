"""Skew-safe keyed scan equals a plain window, also with one hot key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.ordered import keyed_scan, next_in_key
from paths import SF_MID


def _hot_events(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    # a third of all rows on one key
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))


def test_keyed_scan_matches_window_with_hot_key(spark):
    ev = _hot_events(spark)
    s = keyed_scan(ev, ["user_id"], ["ts", "event_id"], sums=["value"], totals=True, n_parts=16)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = ev.select("event_id", F.row_number().over(w).alias("rn2"),
                    F.sum("value").over(w).alias("rs2"),
                    F.count("*").over(Window.partitionBy("user_id")).alias("c2"))
    j = s.join(ref, "event_id")
    bad = j.where((F.col("rn") != F.col("rn2")) | (F.abs(F.col("run_value") - F.col("rs2")) > 1e-6)
                  | (F.col("cnt") != F.col("c2")))
    assert j.count() == ev.count()
    assert bad.count() == 0


def test_keyed_scan_global_order(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    s = keyed_scan(ev, [], ["ts", "event_id"], totals=True, n_parts=7)
    rows = s.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn"), F.max("cnt")).first()
    n = ev.count()
    assert tuple(rows) == (1, n, n, n)


def test_next_in_key(spark):
    ev = _hot_events(spark).select("event_id", "user_id", "ts", "event_type")
    nx = next_in_key(ev, ["user_id"], ["ts", "event_id"], "event_type", "nxt")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = ev.select("event_id", F.lead("event_type").over(w).alias("nxt2"),
                    F.lead("event_id").over(w).alias("nid")).where(F.col("nid").isNotNull())
    j = nx.join(ref, "event_id")
    assert j.count() == ref.count() == nx.count()
    assert j.where(F.col("nxt") != F.col("nxt2")).count() == 0
