"""Evaluation metrics.

All of them are aggregations: a partial aggregate per partition, then a
shuffle of one row per group. The classification report works from the
confusion counts ``groupBy(y, p)`` (at most classes^2 rows), never from the
rows themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import keyed_scan


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row ``(n, n_correct, accuracy)``."""
    hit = F.when(F.col(y) == F.col(p), 1).otherwise(0)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(hit).cast("bigint").alias("n_correct"),
        F.avg(hit.cast("double")).alias("accuracy"),
    )


def classification_report(df: DataFrame, y: str, p: str, decimals: int = 6) -> DataFrame:
    """Per class precision, recall, F1, support; then accuracy, macro and
    weighted averages (0/0 -> 0). ``class`` is text so the summary rows fit."""
    conf = df.groupBy(F.col(y).alias("_y"), F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # each pair of classes counts for its actual and for its predicted class
    hit = F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("_y").alias("k"), hit.alias("tp"), F.lit(0).cast("long").alias("npred"), F.col("_n").alias("support")),
        F.struct(F.col("_p").alias("k"), F.lit(0).cast("long").alias("tp"), F.col("_n").alias("npred"),
                 F.lit(0).cast("long").alias("support")))
    per = conf.select(F.inline(sides)).groupBy("k").agg(*[F.sum(c).alias(c) for c in ("tp", "npred", "support")])
    # one row a class, read by every part of the report: stored once
    per = per.checkpoint(eager=True)
    prec = F.when(F.col("npred") == 0, 0.0).otherwise(F.col("tp") / F.col("npred"))
    rec = F.when(F.col("support") == 0, 0.0).otherwise(F.col("tp") / F.col("support"))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    per = per.withColumn(
        "f1",
        F.when(F.col("precision") + F.col("recall") == 0, 0.0).otherwise(
            2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))),
    )
    r = lambda c: F.round(c, decimals)
    rows = per.select(F.col("k").cast("string").alias("class"), r(F.col("precision")).alias("precision"),
                      r(F.col("recall")).alias("recall"), r(F.col("f1")).alias("f1"), "support")
    tot = per.agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
    )
    null = F.lit(None).cast("double")
    acc = tot.select(F.lit("accuracy").alias("class"), null.alias("precision"), null.alias("recall"),
                     r(F.col("tp") / F.col("n")).alias("f1"), F.col("n").cast("bigint").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("class"), r(F.col("mp")).alias("precision"),
                       r(F.col("mr")).alias("recall"), r(F.col("mf")).alias("f1"),
                       F.col("n").cast("bigint").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("class"), r(F.col("wp")).alias("precision"),
                          r(F.col("wr")).alias("recall"), r(F.col("wf")).alias("f1"),
                          F.col("n").cast("bigint").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def evaluate(df: DataFrame, target: str, output: str, group: Sequence[str],
             costs: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """G9 (+ X1): mean cost per row for each named cost function, per group."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, fn in costs.items():
        aggs.append(F.avg(fn(F.col(target), F.col(output)).cast("double")).alias(name))
    return df.groupBy(*group).agg(*aggs)


def block_success_rate(df: DataFrame, order: Sequence[str], flag: str, block: int = 1000) -> DataFrame:
    """Trials numbered from 0 in ``order``; the success counter restarts
    every ``block`` trials and the first trial of a block never counts (it is
    zeroed after counting); rate = successes so far in the block / position+1.

    The global trial number comes from the skew-safe scan (a global order is
    one hot key); blocks then hold at most ``block`` rows, so a plain window
    per block is bounded."""
    s = keyed_scan(df, [], list(order))
    s = s.withColumn("trial", F.col("rn") - 1)
    s = s.withColumn("block", F.floor(F.col("trial") / block).cast("bigint"))
    s = s.withColumn("_pos", F.col("trial") - F.col("block") * block)
    counted = F.when(F.col("_pos") == 0, 0).otherwise(F.col(flag))
    w = Window.partitionBy("block").orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    return s.withColumn("success_rate", F.sum(counted).over(w) / (F.col("_pos") + 1)).drop("_pos", "rn")
