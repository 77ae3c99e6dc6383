"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule, a piecewise linear function of training
time 0..1. Its integral is the source's weight; weights share the words that
the mix takes, a source stops at ``max_epochs`` times its size, and the excess
is shared again by weight until no source is above (``water level`` rounds,
each one a small aggregate). The schedule scaled to the target is the source's
demand density; a copy that lies at words c of the target is trained when the
cumulative demand reaches c, so its position is the inverse of the integral
(a quadratic in each piece). Documents are range-sorted by position.

Within a source, documents stand in a fixed pseudo-random order (a hash of the
id). A source's target covers that order once or more; the copy that crosses
the target is taken in part, so the words taken equal the target up to
rounding. The place of a document in its source's order comes from two levels:
documents fall into hash buckets of about ``bucket_rows`` rows, a window
numbers words inside a bucket, and bucket totals give the rest, so a source
with a third of all rows is spread over many tasks.

Defined results: a null text has size 0 and takes nothing; a source whose
documents have no words has the target 0; the null source is a source, last in
order; rows that share an id are placed side by side, in order of size; an
empty table gives an empty result. Columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._text import nonspace_count, unsalted_fraction, without
from tessera.operators.ordered import keyed_scan

SALTS = 32
#: schedules of the sources in turn: (time, weight) knots; integrals 3, 1, 2
SCHEDULES = (
    ((0.0, 4.0), (1.0, 2.0)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)),
)


def integral(knots: Sequence[tuple[float, float]]) -> float:
    """Area below a piecewise linear schedule."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def position(knots: Sequence[tuple[float, float]], share: Column) -> Column:
    """Time at which the schedule's integral reaches ``share`` of its whole."""
    want = share * F.lit(integral(knots))
    out, done = F.when(want <= 0, F.lit(float(knots[0][0]))), 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area, slope = want - F.lit(done), (w1 - w0) / (t1 - t0)
        # w0 x + slope x^2 / 2 = area, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * area))
        x = F.try_divide(2 * area, F.lit(float(w0)) + root)
        done += (t1 - t0) * (w0 + w1) / 2
        out = out.when(want <= F.lit(done), F.least(F.lit(float(t0)) + x, F.lit(float(t1))))
    return out.otherwise(F.lit(float(knots[-1][0])))


def source_targets(
    sizes: DataFrame, schedules=SCHEDULES, share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """``sizes(_no_source, _source, rows, source_size)`` plus ``schedule`` (its
    number, in turn by code point, null last) and ``target``."""
    ranked = keyed_scan(sizes.withColumn("_all", F.lit(0)), ["_all"], ["_no_source", "_source"], rn="_rn").drop("_all")
    weights = F.array(*[F.lit(float(integral(s))) for s in schedules])
    ranked = ranked.withColumn("schedule", ((F.col("_rn") - 1) % len(schedules)).cast("int")).withColumn(
        "_w", F.element_at(weights, F.col("schedule") + 1)
    )
    cap = F.col("source_size") * F.lit(float(max_epochs))
    live = F.col("source_size") > 0
    level, capped = None, -1
    while True:  # each round caps at least one more source, or is the last
        over = live & (F.col("_w") * F.lit(level) > cap) if level is not None else F.lit(False)
        r = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(over, cap).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(live & ~over, F.col("_w")).otherwise(0.0)).alias("open"),
            F.count(F.when(over, 1)).alias("n"),
        ).first()
        if not r["open"] or r["n"] == capped:
            break
        capped = r["n"]
        level = max(level or 0.0, (share * r["all"] - r["fixed"]) / r["open"])
    target = F.least(cap, F.col("_w") * F.lit(level)) if level is not None else F.lit(0.0)
    return ranked.withColumn("target", F.when(live, target).otherwise(F.lit(0.0)).cast("double")).drop("_rn", "_w")


def plan_mix(
    docs: DataFrame,
    size: Column,
    *,
    schedules=SCHEDULES,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 11,
    bucket_rows: int = 50_000,
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken, positions) for
    ``docs(doc_id, source, ...)``, one for each input row; ``positions`` has the
    training time of each copy, the last one perhaps in part."""
    rows = docs.select(
        "doc_id", "source", size.cast("long").alias("size"),
        F.col("source").isNull().alias("_no_source"), F.coalesce(F.col("source"), F.lit("")).alias("_source"),
        unsalted_fraction(F.lit(seed), F.col("doc_id")).alias("_u"),
    ).checkpoint(eager=True)  # fmt: skip  narrow: the texts are read and counted once
    key = ["_no_source", "_source"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    targets = source_targets(sizes, schedules, share, max_epochs).checkpoint(eager=True)
    salted = targets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = rows.withColumn("_salt", F.floor(F.col("_u") * 1e6).cast("int") % SALTS).join(salted, [*key, "_salt"])
    placed = placed.withColumn("_b", F.floor(F.col("_u") * F.ceil(F.col("rows") / bucket_rows)).cast("long"))
    buckets = placed.groupBy(*key, "_b").agg(F.sum("size").alias("_bsize"))
    before = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(*key, "_b", F.coalesce(F.sum("_bsize").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*key, "_b").orderBy("_u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("_c", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(starts, [*key, "_b"])
    c = F.col("_start") + F.col("_c")
    goal = F.round("target").cast("long")
    epochs = max(1, int(-(-max_epochs // 1)))
    taken, spots = F.lit(0).cast("long"), []
    for e in range(epochs):
        at = c + F.col("source_size") * e
        part = F.greatest(F.lit(0), F.least(F.col("size"), goal - at))
        taken = taken + part
        at_share = F.try_divide(at + part / 2, F.col("target"))
        where = F.lit(None).cast("double")
        for i, s in enumerate(schedules):
            where = F.when(F.col("schedule") == i, position(s, at_share)).otherwise(where)
        spots.append(F.when(part > 0, where))
    return out.withColumn("taken", taken).select(
        "doc_id", "source", "size", "source_size", "target", "taken",
        F.array_compact(F.array(*spots)).alias("positions"),
    )


def training_order(plan: DataFrame) -> DataFrame:
    """The plan's rows range-sorted by their first position (rows that the mix
    doesn't take come last)."""
    first = F.coalesce(F.try_element_at("positions", F.lit(1)), F.lit(2.0))
    n = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = unsalted_fraction(F.col("doc_id"))
    return (
        plan.withColumns({"_first": first, "_spread": spread})
        .repartitionByRange(n, "_first", "_spread")
        .sortWithinPartitions("_first", "_spread", "doc_id")
        .drop("_first", "_spread")
    )


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """Plan of the ``documents`` table, in training order."""
    return training_order(plan_mix(docs, nonspace_count(F.col("text")), **settings))


def mixed_copies(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the mix trains them: one row for each copy, in order of
    position, with the input's columns and ``position``. The copy that crosses
    a source's target is taken whole if at least half of its words are within
    the target, else not at all: texts are never cut. (A document's first copy
    that has no half inside stays out, as the mix has met the target by then.)"""
    df = without(docs, ["position"])
    counted = df.withColumn("_size", nonspace_count(F.col("text")))
    plan = plan_mix(counted, F.col("_size"), **settings)
    # rows that share an id and a size are interchangeable for the mix: number them
    twin = F.row_number().over(Window.partitionBy("doc_id", "_size").orderBy(F.xxhash64("text")))
    taken = plan.where("taken > 0").groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_n")).agg(
        F.sort_array(F.collect_list(F.struct("taken", "positions")), asc=False).alias("_plans")
    )  # fmt: skip  one entry for each repeated row
    joined = counted.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("_n")))
    joined = joined.withColumn("_plan", F.try_element_at("_plans", twin)).where("_plan is not null")
    copies = joined.select(
        *df.columns, "_size", F.col("_plan.taken").alias("_taken"), F.posexplode("_plan.positions").alias("_copy", "position")
    )
    words = F.least(F.col("_size"), F.col("_taken") - F.col("_copy") * F.col("_size"))
    out = copies.where(2 * words >= F.col("_size"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.select(*df.columns, "position").repartitionByRange(n, "position", "doc_id")
    return out.sortWithinPartitions("position", "doc_id")
