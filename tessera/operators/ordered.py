"""Skew-safe ordered scans per key.

A window ``partitionBy(key).orderBy(ord)`` sends every row of one key to one
task; when one key holds a third of all rows, that task holds a third of the
data. ``keyed_scan`` computes the same row numbers, running sums and per-key
totals without such a task, the way ``RDD.zipWithIndex`` numbers rows:

1. range-partition on ``(keys, order)``: a hot key is spread over several
   contiguous partitions (range bounds split inside one key value);
2. a local window over ``(partition id, keys)``: a group is at most one
   range partition, so no task is larger than about ``1/n`` of the data;
3. the locally numbered rows are checkpointed to the shared checkpoint folder,
   so every later pass sees the same partition ids (range bounds come from a
   sample and could differ between two evaluations of a shuffled input) and
   the lineage is cut;
4. one summary row per partition (first key, last key and their local
   counts/sums) goes to the driver -- ``n`` rows, bounded by the partition
   count, like the partition sizes ``zipWithIndex`` collects -- and the
   offsets of keys that continue across partitions are computed there;
5. the offsets (again ``n`` rows) are broadcast-joined on the partition id.

The order must be total (add a unique tie-breaker) for results to be
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PID = "_ks_pid"


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    rn: str = "rn",
    totals: bool = False,
    n_parts: int | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """Add ``rn`` (1-based position of the row within its key in ``order``),
    ``run_<c>`` (inclusive running sum of ``c``) for each ``c`` in ``sums``,
    and with ``totals=True`` also ``cnt`` (rows of the key) and ``tot_<c>``.

    ``sums`` columns should be integral (exact) or double. ``checkpoint=False``
    is for plan inspection only: results need the checkpoint (two evaluations
    may sample different range bounds even for a plain file scan).
    """
    keys = list(keys)
    order = list(order)
    sums = list(sums)
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *_cols(keys + order)).withColumn(
        _PID, F.spark_partition_id()
    )
    w = Window.partitionBy(_PID, *keys).orderBy(*order)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(_PID, *keys)
    local = ranged.withColumn("_ks_lrn", F.row_number().over(w))
    for c in sums:
        local = local.withColumn(f"_ks_l_{c}", F.sum(c).over(w_run))
    local = local.withColumn("_ks_lcnt", F.count(F.lit(1)).over(w_all))
    for c in sums:
        local = local.withColumn(f"_ks_lt_{c}", F.sum(c).over(w_all))
    if checkpoint:
        local = local.checkpoint(eager=True)

    # one row per partition: first key with its local totals, last key with its
    # local totals (the last key's totals are what continues into the next one)
    first_fields = keys + ["_ks_lcnt"] + [f"_ks_lt_{c}" for c in sums]
    last_fields = keys + ["_ks_lcnt"] + [f"_ks_lt_{c}" for c in sums]
    summary = (
        local.groupBy(_PID)
        .agg(F.min(F.struct(*first_fields)).alias("f"), F.max(F.struct(*last_fields)).alias("l"))
        .collect()
    )
    summary.sort(key=lambda r: r[_PID])
    nk = len(keys)

    def totals_of(s):
        return [s["_ks_lcnt"]] + [s[f"_ks_lt_{c}"] or 0 for c in sums]

    # carried[i]: totals of the first key of partition i over earlier partitions
    rows = []
    prev_key, carry = None, None
    carried = []
    for r in summary:
        fk = tuple(r["f"][:nk])
        lk = tuple(r["l"][:nk])
        c_in = carry if (carry is not None and prev_key == fk) else [0] * (1 + len(sums))
        carried.append(c_in)
        if fk == lk:  # the whole partition is one key: the carry grows
            carry = [a + b for a, b in zip(c_in, totals_of(r["l"]))]
        else:
            carry = totals_of(r["l"])
        prev_key = lk
    # after[i]: totals of the last key of partition i over later partitions
    after = [[0] * (1 + len(sums)) for _ in summary]
    nxt_key, acc = None, None
    for i in range(len(summary) - 1, -1, -1):
        r = summary[i]
        fk = tuple(r["f"][:nk])
        lk = tuple(r["l"][:nk])
        a_out = acc if (acc is not None and nxt_key == lk) else [0] * (1 + len(sums))
        after[i] = a_out
        if fk == lk:
            acc = [a + b for a, b in zip(a_out, totals_of(r["f"]))]
        else:
            acc = totals_of(r["f"])
        nxt_key = fk
    kschema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])
    sum_type = {c: local.schema[f"_ks_lt_{c}"].dataType for c in sums}
    fields = [T.StructField(_PID, T.IntegerType()),
              T.StructField("_ks_f", kschema), T.StructField("_ks_l", kschema),
              T.StructField("_ks_off", T.LongType())]
    fields += [T.StructField(f"_ks_off_{c}", sum_type[c]) for c in sums]
    fields += [T.StructField("_ks_aft", T.LongType())]
    fields += [T.StructField(f"_ks_aft_{c}", sum_type[c]) for c in sums]

    def typed(vals):
        kinds = [T.LongType(), *(sum_type[c] for c in sums)]
        return [
            float(x) if isinstance(t, (T.DoubleType, T.FloatType)) else Decimal(x) if isinstance(t, T.DecimalType) else int(x)
            for t, x in zip(kinds, vals)
        ]

    for r, c_in, a_out in zip(summary, carried, after):
        rows.append((r[_PID], tuple(r["f"][:nk]), tuple(r["l"][:nk]), *typed(c_in), *typed(a_out)))
    offsets = spark.createDataFrame(rows, T.StructType(fields))

    # offsets hold one row per partition: a broadcast with a proven bound
    joined = local.join(F.broadcast(offsets), _PID, "left")
    is_first = F.lit(True)
    is_last = F.lit(True)
    for k in keys:
        is_first = is_first & F.col(k).eqNullSafe(F.col(f"_ks_f.{k}"))
        is_last = is_last & F.col(k).eqNullSafe(F.col(f"_ks_l.{k}"))

    def when_(cond, c, typ=None):
        v = F.when(cond, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0))
        return v.cast(typ) if typ is not None else v

    out = joined.withColumn(rn, F.col("_ks_lrn") + when_(is_first, "_ks_off", "bigint"))
    for c in sums:
        out = out.withColumn(
            f"run_{c}",
            (F.col(f"_ks_l_{c}") + when_(is_first, f"_ks_off_{c}", sum_type[c])).cast(sum_type[c]),
        )
    if totals:
        out = out.withColumn(
            "cnt",
            F.col("_ks_lcnt") + when_(is_first, "_ks_off", "bigint") + when_(is_last, "_ks_aft", "bigint"),
        )
        for c in sums:
            out = out.withColumn(
                f"tot_{c}",
                (F.col(f"_ks_lt_{c}") + when_(is_first, f"_ks_off_{c}", sum_type[c])
                 + when_(is_last, f"_ks_aft_{c}", sum_type[c])).cast(sum_type[c]),
            )
    keep = list(df.columns) + [rn] + [f"run_{c}" for c in sums]
    if totals:
        keep += ["cnt"] + [f"tot_{c}" for c in sums]
    return out.select(*keep)


def next_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                out: str = "next_value") -> DataFrame:
    """Pair every row with the ``value`` of the following row of its key; the
    last row of each key has no successor and is dropped (W2).

    The self-join is on ``(keys, rn)``, which is nearly unique, so hashing it
    spreads a hot key over all partitions.
    """
    scanned = keyed_scan(df, keys, order)
    nxt = scanned.select(
        *[F.col(k).alias(f"_nx_{k}") for k in keys], (F.col("rn") - 1).alias("_nx_rn"), F.col(value).alias(out))
    cond = F.col("rn") == F.col("_nx_rn")
    for k in keys:  # rows with a null key follow each other too
        cond = cond & F.col(k).eqNullSafe(F.col(f"_nx_{k}"))
    return scanned.join(nxt, cond, "inner").drop("_nx_rn", *[f"_nx_{k}" for k in keys])
