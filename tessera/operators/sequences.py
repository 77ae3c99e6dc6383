"""Sequence operators (W2, R3, K3 batch twin).

A whole per-key sequence is never gathered into one row or task:

* ``conforms`` runs a finite state machine over each key's ordered symbols by
  a tree reduction of transition *functions* (arrays indexed by state). Each
  round groups ``fan_in`` consecutive segments of a key (a bounded
  ``collect_list``) and composes them, so a hot key is spread over
  ``n / fan_in`` groups and the data shrinks ``fan_in``-fold per round.
* ``throttle`` (cool-down) finds, for every row, the first row of its key at
  least ``gap`` later (``next``), then follows ``next`` from the first row by
  pointer doubling: ``log2(chain length)`` rounds of joins on ``(key, rn)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import keyed_scan


def next_symbol(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                out: str = "next_value") -> DataFrame:
    """(value, next value) pairs along each key; the last row is dropped."""
    from tessera.operators.ordered import next_in_key

    return next_in_key(df, keys, order, value, out)


def _machine_arrays(transitions: dict, states: list, symbols: list):
    """Per symbol: next-state index for every state index (dead = last)."""
    dead = len(states)
    idx = {s: i for i, s in enumerate(states)}
    table = {}
    for sym in symbols:
        row = []
        for s in states:
            nxt = transitions.get((s, sym))
            row.append(idx[nxt] if nxt is not None else dead)
        row.append(dead)
        table[sym] = row
    return table, dead


def conforms(df: DataFrame, keys: Sequence[str], order: Sequence[str], symbol: str,
             transitions: dict, start, accept: Sequence | None = None,
             fan_in: int = 32) -> DataFrame:
    """Does each key's symbol sequence follow the machine?

    ``transitions`` maps ``(state, symbol) -> state``; a missing pair goes to
    a dead state. Returns per key: ``n`` symbols, ``steps_ok`` (symbols read
    before the machine died), ``final_state`` (null when dead), ``prefix_ok``
    (never died: the reference's rule, every prefix accepted) and, when
    ``accept`` is given, ``complete_ok`` (never died and ended in ``accept``).
    """
    keys = list(keys)
    states = sorted({s for s, _ in transitions} | set(transitions.values()) | {start}, key=str)
    symbols = sorted({c for _, c in transitions}, key=str)
    table, dead = _machine_arrays(transitions, states, symbols)
    ns = dead + 1
    kv = []
    for sym, row in table.items():
        kv += [F.lit(sym), F.array(*[F.lit(x) for x in row])]
    sym_map = F.create_map(*kv)
    dead_row = F.array(*[F.lit(dead) for _ in range(ns)])
    s = keyed_scan(df.select(*keys, *order, symbol), keys, order)
    f0 = F.coalesce(F.element_at(sym_map, F.col(symbol)), dead_row)
    seg = s.select(
        *keys, (F.col("rn") - 1).alias("seg"),
        f0.alias("f"),
    )
    # d[s]: symbols read before dying when the segment is entered in state s
    seg = seg.withColumn(
        "d", F.transform("f", lambda x: F.when(x == dead, 0).otherwise(1).cast("long"))).withColumn(
        "len", F.lit(1).cast("long"))
    max_len = s.agg(F.max("rn")).first()[0] or 0
    rounds = 0 if max_len <= 1 else math.ceil(math.log(max_len, fan_in))
    ident = F.struct(
        F.sequence(F.lit(0), F.lit(ns - 1)).alias("f"),
        F.array(*[F.lit(0).cast("long") for _ in range(ns)]).alias("d"),
        F.lit(0).cast("long").alias("len"),
    )
    spark = df.sparkSession
    for r in range(rounds):
        grouped = seg.groupBy(*keys, F.floor(F.col("seg") / fan_in).alias("_g")).agg(
            F.array_sort(F.collect_list(F.struct("seg", "f", "d", "len"))).alias("_parts"))

        def merge(acc, x):
            f_new = F.transform(acc["f"], lambda st: F.element_at(x["f"], st + 1))
            d_new = F.transform(
                F.sequence(F.lit(0), F.lit(ns - 1)),
                lambda st: F.when(F.element_at(acc["d"], st + 1) < acc["len"],
                                  F.element_at(acc["d"], st + 1)).otherwise(
                    acc["len"] + F.element_at(x["d"], F.element_at(acc["f"], st + 1) + 1)))
            return F.struct(f_new.alias("f"), d_new.alias("d"), (acc["len"] + x["len"]).alias("len"))

        seg = grouped.select(*keys, F.col("_g").alias("seg"),
                             F.aggregate("_parts", ident, merge).alias("_m")).select(
            *keys, "seg", "_m.f", "_m.d", "_m.len")
        if r % 4 == 3 and spark.sparkContext.getCheckpointDir():
            seg = seg.checkpoint(eager=True)
    si = F.lit(states.index(start) + 1)
    out = seg.select(
        *keys, F.col("len").alias("n"),
        F.element_at("d", si).cast("long").alias("steps_ok"),
        F.element_at("f", si).alias("_fs"),
    )
    names = F.array(*[F.lit(str(x)) for x in states])
    out = out.withColumn("prefix_ok", F.col("steps_ok") == F.col("n")).withColumn(
        "final_state", F.when(F.col("_fs") == dead, F.lit(None).cast("string")).otherwise(
            F.element_at(names, F.col("_fs") + 1)))
    if accept is not None:
        acc_idx = [states.index(a) for a in accept]
        out = out.withColumn("complete_ok", F.col("prefix_ok") & F.col("_fs").isin(acc_idx))
    return out.drop("_fs")


def throttle(df: DataFrame, keys: Sequence[str], ts: str, id_col: str,
             gap_seconds: int) -> DataFrame:
    """K3 batch twin: per key, accept the first row, then the first row at
    least ``gap_seconds`` after the last accepted one, and so on.

    Returns the accepted rows of ``df``. Rows are ordered by ``(ts, id)``."""
    columns = df.columns
    # keys in a form in which nulls are equal
    df = df.withColumns(
        {f"_kv{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)}
        | {f"_kn{i}": F.col(k).isNull() for i, k in enumerate(keys)})
    keys = [f"_k{c}{i}" for i in range(len(keys)) for c in "vn"]
    base = df.select(*keys, ts, id_col)
    s = keyed_scan(base, keys, [ts, id_col], totals=True)
    gap = F.expr(f"INTERVAL {int(gap_seconds)} SECONDS")
    # probes at ts + gap sort before real rows with the same time, so the
    # running count of real rows at a probe is the number strictly earlier
    real = s.select(*keys, F.col(ts).alias("_t"), F.lit(1).alias("_real"),
                    F.col("rn").alias("_tb"), F.col("cnt"))
    probe = s.select(*keys, (F.col(ts) + gap).alias("_t"), F.lit(0).alias("_real"),
                     F.col("rn").alias("_tb"), F.col("cnt"))
    sc = keyed_scan(real.unionByName(probe), keys, ["_t", "_real", "_tb"], sums=["_real"])
    nxt = sc.where(F.col("_real") == 0).select(
        *keys, F.col("_tb").alias("rn"),
        F.when(F.col("run__real") + 1 <= F.col("cnt"), F.col("run__real") + 1).alias("j"))
    # a chain holds at most span/gap + 1 rows of a key (and at most all of
    # them): this bounds the doubling rounds without a check per round
    # (time-zone free: timestamp_diff on the column's own type; +1 margin)
    span = s.groupBy(*keys).agg(
        F.timestamp_diff("SECOND", F.min(ts), F.max(ts)).alias("_span"),
        F.max("cnt").alias("_cnt"))
    bound = span.agg(F.max("_span"), F.max("_cnt")).first()
    max_chain = min(int((bound[0] or 0) // gap_seconds) + 2, int(bound[1] or 0))
    rounds = 0 if max_chain <= 1 else math.ceil(math.log2(max_chain))
    jump = nxt.checkpoint(eager=True)
    acc = s.where(F.col("rn") == 1).select(*keys, "rn")
    for r in range(rounds):
        # chain positions [2^k, 2^(k+1)) are one jump of size 2^k from [0, 2^k)
        new = acc.join(jump, keys + ["rn"]).where(F.col("j").isNotNull()).select(
            *keys, F.col("j").alias("rn"))
        acc = acc.unionByName(new).checkpoint(eager=True)
        if r == rounds - 1:
            break
        a = jump.alias("a")
        b = jump.alias("b")
        cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.col("a.j") == F.col("b.rn")]
        jump = a.join(b, cond, "left").select(
            *[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.rn").alias("rn"),
            F.col("b.j").alias("j")).checkpoint(eager=True)
    picked = s.join(acc, keys + ["rn"], "left_semi")
    return df.join(picked.select(*keys, id_col), keys + [id_col], "left_semi").select(*columns)
