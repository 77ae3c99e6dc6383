"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by a 62-bit key and cut into shards of nearly equal bytes.
The cuts (splitters) are found by counting, not by sampling:

1. count exact bytes and rows below equally spaced probes of the key space;
2. where no probe lies within the tolerance of a wanted cut, put new probes
   into the one cell that holds the cut and count there again;
3. when every cut is settled, send each row once to its bucket
   (``repartitionById``) and number the rows there in key order.

The driver holds counts between probes only: at most ``2**bits`` cells plus
``2**refine_bits`` for each open cut and pass. A pass reads the key and size
columns. A shard may be made by several tasks (``rows_per_task``), so a task's
share doesn't grow with the table; slots stay gapless because the counts below
every cut are exact.

The default key is 31 bits of the text's hash followed by 31 bits of the id's:
equal texts lie side by side, and a group of copies that is larger than a
shard is divided in id order.

Defined results: a null text has no bytes and the checksum 0; a null id is one
id value among others; rows equal in text and id share a key and so a shard,
and take neighbouring slots; an empty table gives an empty result. Input
columns named like an output column are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._text import without

KEY_BITS = 62


def text_key(text: Column, row_id: Column) -> Column:
    """62-bit key: 31 bits of the text's hash, then 31 bits of the id's."""
    low = F.lit(0x7FFFFFFF)
    return F.shiftleft(F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(low), 31).bitwiseOR(
        F.xxhash64(row_id).bitwiseAND(low)
    )


class _Cells:
    """Counted cells of the key space, in key order."""

    def __init__(self, lo, shift, size, rows):
        order = np.argsort(lo)
        self.lo, self.shift, self.size, self.rows = (np.asarray(x)[order] for x in (lo, shift, size, rows))

    def cuts(self, targets: np.ndarray, slack: np.ndarray):
        """For each target the nearest cell edge: key, bytes and rows below it;
        and the cells that must be divided to come closer."""
        below = np.concatenate([[0], np.cumsum(self.size)])
        rows = np.concatenate([[0], np.cumsum(self.rows)])
        key = np.append(self.lo, self.lo[-1] + (1 << int(self.shift[-1])))
        cell = np.clip(np.searchsorted(below, targets, "right") - 1, 0, len(self.lo) - 1)
        right = targets - below[cell] > below[cell + 1] - targets
        edge = cell + right
        off = np.abs(below[edge] - targets)
        todo = np.unique(cell[(off > slack) & (self.shift[cell] > 0)])
        return key[edge], rows[edge], todo

    def divided(self, todo, counted, bits):
        keep = np.ones(len(self.lo), bool)
        keep[todo] = False
        cols = [list(x[keep]) for x in (self.lo, self.shift, self.size, self.rows)]
        for lo, size, rows, shift in counted:
            for c, v in zip(cols, (lo, shift, size, rows)):
                c.append(v)
        return _Cells(*cols)


def splitters(df: DataFrame, n_cuts_of, bits: int = 12, refine_bits: int = 8):
    """Settle cuts of ``df(_key, _size)``. ``n_cuts_of(rows, bytes)`` returns
    the targets (bytes below each cut) and how far a cut may be off. Returns
    the keys and the rows below each cut, or None for an empty table."""
    spark = df.sparkSession
    top = KEY_BITS - bits
    first = (
        df.groupBy(F.shiftright("_key", top).alias("c"))
        .agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )  # at most 2**bits rows
    if not first:
        return None
    cells = _Cells([r.c << top for r in first], [top] * len(first), [r["size"] for r in first], [r["rows"] for r in first])
    targets, slack = n_cuts_of(int(cells.rows.sum()), int(cells.size.sum()))
    while True:
        keys, rows, todo = cells.cuts(targets, slack)
        if not len(todo):
            return keys, rows
        parts = []
        for i in todo:
            lo, shift = int(cells.lo[i]), int(cells.shift[i])
            parts.append((lo >> top, lo, lo + (1 << shift) - 1, max(0, shift - refine_bits)))
        open_cells = F.broadcast(spark.createDataFrame(parts, "c long, lo long, hi long, sub int"))
        counted = (
            df.withColumn("c", F.shiftright("_key", top))
            .join(open_cells, "c")
            .where(F.col("_key").between(F.col("lo"), F.col("hi")))
            .groupBy("lo", "sub", F.expr("shiftright(_key - lo, sub)").alias("k"))
            .agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows"))
            .collect()
        )  # at most 2**refine_bits rows for each open cut
        cells = cells.divided(
            todo, [(r.lo + (r.k << r["sub"]), r["size"], r["rows"], r["sub"]) for r in counted], refine_bits
        )


def histogram_shards(
    df: DataFrame,
    shards: int,
    key: Column,
    size: Column,
    *,
    order: tuple[str, ...] = (),
    tolerance: float = 0.001,
    rows_per_task: int = 2_000_000,
    max_tasks: int = 4096,
    bits: int = 12,
) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in the
    shard, in key order; ``order`` breaks ties). Each cut is within
    ``tolerance`` of a shard's bytes, or as near as whole keys allow. ``key``
    is a long in [0, 2**62), ``size`` a non-negative long."""
    spark = df.sparkSession
    rows_in = without(df.withColumns({"_key": key, "_size": size}), ["shard", "slot"])
    split = [1]

    def wanted(n_rows, n_bytes):
        split[0] = m = max(1, min(max_tasks // shards, math.ceil(n_rows / (shards * rows_per_task))))
        j = np.arange(1, shards * m)
        per_shard = n_bytes / shards
        return j * (n_bytes / (shards * m)), np.where(j % m == 0, tolerance * per_shard, 0.25 * per_shard / m)

    found = splitters(rows_in.select("_key", "_size"), wanted, bits)
    if found is None:
        return rows_in.drop("_key", "_size").withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).limit(0)
    keys, below = found
    m, n = split[0], shards * split[0]
    keys, below = [int(k) for k in keys], [0, *(int(b) for b in below)]
    top = KEY_BITS - bits
    edges = np.arange(1 << bits, dtype=object) << top
    base = np.searchsorted(np.array(keys, dtype=object), edges, "right") if keys else np.zeros(1 << bits, int)
    last = [*base[1:], len(keys)]
    lookup = [(c, int(base[c]), keys[base[c] : last[c]]) for c in range(1 << bits)]
    cells = F.broadcast(spark.createDataFrame(lookup, "_c long, _base int, _inner array<long>"))
    starts = [(b, b // m, below[b] - below[b // m * m]) for b in range(n)]
    buckets = F.broadcast(spark.createDataFrame(starts, "_bucket int, shard int, _before long"))
    routed = (
        rows_in.withColumn("_c", F.shiftright("_key", top))
        .join(cells, "_c")
        .withColumn("_bucket", F.col("_base") + F.expr("size(filter(_inner, x -> x <= _key))"))
        .join(buckets, "_bucket")
        .drop("_c", "_base", "_inner")
    )
    local = Window.partitionBy("_bucket").orderBy("_key", *order)
    return (
        routed.repartitionById(n, F.col("_bucket"))
        .withColumn("slot", F.col("_before") + F.row_number().over(local) - 1)
        .drop("_bucket", "_before", "_key", "_size")
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The ``documents`` table in shards of nearly equal bytes (law ``bytes``):
    doc_id, size, text_crc32, law, shard, slot, grown_shard (null)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key(F.col("text"), F.col("doc_id")).alias("sort_key"),
    )
    out = histogram_shards(narrow, shards, F.col("sort_key"), F.col("size"), order=("doc_id", "text_crc32"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
