"""Jaccard similarity join on word shingles by universe partitioning.

Two documents link when the Jaccard similarity of their shingle sets reaches
``percent``. Sets r and s that link differ in at most H(r, s) =
(100-percent)/(100+percent) * (|r|+|s|) shingles. The universe of shingles is
hashed into m segments, with another m for each band of set sizes (a band spans
a factor of two): at most H segments differ, so by the pigeonhole principle
linked sets agree on all but H of their non-empty segments.

* Signatures. A set's non-empty segments, each with its content, are ordered
  by a global order, and only the first H(r)+1 are indexed: two ordered sets of
  segments that differ in at most H share one of them. Any order gives right
  results; the cost-based order puts segments last whose content is frequent in
  a sample of the sets, so common passages are indexed only where a set has
  nothing rarer.
* Neighbourhoods. Sets so small that one difference is all they can have are
  cheaper to cover by one segment, the whole set, and its one-deletion
  neighbourhood.
* Rest. Where both sets have too few non-empty segments for the pigeonhole
  argument, single shingles serve as segments (also only as many as needed).

A set belongs to its own band and, if it can link with smaller ones, to the
band below. Signatures are exchanged in blocks; a signature shared by many sets
in one task sends a few of them on, so its group doesn't grow with the table.
Sets that share a signature are compared only while they lie in different
components: first each set with the one partner it shares most signatures
with, then with the partner in another component that looks nearest, and at
last all pairs that are still apart; components are joined in between. A pair is verified in two steps: the parities of a fine
partition of the universe (two bits a shingle) differ in no more places than
the sets do, which drops most pairs that don't link, and the sets themselves
are compared for the others.

Exact copies (equal sets) are merged before, by a 128-bit digest.

Defined results: a null or empty text, or one without words, has no shingles
and links with nothing; a row with null doc_id takes no part and has a null
component; rows that share a doc_id are one node (links of both count); an
empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._text import IS_WORD, LOWER, arrow_map, hash_spans, mix, release_memory, spans, text_slices

SHINGLE = 5
PERCENT = 75
SALTS = 32
SLICE = 1 << 20
U = np.uint64
_C = np.random.default_rng(77).integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their bounds."""
    data = LOWER[data]
    starts, ends, doc = spans(IS_WORD[data], offs)
    n_docs = len(offs) - 1
    words = hash_spans(data, starts, ends)
    per_doc = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(per_doc)])
    raw_n = np.where(per_doc >= k, per_doc - k + 1, per_doc > 0)
    raw_at = np.concatenate([[0], np.cumsum(raw_n)])
    raw = np.empty(raw_at[-1], np.uint64)
    if len(words) >= k:
        at = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :])
        h = np.zeros(len(at), np.uint64)
        for j in range(k):
            h += words[at + j] * _C[j]
        raw[raw_at[doc[at]] + at - first[doc[at]]] = mix(h)
    for d in np.flatnonzero((per_doc > 0) & (per_doc < k)):
        own = words[first[d] : first[d + 1]]
        raw[raw_at[d]] = mix((own * _C[: len(own)]).sum(keepdims=True) + _C[k + len(own)])[0]
    for a, b in zip(raw_at[:-1].tolist(), raw_at[1:].tolist()):
        raw[a:b].sort()
    keep = np.ones(len(raw), bool)
    keep[1:] = raw[1:] != raw[:-1]
    keep[raw_at[:-1][raw_n > 0]] = True
    bounds = np.concatenate([[0], np.cumsum(keep)])[raw_at]
    return raw[keep], bounds


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_digests(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    return tuple(mix(_sums(mix(tokens ^ _C[40 + i]), bounds) + np.diff(bounds).astype(np.uint64) * _C[42 + i]) for i in (0, 1))


class Partition:
    """The signature scheme for one similarity."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        n = 1
        while self.most_errors(np.array([n + 1]))[0] <= 1:
            n += 1
        self.tiny = n  # sets up to this size can have one difference at most

    def largest(self, n):
        return 100 * n // self.percent

    def smallest(self, n):
        return -(-self.percent * n // 100)

    def errors(self, a, b):
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def most_errors(self, n):
        return self.errors(n, self.largest(n))

    def band(self, n):
        """0 for tiny sets, then 1, 2, ... for [L, 2L), [2L, 4L), ... with L = tiny + 1."""
        return np.where(n <= self.tiny, 0, np.floor(np.log2(np.maximum(n, 1) / (self.tiny + 1))).astype(np.int64) + 1)

    def signatures(self, tokens: np.ndarray, bounds: np.ndarray, popular: np.ndarray):
        """(signature, row) of each set. ``popular``: frequent shingles,
        ascending; segments of nothing else are used last."""
        n = np.diff(bounds)
        own = self.band(n)
        out_sig, out_row = [], []

        def emit(sig, row):
            out_sig.append(sig)
            out_row.append(row)

        spread = mix(tokens ^ _C[50])
        frequent = np.zeros(len(tokens), bool)
        if len(popular):
            frequent = popular[np.minimum(np.searchsorted(popular, tokens), len(popular) - 1)] == tokens
        row_of = np.repeat(np.arange(len(n)), n)
        whole = _sums(spread, bounds)
        near = np.flatnonzero((n > 0) & (self.smallest(n) <= self.tiny))
        if len(near):
            emit(mix(whole[near] + _C[51]), near)
            member = np.isin(row_of, near) & (n[row_of] > 1)
            emit(mix(whole[row_of[member]] - spread[member] + _C[51]), row_of[member])
        top = int(own.max(initial=0))
        for b in range(1, top + 1):
            low = (self.tiny + 1) << (b - 1)
            rows = np.flatnonzero((own == b) | ((own > b) & (self.smallest(n) < 2 * low)))
            if not len(rows):
                continue
            sizes = n[rows]
            errors = np.where(own[rows] == b, self.most_errors(sizes), self.errors(sizes, np.minimum(2 * low - 1, self.largest(sizes))))
            at = np.repeat(bounds[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            t, owner = tokens[at], np.repeat(np.arange(len(rows)), sizes)
            segment = ((t >> U(32)) * U(low)) >> U(32)  # low segments; tokens are in order, so segments are runs
            new = np.ones(len(t), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (owner[1:] != owner[:-1])
            heads = np.flatnonzero(new)
            content = np.add.reduceat(spread[at], heads) if len(heads) else np.zeros(0, np.uint64)
            sig = mix(content + (segment[heads] + U(b << 40)) * _C[52]) >> U(1)
            seg_owner = owner[heads]
            count = np.bincount(seg_owner, minlength=len(rows))
            edge = np.concatenate([[0], np.cumsum(count)])
            order = sig
            if len(heads):
                order = sig | np.logical_and.reduceat(frequent[at], heads).astype(np.uint64) << U(63)
            take = np.minimum(count, errors + 1)
            for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
                order[a:z].sort()
            pick = np.repeat(edge[:-1] - np.concatenate([[0], np.cumsum(take)[:-1]]), take) + np.arange(take.sum())
            emit(order[pick] & U((1 << 63) - 1), rows[np.repeat(np.arange(len(rows)), take)])
            few = np.flatnonzero(count <= errors)  # single shingles as segments
            if len(few):
                need = sizes[few] - self.smallest(sizes[few]) + 1
                begin = bounds[rows[few]]
                pick = np.repeat(begin - np.concatenate([[0], np.cumsum(need)[:-1]]), need) + np.arange(need.sum())
                emit(mix(tokens[pick] + U(b * int(_C[53]) % 2**64)) >> U(1), rows[np.repeat(few, need)])
        if not out_sig:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(out_sig) & U((1 << 63) - 1), np.concatenate(out_row)


def _ids(batch: pa.RecordBatch, start: int, stop: int) -> np.ndarray:
    return batch.column(0).slice(start, stop - start).to_numpy(zero_copy_only=False).astype(np.int64)


def describe(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, parity): size and digests of each row's set."""

    def run(batches):
        for batch in batches:
            for start, stop, data, offs in text_slices(batch, "text", SLICE):
                tokens, bounds = shingle_sets(data, offs, k)
                d1, d2 = set_digests(tokens, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(np.diff(bounds)), pa.array(d1.view(np.int64)),
                     pa.array(d2.view(np.int64)), pa.array(parities(tokens, bounds), pa.binary())],
                    names=["doc_id", "n_shingles", "d1", "d2", "parity"],
                )

    return arrow_map(docs, run, "doc_id long, n_shingles long, d1 long, d2 long, parity binary")


def token_sets(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, tokens): each row's shingle hashes."""

    def run(batches):
        for batch in batches:
            for start, stop, data, offs in text_slices(batch, "text", SLICE):
                tokens, bounds = shingle_sets(data, offs, k)
                arrays = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), arrays], names=["doc_id", "tokens"])

    return arrow_map(docs, run, "doc_id long, tokens array<long>")


def popular_shingles(docs: DataFrame, k: int, one_in: int, least: int, most: int) -> np.ndarray:
    """Shingles frequent among the different sets of a fixed sample of the
    documents, ascending. They only steer cost, so their number is bounded."""

    def run(batches):
        for batch in batches:
            for _, _, data, offs in text_slices(batch, "text", SLICE):
                tokens, bounds = shingle_sets(data, offs, k)
                owner = np.repeat((set_digests(tokens, bounds)[0] >> U(33)).astype(np.int32), np.diff(bounds))
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(owner)], names=["t", "d"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(one_in)) == 0)
    found = (
        arrow_map(sample, run, "t long, d int").groupBy("t")
        .agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"))
        .where((F.col("n") >= least) & (F.col("lo") < F.col("hi"))).orderBy(F.desc("n"), "t").limit(most).select("t").collect()
    )  # fmt: skip  at most `most` numbers
    return np.sort(np.array([r.t for r in found], np.int64).view(np.uint64))


def parities(tokens: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each set, the parity of its shingles in each of 2**j segments, about
    two a shingle, as bits. The segments of a small partition are unions of
    those of a larger one: halves of the bits are folded by exclusive or."""
    n = np.diff(bounds)
    bits = np.maximum(6, np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(1 << bits)])
    mask = np.repeat((1 << bits) - 1, n).astype(np.uint64)
    spot = np.repeat(at[:-1], n) + (mix(tokens ^ _C[55]) & mask).astype(np.int64)
    odd = (np.bincount(spot, minlength=at[-1]) & 1).astype(bool)
    packed = np.packbits(odd, bitorder="little").tobytes()
    return [packed[a // 8 : z // 8] for a, z in zip(at[:-1].tolist(), at[1:].tolist())]


def parity_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles in which two sets differ."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


BLOCK_SCHEMA = "bucket long, sigs binary, ids binary, hot binary"
FOUND_SCHEMA = "kind int, x long, y long, n long"
MEMBER, PAIR, HINT = 0, 1, 2


def signature_blocks(
    docs: DataFrame, scheme: Partition, popular, buckets: int, k: int = SHINGLE, chunk: int = 500_000, few: int = 8
) -> DataFrame:
    """Signatures of every set in blocks of one bucket each (``BLOCK_SCHEMA``).

    ``popular`` is a broadcast variable of bounded size. In a chunk of a task,
    at most ``few`` sets of a signature go to its bucket; the others go apart
    (negative buckets) as (full signature, first set, set)."""

    def blocks(sig, ids, part, chunk_no):
        order = np.lexsort((ids, sig))
        sig, ids = sig[order], ids[order]
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        again = ~new
        again[1:] &= ids[1:] == ids[:-1]
        sig, ids = sig[~again], ids[~again]
        new = new[~again]
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        rank = np.arange(len(sig)) - heads[group]
        hot = np.diff(np.append(heads, len(sig)))[group] > few
        extra = rank >= few
        rows = []
        if extra.any():
            triple = np.stack([sig[extra].view(np.int64), ids[heads[group[extra]]], ids[extra]])
            rows.append((-1 - (part * 1_000_003 + chunk_no), triple[0].tobytes(), triple[1].tobytes(), triple[2].tobytes()))
        sig, ids, hot = sig[~extra], ids[~extra], hot[~extra]
        bucket = ((sig >> U(31)) * U(buckets)) >> U(32)
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            a, z = edges[b], edges[b + 1]
            own = ids[a:z]
            base = own.min()
            small = int(own.max()) - int(base) < 1 << 32
            packed = (own - base).astype(np.uint32) if small else own
            marks = np.flatnonzero(hot[a:z]).astype(np.uint32)
            # the bucket fixes the upper bits; of the others 32 are kept, and what they confuse is verified away
            rows.append((b, sig[a:z].astype(np.uint32).tobytes(), base.tobytes() + packed.tobytes(), _hot_bytes(marks, sig[a:z])))
        cols = list(zip(*rows))
        types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["bucket", "sigs", "ids", "hot"])

    def run(batches):
        from pyspark import TaskContext

        part, chunk_no, seen = TaskContext.get().partitionId(), 0, set()
        frequent = popular.value
        sigs, ids, held = [], [], 0
        for batch in batches:
            for start, stop, data, offs in text_slices(batch, "text", SLICE):
                tokens, bounds = shingle_sets(data, offs, k)
                own = _ids(batch, start, stop)
                digests = list(zip(*(d.tolist() for d in set_digests(tokens, bounds))))
                fresh = np.zeros(len(own), bool)
                for i, d in enumerate(digests):  # an exact copy in the same task adds nothing
                    if d not in seen:
                        seen.add(d)
                        fresh[i] = True
                if not fresh.all():
                    n = np.where(fresh, np.diff(bounds), 0)
                    tokens = tokens[np.repeat(fresh, np.diff(bounds))]
                    bounds = np.concatenate([[0], np.cumsum(n)])
                sig, row = scheme.signatures(tokens, bounds, frequent)
                sigs.append(sig)
                ids.append(own[row])
                held += len(sig)
                if held >= chunk:
                    yield blocks(np.concatenate(sigs), np.concatenate(ids), part, chunk_no)
                    sigs, ids, held, chunk_no = [], [], 0, chunk_no + 1
        if held:
            yield blocks(np.concatenate(sigs), np.concatenate(ids), part, chunk_no)

    return arrow_map(docs, run, BLOCK_SCHEMA)


def _hot_bytes(marks: np.ndarray, sig: np.ndarray) -> bytes:
    """Places and full signatures of entries whose signature is hot."""
    return marks.tobytes() + sig[marks].tobytes() if len(marks) else b""


def shared_signatures(blocks: DataFrame) -> DataFrame:
    """``FOUND_SCHEMA``: PAIR (x, y, signatures) of two sets that are alone
    under a signature; where more sets share one, MEMBER (number of the group,
    set), and as a HINT for each set its best partner among the groups' first
    sets. Groups of equal members have one number."""

    def table(*parts):
        kind = np.concatenate([np.full(len(rows), k, np.int32) for k, rows, _ in parts])
        rows = np.concatenate([rows for _, rows, _ in parts])
        n = np.concatenate([n for _, _, n in parts])
        return pa.table([pa.array(kind), pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(n)], names=["kind", "x", "y", "n"])

    def best(x, y):
        """For each y the x that it meets most often, and how often."""
        rows, n = np.unique(np.stack([y, x], 1), axis=0, return_counts=True)
        order = np.lexsort((rows[:, 1], -n, rows[:, 0]))
        rows, n = rows[order], n[order]
        head = np.ones(len(rows), bool)
        head[1:] = rows[1:, 0] != rows[:-1, 0]
        return rows[head][:, ::-1], n[head]

    def run(group: pa.Table) -> pa.Table:
        release_memory()
        cols = [c.to_pylist() for c in (group["bucket"], group["sigs"], group["ids"], group["hot"])]
        if cols[0][0] < 0:
            sig, first, other = (np.concatenate([np.frombuffer(x, np.int64) for x in col]) for col in cols[1:])
            members = np.unique(np.concatenate([np.stack([sig, first], 1), np.stack([sig, other], 1)]), axis=0)
            return table((MEMBER, members, np.ones(len(members), np.int64)), (HINT, *best(first, other)))
        sigs, ids, hot = [], [], []
        for s, i, h in zip(*cols[1:]):
            s = np.frombuffer(s, np.uint32)
            base, packed = np.frombuffer(i[:8], np.int64)[0], i[8:]
            small = len(packed) == 4 * len(s)
            ids.append(np.frombuffer(packed, np.uint32 if small else np.int64).astype(np.int64) + (base if small else 0))
            full = np.zeros(len(s), np.int64)
            if h:
                n = len(h) // 12
                full[np.frombuffer(h[: 4 * n], np.uint32)] = np.frombuffer(h[4 * n :], np.int64)
            sigs.append(s)
            hot.append(full)
        sig, ids, hot = np.concatenate(sigs), np.concatenate(ids), np.concatenate(hot)
        order = np.argsort(sig, kind="stable")
        s = sig[order]
        same = s[1:] == s[:-1]
        shared = np.zeros(len(s), bool)
        shared[1:] |= same
        shared[:-1] |= same
        order = order[shared]
        sig, ids, hot = sig[order], ids[order], hot[order]
        order = np.lexsort((-hot, ids, sig))  # a repeated (signature, id) is one member, hot if one of them is
        sig, ids, hot = sig[order], ids[order], hot[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
        sig, ids, hot = sig[new], ids[new], hot[new]
        head = np.ones(len(sig), bool)
        head[1:] = sig[1:] != sig[:-1]
        heads = np.flatnonzero(head)
        none = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        if not len(heads):
            return table((PAIR, *none))
        group_no = np.cumsum(head) - 1
        size = np.diff(np.append(heads, len(sig)))
        full = np.maximum.reduceat(hot, heads)
        number = np.add.reduceat(mix(ids.view(np.uint64) ^ _C[60]), heads)
        number = np.where(full != 0, full, (mix(number) >> U(1)).view(np.int64) | np.int64(-(2**63)))
        first = ids[heads][group_no]
        many = ((size >= 3) | (full != 0))[group_no]
        pairs, n = np.unique(np.stack([first[~many & ~head], ids[~many & ~head]], 1), axis=0, return_counts=True)
        members = np.unique(np.stack([number[group_no][many], ids[many]], 1), axis=0)
        star = many & ~head
        return table(
            (PAIR, pairs, n), (MEMBER, members, np.ones(len(members), np.int64)),
            (HINT, *(best(first[star], ids[star]) if star.any() else none)),
        )

    return blocks.groupBy("bucket").applyInArrow(run, FOUND_SCHEMA)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``: the smallest node
    reachable. Labels spread along links and jump along labels until nothing
    changes; each round is checkpointed."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct().checkpoint(eager=True)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near"))
        step = labels.join(near, "node").select("node", "component", F.least("component", "_near").alias("_low"))
        jump = labels.select(F.col("node").alias("_low"), F.col("component").alias("_far"))
        step = step.join(jump, "_low").select(
            "node", F.least("_low", "_far").alias("component"), (F.least("_low", "_far") != F.col("component")).alias("_moved")
        ).checkpoint(eager=True)
        labels = step.select("node", "component")
        if step.where("_moved").isEmpty():
            return labels


def near_pairs(pairs: DataFrame, sets: DataFrame, scheme: Partition) -> DataFrame:
    """Those of ``pairs(a, b)`` that sizes and parities allow to link; ``sets``
    has doc_id, n_shingles and parity, one row for each id."""

    def run(batches):
        for batch in batches:
            a, b, na, nb, pa_, pb = (batch.column(i) for i in range(6))
            na, nb = na.to_numpy(), nb.to_numpy()
            most = scheme.errors(na, nb)
            ok = 100 * np.minimum(na, nb) >= scheme.percent * np.maximum(na, nb)
            for i in np.flatnonzero(ok):
                ok[i] = parity_distance(pa_[i].as_buffer(), pb[i].as_buffer()) <= most[i]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(ok))

    one = sets.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("parity").alias("pa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("parity").alias("pb"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")


def cross_pairs(members: DataFrame, sets: DataFrame, scheme: Partition, nearest_only: bool, block: int = 2048, bucket_rows: int = 50_000) -> DataFrame:
    """Pairs (a, b) of different components under one number in
    ``members(g, node, component)`` that sizes and parities allow to link.

    Members are compared in tiles of two blocks of at most about ``block``
    members, so a large group is many small pieces of work; many tiles share a
    task. Only the pairs that pass leave a tile; with ``nearest_only``, for each
    set only the one with the nearest parities."""

    def tile(a, b, nodes, parts, n, bits):
        """Index pairs of a tile whose sets may link."""
        words = min(len(x) for x in bits) // 8
        m = np.zeros((len(bits), words), np.uint64)
        for r, x in enumerate(bits):
            x = np.frombuffer(x, np.uint64)
            while len(x) > words:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            m[r] = x
        step = max(1, (1 << 20) // max(1, len(bits) * words))
        for s in range(0, len(bits), step):
            mine = slice(s, s + step)
            ok = (parts[mine, None] != parts[None]) & (nodes[mine, None] < nodes[None])
            ok &= (a[mine, None] != b) if b is not None else True
            ok &= 100 * np.minimum(n[mine, None], n[None]) >= scheme.percent * np.maximum(n[mine, None], n[None])
            x, y = np.nonzero(ok)
            if len(x):
                far = np.bitwise_count(m[mine][x] ^ m[y]).sum(axis=1)
                near = far <= scheme.errors(n[mine][x], n[y])
                yield nodes[mine][x[near]], nodes[y[near]], far[near]

    def run(group: pa.Table) -> pa.Table:
        g, i, j, b, node, part, n = (group[c].to_numpy() for c in ("g", "i", "j", "b", "node", "component", "n_shingles"))
        order = np.lexsort((j, i, g))
        g, i, j, b, node, part, n = (x[order] for x in (g, i, j, b, node, part, n))
        parity = group["parity"].combine_chunks()
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        found = [np.zeros((0, 3), np.int64)]
        heads = np.append(np.flatnonzero(new), len(g))
        for s, e in zip(heads[:-1], heads[1:]):
            bits = [parity[int(r)].as_buffer() for r in order[s:e]]
            for x, y, far in tile(b[s:e], b[s:e] if i[s] != j[s] else None, node[s:e], part[s:e], n[s:e], bits):
                rows = np.stack([x, y, far.astype(np.int64)], 1)
                if nearest_only:
                    by = np.lexsort((x, far, y))
                    rows = rows[by][np.concatenate([[True], y[by][1:] != y[by][:-1]])] if len(y) else rows
                found.append(rows)
        pairs = np.unique(np.concatenate(found), axis=0)
        if nearest_only and len(pairs):
            pairs = pairs[np.lexsort((pairs[:, 0], pairs[:, 2], pairs[:, 1]))]
            pairs = pairs[np.concatenate([[True], pairs[1:, 1] != pairs[:-1, 1]])]
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    mixed = members.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("k"))
    members = members.join(mixed.where("lo <> hi").select("g", F.ceil(F.col("k") / block).alias("_n")), "g").checkpoint(eager=True)
    tiles = members.withColumn("b", F.pmod(F.xxhash64("node"), F.col("_n"))).withColumn("_t", F.explode(F.expr("sequence(0L, _n - 1)")))
    tiles = tiles.withColumn("i", F.least("b", "_t")).withColumn("j", F.greatest("b", "_t"))
    buckets = max(1, math.ceil(members.count() / bucket_rows))
    tiles = tiles.join(sets.withColumnRenamed("doc_id", "node"), "node").select(
        F.pmod(F.xxhash64("g", "i", "j"), F.lit(buckets)).alias("_bucket"), "g", "i", "j", "b", "node", "component", "n_shingles", "parity"
    )
    return tiles.groupBy("_bucket").applyInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, percent: int, k: int, filter_bits: int = 22) -> DataFrame:
    """Those of ``pairs(a, b)`` that link. Only texts that a pair may need are
    shingled again: a fixed-size bitmap of the ids drops most of the others."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << filter_bits))
    bitmap = need.select(spot("doc_id").alias("p")).groupBy(F.shiftright("p", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("_bits")
    )  # fmt: skip  at most 2**(filter_bits - 6) rows
    marked = docs.withColumn("_p", spot("doc_id")).withColumn("_word", F.shiftright("_p", 6)).join(F.broadcast(bitmap), "_word")
    some = marked.where(F.expr("(shiftright(_bits, cast(_p & 63 as int)) & 1) = 1")).select("doc_id", "text")
    sets = token_sets(some, k).join(need, "doc_id")
    sets = sets.withColumn("_rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("tokens"))).where(F.size("tokens") > 0)
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tb"))
    sized = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("ta", "tb"))
    return (
        sized.select("a", "b", shared.alias("i"), (F.size("ta") + F.size("tb")).alias("n"))
        .where(F.col("i") * 100 >= percent * (F.col("n") - F.col("i"))).select("a", "b").distinct()
    )


def link_documents(
    docs: DataFrame,
    *,
    percent: int = PERCENT,
    k: int = SHINGLE,
    bucket_rows: int = 300_000,
    sample_one_in: int = 16,
    popular_least: int = 3,
    popular_most: int = 500_000,
) -> DataFrame:
    """(doc_id, n_shingles, n_copies, component_id) for each row of
    ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    scheme = Partition(percent)
    rows = describe(docs, k).checkpoint(eager=True)
    live = rows.where("doc_id is not null and n_shingles > 0")

    # exact copies: the smallest id stands for the set
    same = live.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"))
    salted = same.where("n_copies > 1").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    known = rows.withColumn("_salt", salt).join(salted, ["d1", "d2", "n_shingles", "_salt"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")).alias("rep"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    ).checkpoint(eager=True)
    copies = known.where("rep <> doc_id").select("doc_id", "rep")

    texts = docs.where("doc_id is not null")
    popular = spark.sparkContext.broadcast(popular_shingles(texts, k, sample_one_in, popular_least, popular_most))
    # rows that share a doc_id and differ in text take part with each of their sets
    sets = live.select("doc_id", "n_shingles", "parity").distinct()
    volume = live.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, math.ceil(0.5 * volume / bucket_rows))
    found = shared_signatures(signature_blocks(texts, scheme, popular, buckets, k)).checkpoint(eager=True)

    def representative(df, column):
        other = copies.select(F.col("doc_id").alias(column), F.col("rep").alias("_rep"))
        return df.join(other, column, "left").withColumn(column, F.coalesce("_rep", column)).drop("_rep")

    pairs = found.where(F.col("kind") != MEMBER).groupBy("kind", F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("n").alias("n"))
    pairs = representative(representative(pairs, "a"), "b").where("a <> b")
    pairs = pairs.select("kind", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n").checkpoint(eager=True)
    members = representative(found.where(F.col("kind") == MEMBER).select(F.col("x").alias("g"), F.col("y").alias("node")), "node")
    members = members.distinct().checkpoint(eager=True)

    def labelled(labels):
        own = members.join(labels, "node", "left")
        return own.select("g", "node", F.coalesce("component", "node").alias("component"))

    # rows that share a doc_id may stand in several exact groups: those are links too
    twins = known.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    twins = twins.where("a <> b").select("a", "b")
    # 1. each set with the partner of most signatures
    met = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    first = met.groupBy("b").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("a")).select("a", "b")
    near = near_pairs(first, sets, scheme).distinct().checkpoint(eager=True)
    links = verified(near, texts, percent, k).union(twins).checkpoint(eager=True)
    labels = components(links)
    # 2. each set with the nearest one of another component
    near = cross_pairs(labelled(labels), sets, scheme, nearest_only=True).checkpoint(eager=True)
    more = verified(near, texts, percent, k).checkpoint(eager=True)
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links)
    # 3. all that are still apart
    rest = pairs.where(F.col("kind") == PAIR).select("a", "b").distinct()
    for column in ("a", "b"):
        rest = rest.join(labels.select(F.col("node").alias(column), F.col("component").alias(f"c{column}")), column, "left")
        rest = rest.withColumn(f"c{column}", F.coalesce(f"c{column}", column))
    rest = near_pairs(rest.where("ca <> cb").select("a", "b"), sets, scheme)
    cross = rest.union(cross_pairs(labelled(labels), sets, scheme, nearest_only=False)).distinct()
    cross = cross.join(near, ["a", "b"], "left_anti").checkpoint(eager=True)
    if not cross.isEmpty():
        more = verified(cross, texts, percent, k).checkpoint(eager=True)
        if not more.isEmpty():
            labels = components(links.union(more))

    salted = labels.select(F.col("node").alias("rep"), "component", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    out = known.withColumn("_salt", salt).join(salted, ["rep", "_salt"], "left")
    return out.select(
        "doc_id", "n_shingles", "n_copies", F.coalesce("component", "rep").alias("component_id")
    )
